"""Phrase collocations, mined as Toivonen does.

A sample proposes phrases. One pass over everything counts the proposals and their negative
border, the phrases that were not proposed though both their parts without the last and without
the first word were. Both are counted in full. Where a border phrase is frequent after all, a
further pass counts what that opens, until nothing opens any more: at most as many passes as the
longest phrase has words. So the sample decides about the work, never about the result.

These passes run over word hashes, written once, and count phrases by 48-bit hashes; two phrases of
one hash can only be counted as more than they are. A last pass over the texts counts the phrases
whose hash was frequent by their words, exactly. Sets of hashes reach the tasks as a bit table of
fixed size. What such a table holds by chance is counted for nothing; none is missed.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from probity._shipping import ship_by_value
from probity.sources.layers import stage

from .common import whole

ship_by_value(__name__)

#: Words in the longest phrase.
LONGEST = 4
#: Share of the rows that propose, and part of the threshold that a phrase must reach among them.
SAMPLE, SLACK = 4, 0.5
#: Bits of a table of hashes (2 MiB); beyond so many phrases it lets more through.
FILTER_BITS = 1 << 24
#: Characters or words that a task looks at in one go, and word hashes that it remembers.
SLICE_CHARS, SLICE_WORDS, REMEMBERED = 2_000_000, 600_000, 200_000
#: Parts of a language that are ranked on their own before its first rows meet.
PARTS = 64
#: Bits of a hash that count, and about how many words there are per range that is counted on its own.
HASH_BITS, RANGE_WORDS = 48, 3_000_000
MASK = np.uint64((1 << 64) - (1 << (64 - HASH_BITS)))

#: A-Z to a-z, piece ends to a full stop, tab to blank.
CLEAN = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ,;:!?\n\x0b\x0c\r\t", b"abcdefghijklmnopqrstuvwxyz......... ")
COUNTS = "lang string, size int, phrase string, n long"
MULTIPLY = np.uint64(0x9E3779B97F4A7C15)


def words(text: bytes) -> list[bytes]:
    """The words of a text and, as full stops, the ends of its pieces."""
    return text.translate(CLEAN).replace(b".", b" . ").split()


def extend(head: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hashes of phrases with one more word behind."""
    mixed = (head ^ (head >> np.uint64(31))) * MULTIPLY + word
    return (mixed ^ (mixed >> np.uint64(29))) * MULTIPLY & MASK


class WordHashes(dict):
    """The hashes of the words of one language; 0 is the end of a piece."""

    def __init__(self, lang: str):
        super().__init__({b".": 0})
        self.seed = xxhash.xxh32_intdigest(lang.encode())

    def __missing__(self, word: bytes) -> int:
        self[word] = number = xxhash.xxh64_intdigest(word, self.seed) & int(MASK) or 1 << (64 - HASH_BITS)
        return number


class Numbers(dict):
    """Numbers words in the order in which they come; 0 is the end of a piece."""

    def __init__(self):
        super().__init__({b".": 0})

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


class Known:
    """A set of hashes by one bit each; it may hold more than was added, never less."""

    def __init__(self, bits: np.ndarray | None = None):
        self.bits = np.zeros(FILTER_BITS // 64, np.uint64) if bits is None else bits

    @staticmethod
    def place(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        place = hashes >> np.uint64(64 - (FILTER_BITS - 1).bit_length())
        return (place >> np.uint64(6)).astype(np.int64), np.uint64(1) << (place & np.uint64(63))

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        word, mask = self.place(hashes)
        return (self.bits[word] & mask) != 0

    def joined(self, other: Known) -> Known:
        return Known(self.bits | other.bits)


def by_language(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, list[bytes]]]:
    """Rows of (lang, text) in groups of bounded size, by language."""
    group, held = {}, 0
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            text = text.as_py()
            group.setdefault(lang, []).append(text)
            held += len(text)
            if held >= SLICE_CHARS:
                yield group
                group, held = {}, 0
    if group:
        yield group


# ---------------------------------------------------------------- passes over hashes


def hashed_words(docs: DataFrame, every: int) -> DataFrame:
    """(some, words): each text as word hashes, 0 ending each piece; ``some`` marks the sample. Written once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[tuple, WordHashes] = {}
        for batch in batches:
            rows = batch.select([0, 1])
            chosen = np.asarray(batch.column(2).to_numpy(zero_copy_only=False), bool)
            for some in (True, False):
                part = rows.filter(pa.array(chosen == some))
                for group in by_language(iter([part])):
                    for lang, texts in group.items():
                        if len(known.setdefault(lang, WordHashes(lang))) > REMEMBERED:
                            known[lang] = WordHashes(lang)
                        rows_of = [(*words(text), b".") for text in texts]
                        ends = np.cumsum([0, *map(len, rows_of)])
                        at = np.fromiter(map(known[lang].__getitem__, chain.from_iterable(rows_of)), np.uint64, int(ends[-1]))
                        listed = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(at.view(np.int64)))
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(texts), some)), listed], ["some", "words"])

    some = F.pmod(F.xxhash64("lang", "text"), F.lit(every)) == 0
    return stage(docs.select("lang", "text", some.alias("some")).mapInArrow(run, "some boolean, words array<long>"), "word-hashes")


def grown(at: np.ndarray, known: Known | None, done: Known | None, sizes: range) -> Iterator[tuple]:
    """(size, hashes, counts) of the phrases of a list of word hashes.

    Of two words on, only phrases count whose parts without the last and the first word are
    both known, and not those that ``done`` has had counted already.
    """
    held = at != 0
    if 1 in sizes and done is None:
        yield 1, *np.unique(at[held], return_counts=True)
    if known is None:
        return
    code, now = at, known.holds(at) & held
    before = done.holds(at) & held if done is not None else np.zeros(len(at), bool)
    for size in range(2, sizes.stop):
        where = np.flatnonzero(now[:-1] & now[1:])
        if not len(where):
            return
        longer = extend(code[where], at[where + size - 1])
        old = before[where] & before[where + 1]
        if size in sizes:
            yield size, *np.unique(longer[~old], return_counts=True)
        code, now, before = np.zeros(len(now) - 1, np.uint64), np.zeros(len(now) - 1, bool), np.zeros(len(now) - 1, bool)
        code[where], now[where] = longer, known.holds(longer)
        if done is not None:
            before[where] = old & done.holds(longer)  # and not where the table holds it by chance only


def packed(hashes: np.ndarray) -> bytes:
    """Ascending hashes as their differences, byte by byte, so that shuffle compression finds the zeros."""
    return np.diff(hashes, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T.tobytes()


def unpacked(data: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(data, np.uint8).reshape(8, -1).T.copy().view(np.uint64).ravel(), dtype=np.uint64)


def counted(rows: DataFrame, known: Known | None, done: Known | None, sizes: range, least: int, ranges: int) -> DataFrame:
    """(size, hash, n) of what occurs at least ``least`` times in the rows of :func:`hashed_words`.

    A task sums what it has and sends it by ranges of the hash, each of which is summed as a whole.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = np.uint64(((1 << 64) - 1) // ranges + 1)
        for group in gathered(batches):
            for size, hashes, n in grown(group, known, done, sizes):
                cuts = np.searchsorted(hashes // step, np.arange(ranges + 1, dtype=np.uint64))
                full = np.flatnonzero(np.diff(cuts))
                spans = [slice(cuts[i], cuts[i + 1]) for i in full]
                columns = [
                    pa.array(np.full(len(full), size, np.int32)),
                    pa.array(full.astype(np.int32)),
                    pa.array([packed(hashes[s]) for s in spans], pa.binary()),
                    pa.array([n[s].astype(np.int32).tobytes() for s in spans], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["size", "part", "hashes", "counts"])

    def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for batch in batches:
            texts = batch.column(0)
            ends, values = texts.offsets.to_numpy(), texts.values.to_numpy().view(np.uint64)
            begin = 0
            while begin < batch.num_rows:
                end = max(begin + 1, int(np.searchsorted(ends, ends[begin] + SLICE_WORDS, "right")) - 1)
                yield values[ends[begin] : ends[end]]
                begin = end

    def merge(table: pa.Table) -> pa.Table:
        hashes = np.concatenate([unpacked(h.as_py()) for h in table["hashes"]])
        counts = np.concatenate([np.frombuffer(c.as_py(), np.int32) for c in table["counts"]])
        order = np.argsort(hashes)
        hashes, counts = hashes[order], counts[order]
        first = np.flatnonzero(np.concatenate(([True], hashes[1:] != hashes[:-1])))
        n = np.add.reduceat(counts, first, dtype=np.int64)
        kept = n >= least
        size = np.full(int(kept.sum()), table["size"][0].as_py(), np.int32)
        return pa.table({"size": size, "hash": hashes[first][kept].view(np.int64), "n": n[kept]})

    found = rows.select("words").mapInArrow(run, "size int, part int, hashes binary, counts binary")
    return found.groupBy("size", "part").applyInArrow(merge, "size int, hash long, n long")


def table_of(hashes: DataFrame) -> Known:
    """The bits of a column ``hash``. At most ``FILTER_BITS`` bits reach the driver, however many hashes there are."""
    place = F.shiftrightunsigned("hash", 64 - (FILTER_BITS - 1).bit_length())
    mask = F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(F.lit(63)).cast("int"))
    rows = hashes.groupBy(F.shiftright(place, 6).alias("word")).agg(F.bit_or(mask).alias("mask")).toPandas()
    known = Known()
    known.bits[rows["word"].to_numpy(np.int64)] = rows["mask"].to_numpy(np.int64).view(np.uint64)
    return known


def missed(frequent: DataFrame, known: Known) -> DataFrame:
    """The hashes of frequent phrases that are not known and could be part of longer ones."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch[~known.holds(batch["hash"].to_numpy(np.int64).view(np.uint64))]

    return frequent.where(F.col("size") < LONGEST).select("hash").mapInPandas(run, "hash long")


def proposed(rows: DataFrame, min_count: int, every: int, ranges: int) -> Known:
    """Proposals of the sample, level by level."""
    least = max(1, int(min_count / every * SLACK))
    some, known = rows.where("some"), None
    for size in range(1, LONGEST):
        bits = table_of(counted(some, known, None, range(size, size + 1), least, ranges))
        known = bits if known is None else known.joined(bits)
    return known


def frequent_hashes(docs: DataFrame, min_count: int, every: int) -> Known:
    """The hashes of all phrases that occur so often, and maybe of some others."""
    rows = hashed_words(docs, every)
    total = rows.agg(F.coalesce(F.sum(F.size("words")), F.lit(0))).first()[0]
    ranges = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // RANGE_WORDS))
    known, done, found = proposed(rows, min_count, every, ranges), None, Known()
    while True:
        level = counted(rows, known, done, range(1, LONGEST + 1), min_count, ranges)
        level = stage(level.select("size", "hash"), "frequent-hashes")
        found = found.joined(table_of(level))
        opened = table_of(missed(level, known))
        if not opened.bits.any():
            return found
        done, known = known, known.joined(opened)


# ---------------------------------------------------------------- the last pass


def spelled(lang: str, texts: list[bytes], frequent: Known) -> Iterator[tuple]:
    """(size, phrases, counts) of the phrases whose hash is frequent; size 0 counts all words."""
    numbers, digests = Numbers(), WordHashes(lang)
    tokens = [w for text in texts for w in (*words(text), b".")]
    at = np.fromiter(map(numbers.__getitem__, tokens), np.int64, len(tokens))
    del tokens
    held = list(numbers)
    hashes = np.fromiter(map(digests.__getitem__, held), np.uint64, len(held))
    yield 0, [b""], np.array([np.count_nonzero(at)])
    code = hashes[at]
    where = np.flatnonzero((at != 0) & frequent.holds(code))
    code = code[where]
    for size in range(1, LONGEST + 1):
        unique, first, inverse, n = np.unique(code, return_index=True, return_inverse=True, return_counts=True)
        rows = at[where[:, None] + np.arange(size)]
        heads = rows[first]
        if (heads[inverse] != rows).any():  # two phrases of one hash
            heads, n = np.unique(rows, axis=0, return_counts=True)
        yield size, [b" ".join([held[i] for i in row]) for row in heads.tolist()], n
        # a phrase goes on where the one that begins a word later is frequent as well
        on = np.flatnonzero(where[1:] == where[:-1] + 1)
        if not len(on) or size == LONGEST:
            return
        place = where[on]
        longer = extend(code[on], hashes[at[place + size]])
        kept = frequent.holds(longer)
        where, code = place[kept], longer[kept]
        if not len(where):
            return


def frequent_phrases(docs: DataFrame, min_count: int, every: int = SAMPLE) -> DataFrame:
    """(lang, size, phrase, n) of all phrases of 1 to ``LONGEST`` words that occur so often; size 0 counts all words.

    ``docs`` has ``lang`` and ``text`` (bytes), neither null.
    """
    frequent = frequent_hashes(docs, min_count, every)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in by_language(batches):
            for lang, texts in group.items():
                for size, phrases, n in spelled(lang, texts, frequent):
                    columns = [
                        pa.array([lang] * len(phrases), pa.string()),
                        pa.array(np.full(len(phrases), size, np.int32)),
                        pa.array(phrases, pa.binary()).cast(pa.string()),
                        pa.array(n, pa.int64()),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, ["lang", "size", "phrase", "n"])

    counts = docs.select("lang", "text").mapInArrow(run, COUNTS).groupBy("lang", "size", "phrase").agg(F.sum("n").alias("n"))
    return stage(counts.where((F.col("n") >= min_count) | (F.col("size") == 0)), "frequent-phrases")


def part(begin: int, end: Column | int) -> Column:
    return F.array_join(F.slice("w", begin + 1, end), " ")


def collocations(
    docs: DataFrame,
    min_count: int = 30,
    first: int | None = 2000,
    contained: int = 80,
    lang_col: str = "lang",
    text_col: str = "text",
    every: int = SAMPLE,
) -> DataFrame:
    """The phrases of each language by how much their parts belong together.

    Columns: lang, rank, phrase, a, l, r, n, score. A phrase of 2 to 4 words with ``a`` occurrences
    has the score ``2000000 * a div (l + r)`` of the cut where it is least. Phrases that stand to
    ``contained`` percent or more within one longer phrase are left out. ``first`` keeps that many
    per language, None all. Null languages are ``und``; null and empty texts have no words, rows
    that repeat count again, an empty table gives an empty result, other columns are ignored. Long
    texts are never cut.
    """
    rows = docs.select(
        F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), whole(F.col(text_col)).cast("binary").alias("text")
    )
    found = frequent_phrases(rows, min_count, every)
    words_of = found.where("size = 0").select("lang", F.col("n").alias("total"))
    known = found.where("size > 0").select("lang", "phrase", "n")
    whole_ones = found.where("size > 1").select("lang", "size", "phrase", F.col("n").alias("a"), F.split("phrase", " ").alias("w"))

    cuts = whole_ones.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1))).select(
        "lang", "phrase", "a", "k", part(0, F.col("k")).alias("head"), F.array_join(F.slice("w", F.col("k") + 1, F.col("size")), " ").alias("rest")
    )
    heads = known.select("lang", F.col("phrase").alias("head"), F.col("n").alias("l"))
    rests = known.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r"))
    score = F.expr("(CAST(a AS DECIMAL(20, 0)) * 2000000) DIV (CAST(l AS DECIMAL(20, 0)) + r)")
    scored = (
        cuts.join(heads, ["lang", "head"])
        .join(rests, ["lang", "rest"])
        .groupBy("lang", "phrase", "a")
        .agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    )

    def inner(size: int, width: int) -> list[Column]:
        return [F.array_join(F.slice("w", i + 1, width), " ") for i in range(size - width + 1)]

    inside = F.when(F.col("size") == 3, F.array(*inner(3, 2))).when(F.col("size") == 4, F.array(*inner(4, 2), *inner(4, 3)))
    within = (
        whole_ones.where("size > 2")
        .select("lang", F.explode(inside).alias("phrase"), "a")
        .groupBy("lang", "phrase")
        .agg(F.max("a").alias("longer"))
    )
    mostly = F.expr(f"CAST(longer AS DECIMAL(20, 0)) * 100 >= CAST(a AS DECIMAL(20, 0)) * {int(contained)}")
    left = scored.join(within, ["lang", "phrase"], "left").where(~F.coalesce(mostly, F.lit(False)))
    left = left.join(words_of, "lang").select(
        "lang", "phrase", "a", "cut.l", "cut.r", F.col("total").alias("n"), F.col("cut.score").alias("score")
    )
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    if first is not None:  # first among a share of the phrases, so that no task sorts a whole language
        share = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(PARTS))).orderBy(*order)
        left = left.withColumn("_place", F.row_number().over(share)).where(F.col("_place") <= first).drop("_place")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")
    out = left.withColumn("rank", rank)
    return (out if first is None else out.where(F.col("rank") <= first)).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
