"""Which tokens of two tokenizers cover the same bytes.

Both tokenizers give a text's tokens as ascending byte ends. The ends that both have cut the
text into groups; they are found by galloping: from where the last one was found the longer list
is probed at doubling distances, and the stretch that must hold an end is halved. A group's tokens
follow from the ranks of its ends in either list.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from itertools import chain, islice
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from probity._shipping import ship_by_value
from probity.sources.layers import stage

from .common import lookup

ship_by_value(__name__)

#: Pieces of text that a worker remembers, and characters that it aligns in one go.
REMEMBERED, SLICE_CHARS = 300_000, 2_000_000
#: Ends that gallop side by side; each block begins where the one before has ended.
BLOCK = 4096


def gallop(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Per element of an ascending list its least place in a longer one whose element is not below it.

    A block of elements gallops at once, each from where its rank in the block lets it be expected,
    up or down as what stands there is below it or not.
    """
    out = np.empty(len(short), np.int64)
    if not len(long):
        out[:] = 0
        return out
    ahead = (np.arange(BLOCK) * (len(long) / max(1, len(short)))).astype(np.int64)
    base, last = 0, len(long) - 1
    for k in range(0, len(short), BLOCK):
        part = short[k : k + BLOCK]
        start = np.minimum(base + ahead[: len(part)], last)
        rising = long[start] < part
        # what is below ``low`` is too small, what is from ``high`` on is not
        low, high = np.where(rising, start + 1, 0), np.where(rising, len(long), start)
        step = 1
        up, down = np.flatnonzero(rising), np.flatnonzero(~rising)
        while len(up) or len(down):
            probe = start[up] + step
            up, probe = up[probe <= last], probe[probe <= last]
            below = long[probe] < part[up]
            low[up[below]] = probe[below] + 1
            high[up[~below]] = probe[~below]
            up = up[below]
            probe = start[down] - step
            down, probe = down[probe >= 0], probe[probe >= 0]
            below = long[probe] < part[down]
            low[down[below]] = probe[below] + 1
            high[down[~below]] = probe[~below]
            down = down[~below]
            step *= 2
        while len(open_ := np.flatnonzero(low < high)):
            middle = (low[open_] + high[open_]) >> 1
            below = long[middle] < part[open_]
            low[open_[below]] = middle[below] + 1
            high[open_[~below]] = middle[~below]
        out[k : k + BLOCK] = low
        base = int(low[-1])
    return out


def common_ends(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places of the elements that two ascending lists share, in either list."""
    short, long = (a, b) if len(a) <= len(b) else (b, a)
    at = gallop(short, long)
    met = at < len(long)
    met[met] = long[at[met]] == short[met]
    of_short, of_long = np.nonzero(met)[0], at[met]
    return (of_short, of_long) if short is a else (of_long, of_short)


class Groups(NamedTuple):
    """Tokens ``a_begin`` to ``a_end`` of one side cover the same bytes as ``b_begin`` to ``b_end`` of the other."""

    a_begin: np.ndarray
    a_end: np.ndarray
    b_begin: np.ndarray
    b_end: np.ndarray


def groups(a_ends: np.ndarray, b_ends: np.ndarray) -> Groups:
    """The groups of two lists of ends; the difference of neighbouring ranks is a group's range."""
    a, b = common_ends(a_ends, b_ends)
    return Groups(np.concatenate(([0], a[:-1] + 1)), a + 1, np.concatenate(([0], b[:-1] + 1)), b + 1)


# ---------------------------------------------------------------- tokenizers


def _plain_bytes() -> dict[str, int]:
    """What character stands for what byte in a byte-level vocabulary: printable ones for themselves, others from 256 on."""
    kept = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in kept]
    return {chr(b): b for b in kept} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteLevel:
    """A byte-level BPE file of the tokenizers library; texts come with the blank before them."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._model = Tokenizer.from_file(path)
        self._model.encode_special_tokens = True
        vocabulary = self._model.get_vocab(with_added_tokens=True)
        plain, added = _plain_bytes(), {t.content for t in self._model.get_added_tokens_decoder().values()}
        self.bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, number in vocabulary.items():
            self.bytes[number] = token.encode() if token in added else bytes(plain[c] for c in token)

        # its own rule cuts before a blank, so the words of a text may be encoded one by one
        self.by_word = True

    def encode(self, texts: list[str]) -> list[list[int]]:
        given = [" " + t for t in texts]
        return [e.ids for e in self._model.encode_batch_fast(given, add_special_tokens=False)]

    def encode_words(self, words: list[str]) -> list[int]:
        """All words in one call: they are told apart by the blank that only their first token has."""
        return self._model.encode_batch_fast([" " + " ".join(words)], add_special_tokens=False)[0].ids


class Pieces:
    """A sentencepiece file; it puts the blank before a text itself."""

    def __init__(self, path: str):
        import sentencepiece

        self._model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self._model.id_to_piece(i) for i in range(self._model.get_piece_size())]
        self.bytes = [
            bytes([int(n[3:5], 16)]) if self._model.is_byte(i) else n.replace("▁", " ").encode() for i, n in enumerate(names)
        ]
        # a piece with a blank behind another character would tie two words together
        self.by_word = not any("▁" in n.lstrip("▁") for n in names)

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self._model.encode(texts, num_threads=1)

    def encode_words(self, words: list[str]) -> list[int]:
        return list(chain.from_iterable(self.encode(words)))


class Numbers(dict):
    def __missing__(self, piece: str) -> int:
        self[piece] = number = len(self)
        return number


class Side:
    """The ids of one tokenizer for every remembered piece, end to end."""

    def __init__(self, model):
        self.model = model
        self.size = np.array([len(b) for b in model.bytes], np.int64)
        self.opens = np.array([b.startswith(b" ") for b in model.bytes])
        self.forget()

    def forget(self) -> None:
        self.ids, self.begin = np.zeros(0, np.int64), np.zeros(1, np.int64)

    def whole(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and where each text's begin and end among them."""
        lists = self.model.encode(texts)
        begin = np.concatenate(([0], np.cumsum([len(x) for x in lists], dtype=np.int64)))
        return np.fromiter(chain.from_iterable(lists), np.int64, int(begin[-1])), begin

    def words(self, words: list[str], joined: bytes, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All ids of words, where each word's begin and end, and whether its bytes come back.

        ``joined`` are the bytes of all with the blank before each, ``sizes`` how many each has.
        """
        ids = np.array(self.model.encode_words(words), np.int64)
        first = np.flatnonzero(self.opens[ids]) if len(ids) else ids
        if len(first) == len(words) and self.bytes_of(ids.tolist()) == joined:
            begin = np.append(first, len(ids))
            if (np.add.reduceat(self.size[ids], first) == sizes).all() if len(words) else True:
                return ids, begin, np.ones(len(words), bool)
        ids, begin = self.whole(words)  # a word among them does not come back as it went
        rows = [ids[i:j].tolist() for i, j in zip(begin[:-1], begin[1:])]
        return ids, begin, np.array([self.bytes_of(r) == (" " + w).encode() for r, w in zip(rows, words)], bool)

    def learn(self, ids: np.ndarray, begin: np.ndarray) -> None:
        self.begin = np.concatenate((self.begin, begin[1:] + len(self.ids)))
        self.ids = np.concatenate((self.ids, ids))

    def bytes_of(self, ids: list[int]) -> bytes:
        return b"".join(map(self.model.bytes.__getitem__, ids))

    def gather(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of remembered pieces one after the other, and how many each has."""
        size = self.begin[codes + 1] - self.begin[codes]
        end = np.cumsum(size)
        at = np.arange(end[-1] if len(end) else 0) + np.repeat(self.begin[codes] - (end - size), size)
        return self.ids[at], size


class Aligned(NamedTuple):
    """Texts end to end: per side the ids and where each text begins, and the groups of all."""

    a: np.ndarray
    a_begin: np.ndarray
    b: np.ndarray
    b_begin: np.ndarray
    groups: Groups
    group_begin: np.ndarray


class Aligner:
    """Aligns texts of two tokenizers. Pieces between single blanks are encoded once and remembered."""

    def __init__(self, byte_level: str, pieces: str):
        self.a, self.b = Side(ByteLevel(byte_level)), Side(Pieces(pieces))
        self.by_word = self.a.model.by_word and self.b.model.by_word
        self.forget()

    def forget(self) -> None:
        self.known, self.good = Numbers(), np.zeros(0, bool)
        self.a.forget()
        self.b.forget()

    def _same(self, text: str, a: np.ndarray, b: np.ndarray) -> bool:
        wanted = (" " + text).encode()
        return self.a.bytes_of(a.tolist()) == wanted == self.b.bytes_of(b.tolist())

    def _learn(self, pieces: list[str]) -> None:
        """Encodes new pieces; good are those without white space at an end whose bytes come back."""
        plain = np.array([p.strip() == p != "" for p in pieces], bool)
        words = [p if c else "." for p, c in zip(pieces, plain)]  # the others go with their whole text
        joined = (" " + " ".join(words)).encode()
        sizes = np.array([len(w.encode()) + 1 for w in words], np.int64)
        for side in (self.a, self.b):
            ids, begin, same = side.words(words, joined, sizes)
            side.learn(ids, begin)
            plain &= same
        self.good = np.concatenate((self.good, plain))

    def tokens(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Per side all ids and where each text begins; texts whose bytes do not come back have none."""
        if len(self.known) > REMEMBERED:
            self.forget()
        known, old = self.known, len(self.known)
        split = [t.split(" ") if self.by_word and t else [] for t in texts]
        sizes = np.array([len(s) for s in split], np.int64)
        codes = np.fromiter(map(known.__getitem__, chain.from_iterable(split)), np.int64, int(sizes.sum()))
        if len(known) > old:
            self._learn(list(islice(known, old, None)))
        owner = np.repeat(np.arange(len(texts)), sizes)
        clean = np.bincount(owner, ~self.good[codes], len(texts)) == 0
        clean &= sizes > 0
        out = []
        odd = [i for i, t in enumerate(texts) if t and not clean[i]]
        rest = [side.whole([texts[i] for i in odd]) for side in (self.a, self.b)]
        same = [self._same(texts[i], *(ids[begin[k] : begin[k + 1]] for ids, begin in rest)) for k, i in enumerate(odd)]
        used = clean[owner]
        for side, (ids, begin) in zip((self.a, self.b), rest):
            got, size = side.gather(codes[used])
            counts = np.bincount(owner[used], size, len(texts)).astype(np.int64)
            for k, i in enumerate(odd):
                counts[i] = begin[k + 1] - begin[k] if same[k] else 0
            starts = np.concatenate(([0], np.cumsum(counts)))
            full = np.empty(starts[-1], np.int64)
            own = np.repeat(clean, counts)
            full[own] = got
            full[~own] = np.concatenate([ids[begin[k] : begin[k + 1]] for k in range(len(odd)) if same[k]] or [ids[:0]])
            out += [full, starts]
        return tuple(out)

    def align(self, texts: list[str]) -> Aligned:
        a, a_begin, b, b_begin = self.tokens(texts)
        # end to end the ends ascend over all texts, and both sides end together with every text
        found = groups(np.cumsum(self.a.size[a]), np.cumsum(self.b.size[b]))
        return Aligned(a, a_begin, b, b_begin, found, np.searchsorted(found.a_begin, a_begin))


def written(one: Aligned, names: list[bytes], offset: int) -> list[bytes]:
    """Per text its groups as ``a1,a2|b1;a3|b2,b3``; ``names`` are the ids with what may follow them."""
    g = one.groups
    a_size, b_size = g.a_end - g.a_begin, g.b_end - g.b_begin
    number = np.arange(len(g.a_end))
    of_a, of_b = np.repeat(number, a_size), np.repeat(number, b_size)
    codes = np.empty(len(one.a) + len(one.b), np.int64)
    last_a, last_b = np.zeros(len(one.a), np.int64), np.zeros(len(one.b), np.int64)
    last_a[g.a_end - 1] = last_b[g.b_end - 1] = 1
    codes[np.arange(len(one.a)) + g.b_begin[of_a]] = 2 * one.a + last_a
    codes[np.arange(len(one.b)) + g.a_end[of_b]] = 2 * (one.b + offset) + last_b
    both = one.a_begin + one.b_begin
    rows = codes.tolist()
    return [b"".join(map(names.__getitem__, rows[i:j]))[:-1] for i, j in zip(both[:-1].tolist(), both[1:].tolist())]


def id_names(a: int, b: int) -> list[bytes]:
    """Ids of either side followed by a comma, or by what ends their part of a group."""
    ends = [(b",", b"|"), (b",", b";")]
    return [b"%d%s" % (i, e) for n, pair in zip((a, b), ends) for i in range(n) for e in pair]


ALIGNED = "row long, id long, n_a long, n_b long, n_groups long, groups_sha256 string, pairs array<struct<pair: long, times: long>>"
KEPT: dict[tuple[str, str], tuple[Aligner, list[bytes]]] = {}


def aligned(docs: DataFrame, byte_level: str, pieces: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row its counts, the digest of its groups, and its id pairs with how often each is linked; written once.

    A pair is ``a << 32 | b``. ``row`` numbers the rows of the table as written.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        if (byte_level, pieces) not in KEPT:  # outlives the task where Spark uses a worker again
            made = Aligner(byte_level, pieces)
            KEPT[byte_level, pieces] = made, id_names(len(made.a.size), len(made.b.size))
        aligner, names = KEPT[byte_level, pieces]
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            begin = 0
            while begin < len(texts):
                end, held = begin, 0
                while end < len(texts) and held < SLICE_CHARS:
                    held += len(texts[end])
                    end += 1
                yield digest(aligner.align(texts[begin:end]), ids[begin:end], row, names, len(aligner.a.size))
                row += end - begin
                begin = end

    def digest(one: Aligned, ids: pa.Array, row: int, names: list[bytes], offset: int) -> pa.RecordBatch:
        count = len(ids)
        link = one.a[one.groups.a_end - 1] << 32 | one.b[one.groups.b_end - 1]
        n_groups = np.diff(one.group_begin)
        owner = np.repeat(np.arange(count), n_groups)
        order = np.lexsort((link, owner))
        link, owner = link[order], owner[order]
        first = np.nonzero(np.concatenate(([True], (link[1:] != link[:-1]) | (owner[1:] != owner[:-1]))) if len(link) else [])[0]
        times = np.diff(np.concatenate((first, [len(link)])))
        ends = np.concatenate(([0], np.cumsum(np.bincount(owner[first], minlength=count)))).astype(np.int32)
        pairs = pa.StructArray.from_arrays([pa.array(link[first]), pa.array(times.astype(np.int64))], ["pair", "times"])
        texts = [hashlib.sha256(t).hexdigest() if t else "" for t in written(one, names, offset)]
        columns = [
            pa.array(row + np.arange(count)),
            ids,
            pa.array(np.diff(one.a_begin)),
            pa.array(np.diff(one.b_begin)),
            pa.array(n_groups.astype(np.int64)),
            pa.array(texts, pa.string()),
            pa.ListArray.from_arrays(pa.array(ends), pairs),
        ]
        return pa.RecordBatch.from_arrays(columns, ["row", "id", "n_a", "n_b", "n_groups", "groups_sha256", "pairs"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return stage(rows.mapInArrow(run, ALIGNED), "aligned")


def pair_counts(rows: DataFrame) -> DataFrame:
    """(pair, count, best) of all id pairs; ``best`` where no pair of the same B id is linked more often."""
    links = rows.select(F.inline("pairs"))
    counts = stage(links.groupBy("pair").agg(F.sum("times").alias("count")), "pair-counts")
    b = F.col("pair").bitwiseAND(0xFFFFFFFF)
    most = counts.groupBy(b.alias("b")).agg(F.max("count").alias("most"))
    return counts.join(most, b == F.col("b")).select("pair", "count", (F.col("count") == F.col("most")).alias("best"))


def alignments(docs: DataFrame, byte_level: str, pieces: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    A link is a token of either side that end at the same byte; its count is how many links of all
    rows hold the same two ids. Null and empty texts, and texts whose bytes one of the tokenizers
    does not give back, have no tokens: zeros and an empty digest. Rows that repeat are rows of their
    own, ids may be null, an empty table gives an empty result, other columns are ignored. Texts are
    aligned whole, however long.
    """
    rows = aligned(docs, byte_level, pieces, id_col, text_col)
    counts = stage(pair_counts(rows), "pair-ranks")
    links = rows.select("row", F.inline("pairs")).join(lookup(counts, counts.count(), 40), "pair")
    sums = links.groupBy("row").agg(
        F.sum("times").alias("n_links"),
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
        F.sum(F.col("times") * F.col("count")).alias("count_sum"),
    )
    zero = lambda name: F.coalesce(F.col(name), F.lit(0)).cast("long").alias(name)
    return rows.drop("pairs").join(sums, "row", "left").select(
        F.col("id").alias(id_col), "n_a", "n_b", "n_groups", zero("n_links"), zero("n_best"), zero("count_sum"), "groups_sha256"
    )


def token_groups(docs: DataFrame, byte_level: str, pieces: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per group of every row: its id, the group's number, byte end, and the token ids of either side."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(byte_level, pieces)
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                one = aligner.align([text])
                g, ends = one.groups, np.cumsum(aligner.a.size[one.a])
                columns = [
                    pa.array([key] * len(g.a_end), pa.int64()),
                    pa.array(np.arange(len(g.a_end))),
                    pa.array(ends[g.a_end - 1]),
                    pa.array([one.a[i:j].tolist() for i, j in zip(g.a_begin, g.a_end)], pa.list_(pa.int64())),
                    pa.array([one.b[i:j].tolist() for i, j in zip(g.b_begin, g.b_end)], pa.list_(pa.int64())),
                ]
                yield pa.RecordBatch.from_arrays(columns, [id_col, "number", "end", "a_ids", "b_ids"])

    rows = docs.select(F.col(id_col).cast("long").alias(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.mapInArrow(run, f"{id_col} long, number long, end long, a_ids array<long>, b_ids array<long>")
