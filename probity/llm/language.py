"""Language of texts, span by span.

Words are scored for every language by the character n-grams of a labelled sample. The
script of a word narrows its languages first; then Viterbi over the words, with a penalty
for every switch, labels spans, also of mixed texts. A text's language is that of most of
its letters.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from probity._shipping import ship_by_value

from .common import slices

ship_by_value(__name__)

#: Rows per language that are learned from: the bound of the sample.
SAMPLE_ROWS = 1000
#: n-grams of these lengths, a word's edges included, are counted in so many buckets.
#: With more than ``FULL`` languages there are fewer, so that a model does not grow with them.
ORDERS, BUCKETS, FULL = (1, 2, 3, 4), 1 << 15, 64
#: What a switch of language costs, in nats of a word's score averaged over the orders.
SWITCH = 12.0
#: A script belongs to a language if this share of its letters is written in it.
SCRIPT_SHARE = 0.01
UNKNOWN = "und"
#: Characters labelled in one go, the longest text excepted.
SLICE_CHARS = 4_000_000

#: Scripts by ranges of code points (fixed values, from the Unicode blocks); all else is "other".
SCRIPTS = {
    "latin": ((0x41, 0x24F), (0x1E00, 0x1EFF)),
    "greek": ((0x370, 0x3FF), (0x1F00, 0x1FFF)),
    "cyrillic": ((0x400, 0x52F),),
    "armenian": ((0x530, 0x58F),),
    "hebrew": ((0x590, 0x5FF),),
    "arabic": ((0x600, 0x6FF), (0x750, 0x77F)),
    "devanagari": ((0x900, 0x97F),),
    "thai": ((0xE00, 0xE7F),),
    "georgian": ((0x10A0, 0x10FF),),
    "hangul": ((0x1100, 0x11FF), (0xAC00, 0xD7AF)),
    "kana": ((0x3040, 0x30FF),),
    "han": ((0x3400, 0x9FFF), (0x20000, 0x2FFFF)),
}
WORD = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    logs: np.ndarray  # (orders, buckets, languages), log share of an n-gram in its order
    prior: np.ndarray
    scripts: np.ndarray  # (scripts, languages), whether a language is written so


class Codes(dict):
    """Numbers words in the order in which they come."""

    def __missing__(self, word: str) -> int:
        self[word] = code = len(self)
        return code


def letters(text: str) -> list[str]:
    return WORD.findall(text.lower())


def spread_out(vocabulary: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The words' code points, parted by blanks, and where the blanks are."""
    points = np.frombuffer((" " + " ".join(vocabulary) + " ").encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
    return points, points == 32


def buckets_for(languages: int) -> int:
    """Buckets per order: half as many whenever the languages double beyond ``FULL``, but 256 at least."""
    return max(256, BUCKETS >> max(0, (max(languages, 1) - 1) // FULL).bit_length())


def grams(vocabulary: list[str], buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per order the bucket of each n-gram and the word it is of."""
    points, blank = spread_out(vocabulary)
    word = np.cumsum(blank) - 1
    inner = np.concatenate(([0], np.cumsum(blank)))
    for n in ORDERS:
        size = len(points) - n + 1
        mixed = np.zeros(size, np.uint64)
        for k in range(n):
            mixed = (mixed ^ points[k : k + size]) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
        # blanks may stand at the ends only, and not alone; n-grams begin in the word they are of
        owner = word[:size]
        good = ~blank[:size] if n == 1 else inner[n - 1 : n - 1 + size] == inner[1 : 1 + size]
        good = good & (owner < len(vocabulary))
        yield (mixed[good] % np.uint64(buckets)).astype(np.int32), owner[good].astype(np.int32)


def scripts_of(vocabulary: list[str]) -> np.ndarray:
    """The script of each word, by its first letter."""
    points, blank = spread_out(vocabulary)
    first = np.nonzero(blank)[0][:-1] + 1
    lead = points[first].astype(np.int64)
    script = np.full(len(vocabulary), len(SCRIPTS))
    for number, ranges in enumerate(SCRIPTS.values()):
        for low, high in ranges:
            script[(lead >= low) & (lead <= high)] = number
    return script


def word_scores(vocabulary: list[str], model: Model) -> np.ndarray:
    """(words, languages): mean over the orders of the log shares, as far as the script allows."""
    scores = np.zeros((len(vocabulary), len(model.languages)), np.float32)
    for logs, (bucket, owner) in zip(model.logs, grams(vocabulary, model.logs.shape[1])):
        for l in range(scores.shape[1]):
            scores[:, l] += np.bincount(owner, logs[bucket, l], len(vocabulary)) / len(ORDERS)
    allowed = model.scripts[scripts_of(vocabulary)]
    none = ~allowed.any(1)
    scores[~allowed] = -1e4
    scores[none] = 0
    return scores - scores.max(1, keepdims=True)


def viterbi(codes: np.ndarray, lengths: np.ndarray, scores: np.ndarray, model: Model) -> np.ndarray:
    """The language of every word, all texts of a batch in step, the longest ones first."""
    order = np.argsort(-lengths, kind="stable")
    sizes = lengths[order]
    begin = (np.cumsum(lengths) - lengths)[order]
    table = np.ascontiguousarray(scores.T)
    count, total = len(model.languages), len(codes)
    best = np.zeros(total, np.int16)
    switched = np.zeros((count, total), bool)
    state = np.zeros((count, len(order)), np.float32) + model.prior[:, None]
    last = np.zeros(len(order), np.int64)
    alive = np.searchsorted(-sizes, -np.arange(sizes[0] if len(sizes) else 0), side="left")
    for t, n in enumerate(alive):
        now, at = state[:, :n], begin[:n] + t
        if t:
            top = now.argmax(0)
            leave = now[top, np.arange(n)] - SWITCH
            changed = now < leave
            best[at], switched[:, at] = top, changed
            now = np.where(changed, leave, now)
        state[:, :n] = now + table[:, codes[at]]
    last = state.argmax(0)
    path = np.zeros(total, np.int16)
    for t in range(len(alive) - 1, -1, -1):
        n = alive[t]
        at = begin[:n] + t
        path[at] = last[:n]
        if t:
            back = switched[last[:n], at]
            last[:n] = np.where(back, best[at], last[:n])
    return path


def label(texts: list[str | None], model: Model, spanned: bool = True) -> tuple[list[str], np.ndarray, list[list[tuple]]]:
    """Language, share of its letters, and spans of words (first, last, language) per text, none unless ``spanned``."""
    known = Codes()
    coded = [np.fromiter(map(known.__getitem__, letters(t)), np.int32) if t else np.zeros(0, np.int32) for t in texts]
    vocabulary = list(known)
    real = np.fromiter((w.isalpha() or any(map(str.isalpha, w)) for w in vocabulary), bool, len(vocabulary))
    if not real.all():
        coded = [c[real[c]] for c in coded]
    lengths = np.fromiter(map(len, coded), np.int64, len(coded))
    if not len(vocabulary) or not lengths.sum():
        return [UNKNOWN] * len(texts), np.zeros(len(texts)), [[] for _ in texts]
    codes = np.concatenate(coded)
    path = viterbi(codes, lengths, word_scores(vocabulary, model), model)
    weight = np.fromiter(map(len, vocabulary), np.int64, len(vocabulary))[codes]
    text_of = np.repeat(np.arange(len(texts)), lengths)
    count = len(model.languages)
    sums = np.bincount(text_of * count + path, weight, len(texts) * count).reshape(-1, count)
    winner = sums.argmax(1)
    share = sums.max(1) / np.maximum(sums.sum(1), 1)
    names = [model.languages[w] if n else UNKNOWN for w, n in zip(winner.tolist(), lengths.tolist())]
    share = np.where(lengths > 0, share, 0.0)
    spans: list[list[tuple]] = [[] for _ in texts]
    if not spanned:
        return names, share, spans
    begins = np.concatenate(([True], (path[1:] != path[:-1]) | (text_of[1:] != text_of[:-1])))
    first = np.nonzero(begins)[0]
    last = np.concatenate((first[1:], [len(path)])) - 1
    offset = np.cumsum(lengths) - lengths
    for d, a, b, l in zip(text_of[first].tolist(), first.tolist(), last.tolist(), path[first].tolist()):
        spans[d].append((a - int(offset[d]), b - int(offset[d]), model.languages[l]))
    return names, share, spans


def train(rows: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id") -> Model:
    """Learns from about ``SAMPLE_ROWS`` whole texts of each language.

    Rows are counted by language first; then a fixed share of each, chosen by a hash of the
    id, is counted by n-gram bucket in tasks. The driver gets one row per language and bucket
    or script, whatever the input.
    """
    labelled = rows.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull())
    sizes = labelled.groupBy(lang_col).count().collect()
    sizes = sorted((r[0], r[1]) for r in sizes)
    names = tuple(n for n, _ in sizes)
    buckets = buckets_for(len(names))
    if not names:
        flat = np.zeros((len(ORDERS), buckets, 1), np.float32)
        return Model((UNKNOWN,), flat, np.zeros(1, np.float32), np.zeros((len(SCRIPTS) + 1, 1), bool))
    chosen = F.lit(False)
    for name, size in sizes:
        every = max(1, size // SAMPLE_ROWS)
        chosen = chosen | ((F.col(lang_col) == name) & (F.pmod(F.xxhash64(F.col(id_col), F.lit("lang")), F.lit(every)) == 0))
    place = {n: i for i, n in enumerate(names)}

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for lang, texts in (
                (lang, group) for lang, all_of in batch.groupby("lang")["text"] for group in slices(list(all_of), SLICE_CHARS)
            ):
                known = Codes()
                times: list[np.ndarray] = []
                for text in texts:
                    times.append(np.fromiter(map(known.__getitem__, letters(text)), np.int64))
                if not known:
                    continue
                often = np.bincount(np.concatenate(times), minlength=len(known))
                size = np.fromiter(map(len, known), np.int64, len(known))
                have = sums.setdefault(place[lang], np.zeros(buckets * len(ORDERS) + len(SCRIPTS) + 1, np.int64))
                for k, (bucket, owner) in enumerate(grams(list(known), buckets)):
                    have[k * buckets : (k + 1) * buckets] += np.bincount(bucket, often[owner], buckets).astype(np.int64)
                have[len(ORDERS) * buckets :] += np.bincount(scripts_of(list(known)), often * size, len(SCRIPTS) + 1).astype(np.int64)
        for lang, have in sums.items():
            at = np.nonzero(have)[0]
            yield pd.DataFrame({"lang": np.int32(lang), "at": at, "n": have[at]})

    counted = (
        labelled.where(chosen)
        .select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
        .mapInPandas(count, "lang int, at long, n long")
        .groupBy("lang", "at")
        .agg(F.sum("n").alias("n"))
        .toPandas()
    )
    counts = np.zeros((buckets * len(ORDERS) + len(SCRIPTS) + 1, len(names)))
    counts[counted["at"], counted["lang"]] = counted["n"]
    by_order = counts[: buckets * len(ORDERS)].reshape(len(ORDERS), buckets, len(names)) + 0.5
    logs = np.log(by_order / by_order.sum(1, keepdims=True))
    scripts = counts[buckets * len(ORDERS) :]
    share = scripts / np.maximum(scripts.sum(0), 1)
    weight = np.array([s for _, s in sizes], float)
    return Model(names, logs.astype(np.float32), np.log(weight / weight.sum()).astype(np.float32), share >= SCRIPT_SHARE)


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Adds ``lang_pred``, ``score`` and ``spans`` to the id of every row.

    ``spans`` are runs of words (first, last, lang) of one language; ``score`` is the share of
    letters in spans of the predicted one. Null texts and texts without a letter are ``und``
    with score 0 and no span. Words of scripts that no learned language uses take the language
    around them. Ties go to the language that sorts first. An empty table gives an empty
    result; other columns are ignored; repeated rows repeat.
    """
    return docs.select(F.col(id_col), found(F.col(text_col), model).alias("f")).select(id_col, "f.*")


def found(text: Column, model: Model) -> Column:
    """(lang_pred, score, spans) of a text column, computed by Spark in batches."""

    @F.pandas_udf("lang_pred string, score double, spans array<struct<first:int,last:int,lang:string>>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            parts = [label(group, model) for group in slices(batch.tolist(), SLICE_CHARS)]
            names, share, spans = ([x for part in parts for x in part[i]] for i in range(3))
            yield pd.DataFrame({"lang_pred": names, "score": np.array(share, float), "spans": spans})

    return run(text)


def language_of(text: Column, model: Model) -> Column:
    """Only the ``lang_pred`` of :func:`found`: no span is made or sent."""

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([x for group in slices(batch.tolist(), SLICE_CHARS) for x in label(group, model, spanned=False)[0]], dtype=object)

    return run(text)
