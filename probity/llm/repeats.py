"""Repeated passages by suffix arrays.

Every window of ``LENGTH`` bytes has an anchor, the least hash of its ``GRAM``-byte strings,
so equal windows have equal anchors wherever they stand. Runs of windows whose anchor is in
one place are pieces of text; pieces whose anchor occurs once hold no repeat and go no further, equal
pieces are sent once with their number. The pieces of an anchor meet in one task, which
sorts their suffixes in two stages: those smaller than their successor directly, the others
by scanning the buckets of what is sorted. Neighbours with a long common prefix are repeats.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from probity._shipping import ship_by_value
from probity.sources.layers import stage

ship_by_value(__name__)

LENGTH, GRAM = 400, 16
#: Bytes of text that one suffix array is built over, unless a single anchor has more.
TEXT = 1 << 18
#: Anchors whose different pieces have more bytes than this are not gathered in one task.
CROWD = 4 << 20
#: Text hashed for anchors in one go.
CHUNK = 1 << 20


def words_at(text: np.ndarray) -> np.ndarray:
    """The eight bytes from every position on, as numbers that sort like the bytes."""
    padded = np.concatenate((text, np.zeros(8, np.uint8)))
    out = np.zeros(len(text), np.uint64)
    for k in range(8):
        out = (out << np.uint64(8)) | padded[k : k + len(text)]
    return out


def gram_hashes(text: np.ndarray) -> np.ndarray:
    """A hash of the GRAM bytes from every position on."""
    words = words_at(text)
    size = max(0, len(text) - GRAM + 1)
    mixed = words[:size] * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(32)
    mixed += words[8 : 8 + size] * np.uint64(0xC2B2AE3D27D4EB4F)
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    return mixed ^ (mixed >> np.uint64(32))


def least_of_windows(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` consecutive values: from block minima forward and back."""
    count = len(values) - width + 1
    blocks = -(-len(values) // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(values)] = values
    table = padded.reshape(blocks, width)
    forward = np.minimum.accumulate(table, axis=1).ravel()
    back = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:count], forward[width - 1 : width - 1 + count])


def pieces(texts: list[bytes]) -> Iterator[tuple[int, int, int, int]]:
    """(text number, first window, number of windows, anchor) of every run of windows."""
    group: list[int] = []
    held = 0
    for number, text in enumerate(texts):
        if len(text) >= LENGTH:
            group.append(number)
            held += len(text)
        if held >= CHUNK or (number == len(texts) - 1 and group):
            joined = np.frombuffer(b"".join(texts[g] for g in group), np.uint8)
            hashes = gram_hashes(joined)
            anchors = least_of_windows(hashes, LENGTH - GRAM + 1)
            size = np.array([len(texts[g]) for g in group])
            begin = np.cumsum(size) - size
            # a run ends where the anchor changes, or where its first place is left behind
            gone = hashes[: len(anchors) - 1] == anchors[:-1]
            new = np.concatenate(([True], gone | (anchors[1:] != anchors[:-1])))
            new[begin] = True
            real = np.zeros(len(anchors), bool)
            for b, s in zip(begin.tolist(), size.tolist()):
                real[b : b + s - LENGTH + 1] = True
            new[np.minimum(begin + size - LENGTH + 1, len(new) - 1)] = True
            first = np.nonzero(new)[0]
            run = np.diff(np.concatenate((first, [len(anchors)])))
            keep = real[first]
            first, run = first[keep], run[keep]
            of = np.searchsorted(begin, first, side="right") - 1
            yield from zip(
                np.array(group)[of].tolist(),
                (first - begin[of]).tolist(),
                run.tolist(),
                anchors[first].view(np.int64).tolist(),
            )
            group, held = [], 0


PIECES = "id long, text_key long, first int, windows int, anchor long, low long, high long"


def cut(docs: DataFrame) -> DataFrame:
    """The pieces of all texts, each with a digest of its bytes (``low``, ``high``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_128_digest
        for batch in batches:
            ids, keys = batch.column(0), batch.column(1)
            texts = [t or b"" for t in batch.column(2).to_pylist()]
            found = list(pieces(texts))
            if not found:
                continue
            of, first, windows, anchor = (list(x) for x in zip(*found))
            sums = b"".join(digest(texts[t][a : a + w + LENGTH - 1]) for t, a, w in zip(of, first, windows))
            both = np.frombuffer(sums, np.int64).reshape(-1, 2)
            at = pa.array(of, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    ids.take(at),
                    keys.take(at),
                    pa.array(first, pa.int32()),
                    pa.array(windows, pa.int32()),
                    pa.array(anchor, pa.int64()),
                    pa.array(both[:, 0]),
                    pa.array(both[:, 1]),
                ],
                ["id", "text_key", "first", "windows", "anchor", "low", "high"],
            )

    return docs.select("id", "text_key", F.col("text").cast("binary")).mapInArrow(run, PIECES)


def smaller_than_next(text: np.ndarray) -> np.ndarray:
    """Whether the suffix at each position is smaller than the next one; the last one is not."""
    change = np.nonzero(text[1:] != text[:-1])[0]
    ends = np.concatenate((change, [len(text) - 1]))
    grows = np.concatenate((text[change] < text[change + 1], [False]))
    return np.repeat(grows, np.diff(np.concatenate(([-1], ends))))


def suffix_order(text: bytes, starts: np.ndarray) -> np.ndarray:
    """Positions in the order of their suffixes, exact in the first LENGTH bytes of each.

    Only positions of ``starts``, and those that lead from one to the next directly sorted
    suffix, are ordered.
    """
    bytes_ = np.frombuffer(text, np.uint8)
    direct = smaller_than_next(bytes_)
    # a start needs the positions up to the next directly sorted one
    place = np.arange(len(bytes_), dtype=np.int32)
    nxt = np.where(direct, place, np.int32(len(bytes_) - 1))
    nxt = np.minimum.accumulate(nxt[::-1])[::-1]
    cover = np.zeros(len(bytes_) + 1, np.int32)
    np.add.at(cover, starts, 1)
    np.add.at(cover, nxt[starts] + 1, -1)
    needed = np.cumsum(cover)[:-1] > 0
    seeds = np.nonzero(needed & direct)[0]
    seeds = seeds[np.argsort(bytes_[seeds], kind="stable")]
    seed_bucket = np.searchsorted(bytes_[seeds], np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    order: list[np.ndarray] = []
    induced = needed & ~direct
    end = len(bytes_) - 1
    if induced[end]:  # the last suffix has no successor and comes first in its bucket
        waiting[bytes_[end]].append(np.array([end]))

    def scan(at: np.ndarray, bucket: int) -> np.ndarray:
        """Hands the predecessors of sorted suffixes to their buckets; returns those of this one."""
        before = at[at > 0] - 1
        before = before[induced[before]]
        lead = bytes_[before]
        later = lead > bucket
        by = np.argsort(lead[later], kind="stable")
        ahead, heads = before[later][by], lead[later][by]
        edges = np.nonzero(np.diff(heads))[0] + 1
        for some in np.split(ahead, edges) if len(ahead) else []:
            waiting[bytes_[some[0]]].append(some)
        return before[lead == bucket]

    for bucket in range(256):
        found = np.concatenate(waiting[bucket]) if waiting[bucket] else np.zeros(0, np.int64)
        while len(found):
            order.append(found)
            found = scan(found, bucket)
        mine = seeds[seed_bucket[bucket] : seed_bucket[bucket + 1]].tolist()
        if mine:
            # sorted bucket by bucket, so that only one bucket's keys are held
            mine.sort(key=lambda p: text[p : p + LENGTH])
            order.append(np.array(mine, np.int64))
            scan(order[-1], bucket)
    return np.concatenate(order) if order else np.zeros(0, np.int64)


def repeated(parts: list[bytes], counts: list[int]) -> list[np.ndarray]:
    """Per part, whether the LENGTH bytes from each window start on stand anywhere else."""
    text = b"".join(parts)
    size = np.array([len(p) for p in parts])
    begin = np.cumsum(size) - size
    start = np.zeros(len(text), bool)
    again = np.zeros(len(text), bool)
    for b, s, c in zip(begin.tolist(), size.tolist(), counts):
        start[b : b + s - LENGTH + 1] = True
        again[b : b + s - LENGTH + 1] = c > 1
    order = suffix_order(text, np.nonzero(start)[0])
    order = order[start[order]]
    words = words_at(np.frombuffer(text, np.uint8))
    same = np.arange(len(order) - 1) if len(order) > 1 else np.zeros(0, np.int64)
    for k in range(0, LENGTH, 8):
        same = same[words[order[same] + k] == words[order[same + 1] + k]]
    again[order[same]] = True
    again[order[same + 1]] = True
    return [again[b : b + s - LENGTH + 1] for b, s in zip(begin.tolist(), size.tolist())]


def runs(flags: np.ndarray) -> list[tuple[int, int]]:
    """(first, last) of the runs of set flags."""
    edge = np.diff(np.concatenate(([0], flags.astype(np.int8), [0])))
    return list(zip(np.nonzero(edge == 1)[0].tolist(), (np.nonzero(edge == -1)[0] - 1).tolist()))


FOUND = "anchor long, low long, high long, runs array<struct<first:int,last:int>>"


def sort_pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Builds suffix arrays over the pieces of a sorted partition, whole anchors at a time."""
    rows: list[tuple] = []
    held = 0

    def flush() -> pd.DataFrame:
        flags = repeated([r[4] for r in rows], [r[3] for r in rows])
        out = [(r[0], r[1], r[2], runs(f)) for r, f in zip(rows, flags) if f.any()]
        return pd.DataFrame(out, columns=["anchor", "low", "high", "runs"])

    for batch in batches:
        for row in batch.itertuples(index=False, name=None):
            if held >= TEXT and rows and row[0] != rows[-1][0]:
                yield flush()
                rows, held = [], 0
            rows.append(row)
            held += len(row[4])
    if rows:
        yield flush()


def with_bytes(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The pieces with their bytes, cut from the texts that hold them."""
    part = F.struct("anchor", "low", "high", "copies", "first", "windows")
    mine = wanted.groupBy(F.col("id").alias("_id"), F.col("text_key").alias("_key")).agg(F.collect_list(part).alias("p"))
    same = F.col("id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key"))
    return (
        docs.join(mine, same)
        .select(F.col("text").cast("binary").alias("bytes"), F.inline("p"))
        .select("anchor", "low", "high", "copies", F.expr(f"substring(bytes, first + 1, windows + {LENGTH - 1}) AS piece"))
    )


def crowd_runs(crowd: DataFrame) -> DataFrame:
    """The same as :func:`sort_pieces` for anchors whose pieces are too many for one task.

    Every window gets a 128-bit digest, the digests are counted by Spark with map-side
    combining, and those that occur again go back to their pieces.
    """

    def digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        digest = xxhash.xxh3_128_digest
        for batch in batches:
            for row in batch.itertuples(index=False):
                count = len(row.piece) - LENGTH + 1
                sums = b"".join(digest(row.piece[i : i + LENGTH]) for i in range(count))
                both = np.frombuffer(sums, np.int64).reshape(-1, 2)
                yield pd.DataFrame(
                    {
                        "anchor": row.anchor,
                        "low": row.low,
                        "high": row.high,
                        "copies": row.copies,
                        "at": np.arange(count, dtype=np.int32),
                        "d0": both[:, 0],
                        "d1": both[:, 1],
                    }
                )

    windows = stage(
        crowd.mapInPandas(digests, "anchor long, low long, high long, copies long, at int, d0 long, d1 long"), "windows"
    )
    again = windows.groupBy("d0", "d1").agg(F.sum("copies").alias("n")).where("n > 1").select("d0", "d1")
    return (
        windows.join(again, ["d0", "d1"])
        .groupBy("anchor", "low", "high")
        .agg(F.collect_set("at").alias("all_at"))
        .select("anchor", "low", "high", F.transform("all_at", lambda a: F.struct(a.alias("first"), a.alias("last"))).alias("runs"))
    )


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(id, text_key, spans): the bytes [begin, end) covered by repeats, spans may overlap.

    ``docs`` has (id, text_key, text); texts are told apart by id and hash.
    """
    spark = docs.sparkSession
    every = stage(cut(docs), "pieces")
    # all from one row, whichever: the aggregate holds them side by side, and is hashed
    place = [F.first(c).alias(c) for c in ("id", "text_key", "first", "windows")]
    kinds = every.groupBy("anchor", "low", "high").agg(F.count(F.lit(1)).alias("copies"), *place)
    shared = kinds.groupBy(F.col("anchor").alias("_anchor")).agg(
        F.sum("copies").alias("n"), F.sum(F.col("windows") + (LENGTH - 1)).alias("bytes")
    )
    wanted = stage(
        kinds.join(shared.where("n > 1"), F.col("anchor") == F.col("_anchor")).select(
            "anchor", "low", "high", "copies", "id", "text_key", "first", "windows", "bytes"
        ),
        "shared-pieces",
    )
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    few = with_bytes(docs, wanted.where(F.col("bytes") <= CROWD))
    found = few.repartition(tasks, "anchor").sortWithinPartitions("anchor").mapInPandas(sort_pieces, FOUND)
    crowd = wanted.where(F.col("bytes") > CROWD)
    if not crowd.isEmpty():
        found = found.union(crowd_runs(with_bytes(docs, crowd)).to(found.schema))
    found = stage(found, "repeats")
    span = F.struct(
        (F.col("first") + F.col("run.first")).alias("begin"), (F.col("first") + F.col("run.last") + LENGTH).alias("end")
    )
    spans = (
        every.join(found, ["anchor", "low", "high"])
        .withColumn("run", F.explode("runs"))
        .groupBy("id", "text_key")
        .agg(F.collect_list(span).alias("spans"))
    )
    return stage(spans, "spans")


def merged(spans: list | None) -> list[tuple[int, int]]:
    """Maximal runs of covered bytes."""
    out: list[tuple[int, int]] = []
    for begin, end in sorted((s["begin"], s["end"]) for s in spans or ()):
        if out and begin <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((begin, end))
    return out


def without(text: bytes, cuts: list[tuple[int, int]]) -> bytes:
    edges = [0, *(e for c in cuts for e in c), len(text)]
    return b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256`` and ``kept``, the bytes left.

    Every byte goes that a string of LENGTH bytes covers which also starts anywhere else, in
    the same text too; matches never cross texts and are judged on the input. Null is the
    empty text. Rows that repeat a text of LENGTH bytes or more lose all of it. Shorter texts
    lose nothing. An empty table gives an empty result; other columns are ignored.
    """
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.xxhash64(text_col).alias("text_key"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    spans = repeated_spans(rows)
    spans = spans.select(F.col("id").alias("_id"), F.col("text_key").alias("_key"), "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, cuts = batch.column(1).to_pylist(), [merged(s) for s in batch.column(2).to_pylist()]
            kept = [without(t, c) if c else t for t, c in zip(texts, cuts)]
            size = np.array([len(t) for t in texts], np.int64)
            columns = [
                batch.column(0),
                pa.array(size),
                pa.array(size - np.array([len(k) for k in kept], np.int64)),
                pa.array([len(c) for c in cuts], pa.int64()),
                pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()),
                pa.array(kept, pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    same = F.col("id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key"))
    return (
        rows.join(spans, same, "left")
        .select("id", F.col("text").cast("binary"), "spans")
        .mapInArrow(run, "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
        .withColumnRenamed("id", id_col)
    )
