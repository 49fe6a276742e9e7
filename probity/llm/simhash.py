"""Near duplicates by SimHash, found with vantage-point trees.

Fingerprints are made distinct and dealt to the leaves of a tree of vantage points. By the
triangle inequality two fingerprints within ``RADIUS`` bits differ in their distance to any
point by at most that: a fingerprint outside a node's ball, but no further from its edge than
that, goes to both sides, and every close pair meets in some leaf. Leaves are searched on
their own, by smaller trees, and give spanning links; components are joined in rounds.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from probity._shipping import ship_by_value
from probity.sources.layers import stage

ship_by_value(__name__)

#: Words in a shingle, seed of its hash, and the most bits in which linked fingerprints differ.
SHINGLE, SEED, RADIUS = 3, 42, 2
#: Fingerprints per leaf that the tree aims at, and the most that are looked at to build it.
LEAF, SAMPLE = 8192, 1 << 18
#: Within a leaf: sets this small are compared directly; sets beyond DENSE that no vantage
#: point splits are searched by flipping bits, whose cost grows with the set and not its square.
DIRECT, DENSE = 1024, 100_000


def fingerprint(text: bytes | None) -> int:
    """The SimHash of one text, signed as Spark's longs are; 0 where there is no word."""
    part = (text or b"").lower().split()
    if not part:
        return 0
    joined = b" ".join(part)
    ends = np.cumsum([len(w) + 1 for w in part]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    width = min(SHINGLE, len(part))
    spans = zip(starts[: len(part) - width + 1].tolist(), ends[width - 1 :].tolist())
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in spans), np.uint64, len(part) - width + 1)
    return int(majority(hashes).view(np.int64))


def majority(hashes: np.ndarray) -> np.uint64:
    """The SimHash of hashes: a bit is 1 where it is set in over half of them."""
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 4096):
        bits = np.unpackbits(hashes[at : at + 4096].view(np.uint8), bitorder="little")
        counts += bits.reshape(-1, 64).sum(0, dtype=np.int64)
    return np.packbits(counts * 2 > len(hashes), bitorder="little").view(np.uint64)[0]


def fingerprints(text: Column) -> Column:
    """The fingerprint of a binary column, computed by Spark in batches."""

    @F.pandas_udf("long")
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([fingerprint(t) for t in batch], dtype="int64")

    return run(text)


def hex_digits(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


@dataclass(frozen=True)
class Node:
    """Fingerprints up to ``radius`` from ``point`` are inside; a leaf has a number instead."""

    leaf: int = -1
    point: int = 0
    radius: int = 0
    inside: Node | None = None
    outside: Node | None = None


def distances(fps: np.ndarray, point: int) -> np.ndarray:
    return np.bitwise_count(fps ^ np.uint64(point))


def vantage(fps: np.ndarray) -> tuple[int, int]:
    """A point whose distances spread widely over the set, and the radius that halves it."""
    some = fps[:: max(1, len(fps) // 2048)]
    # flipped points are as good as the set's own and split clusters that lie close together
    points = [int(p) for p in some[:: max(1, len(some) // 12)][:12]]
    points += [p ^ 0x5555555555555555 for p in points[:4]]
    best = max(points, key=lambda p: float(np.var(distances(some, p))))
    return best, int(np.median(distances(some, best)))


def split(fps: np.ndarray, point: int, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Which fingerprints go inside and which outside; those near the edge go to both."""
    away = distances(fps, point)
    return away <= radius + RADIUS, away > radius


def plant(sample: np.ndarray, depth: int) -> Node:
    """The tree over a sample, with its leaves numbered from 0."""
    leaves = 0

    def grow(fps: np.ndarray, depth: int) -> Node:
        nonlocal leaves
        if depth > 0 and len(fps) > 1:
            point, radius = vantage(fps)
            inside, outside = split(fps, point, radius)
            if not (inside.all() or outside.all()):
                return Node(
                    point=point,
                    radius=radius,
                    inside=grow(fps[inside], depth - 1),
                    outside=grow(fps[outside], depth - 1),
                )
        leaves += 1
        return Node(leaf=leaves - 1)

    return grow(sample, depth)


def route(node: Node, fps: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """The leaves that fingerprints go to."""
    if not len(fps):
        return
    if node.leaf >= 0:
        yield node.leaf, fps
        return
    inside, outside = split(fps, node.point, node.radius)
    yield from route(node.inside, fps[inside])
    yield from route(node.outside, fps[outside])


def unite(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Joins the components of ``a`` and ``b``, pair by pair; labels are smallest members."""
    while True:
        low = np.minimum(label[a], label[b])
        if (label[a] == low).all() and (label[b] == low).all():
            return
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        while not np.array_equal(deeper := label[label], label):
            label[:] = deeper


def search(fps: np.ndarray, at: np.ndarray, label: np.ndarray) -> None:
    """Unites all fingerprints ``fps[at]`` that differ in at most RADIUS bits."""
    if len(at) > DIRECT:
        point, radius = vantage(fps[at])
        inside, outside = split(fps[at], point, radius)
        if inside.sum() + outside.sum() < 1.6 * len(at) and not (inside.all() or outside.all()):
            search(fps, at[inside], label)
            search(fps, at[outside], label)
            return
    mine = fps[at]
    if len(at) > DENSE:
        order = np.argsort(mine)
        near = mine[order]
        flips = [1 << i for i in range(64)]
        flips += [x | y for n, x in enumerate(flips) for y in flips[:n]]
        for flip in flips:
            other = near ^ np.uint64(flip)
            place = np.minimum(np.searchsorted(near, other), len(near) - 1)
            hit = near[place] == other
            unite(label, at[order[hit]], at[order[place[hit]]])
        return
    for start in range(0, len(at), 256):
        block = mine[start : start + 256]
        i, j = np.nonzero(np.bitwise_count(block[:, None] ^ mine[None, start:]) <= RADIUS)
        unite(label, at[i + start], at[j + start])


def leaf_links(leaf: pd.DataFrame) -> pd.DataFrame:
    """A leaf's links, each from a fingerprint to the smallest one of its component there."""
    fps = np.unique(leaf["fp"].to_numpy(np.int64).view(np.uint64))
    label = np.arange(len(fps))
    search(fps, label.copy(), label)
    more = np.nonzero(label != np.arange(len(fps)))[0]
    return pd.DataFrame({"u": fps[more].view(np.int64), "v": fps[label[more]].view(np.int64)})


def links(fps: DataFrame) -> DataFrame:
    """Spanning links (u, v) between distinct fingerprints of a column ``fp``."""
    total = fps.count()
    every = -(-total // SAMPLE) or 1
    sample = fps.where(F.pmod(F.xxhash64("fp"), F.lit(every)) == 0).toPandas()["fp"].to_numpy(np.int64)
    depth = max(0, int(np.ceil(np.log2(max(1, total) / LEAF))) + 1) if total > DIRECT else 0
    tree = plant(np.sort(sample.view(np.uint64)), depth)

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for leaf, some in route(tree, batch["fp"].to_numpy(np.int64).view(np.uint64)):
                yield pd.DataFrame({"leaf": leaf, "fp": some.view(np.int64)})

    return fps.mapInPandas(deal, "leaf int, fp long").groupBy("leaf").applyInPandas(leaf_links, "u long, v long")


def stars(edges: DataFrame) -> DataFrame:
    """Links (u, v) rewritten so that every fingerprint points at its component's least.

    Large-star and small-star rounds: minima are map-side combined, joins back to the links
    may be split where a fingerprint has many, and every round is written before the next.
    """
    larger, smaller = F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    edges = stage(edges.where("u <> v").select(larger, smaller).distinct(), "links")
    mark = (-1, 0)
    while True:
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v")
        large = large.distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low)
        edges = stage(small.where("u > v").distinct(), "links")
        seen = edges.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")), F.lit(0))).first()
        if tuple(seen) == mark:
            return edges
        mark = tuple(seen)


def fingerprinted(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text_key, fp) per row, written once."""
    return stage(
        docs.select(
            F.col(id_col).alias("id"),
            F.xxhash64(text_col).alias("text_key"),
            fingerprints(F.col(text_col).cast("binary")).alias("fp"),
        ),
        "fingerprints",
    )


def component_of(rows: DataFrame, find: Callable[[DataFrame], DataFrame] = links) -> DataFrame:
    """Per distinct fingerprint: (fp, root, component_id), the least id of its component."""
    fps = stage(rows.groupBy("fp").agg(F.min("id").alias("least")), "distinct-fingerprints")
    points = stars(find(fps.select("fp"))).select(F.col("u").alias("fp"), F.col("v").alias("to"))
    rooted = fps.join(points, "fp", "left").select("fp", "least", F.coalesce("to", "fp").alias("root"))
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rooted.select("fp", "root").join(ids, "root")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ``fingerprint`` (16 hex digits) and ``component_id``, the least linked id.

    Null, empty and blank texts have fingerprint zero and are linked like any other. Texts of
    fewer than three words are one shingle. Rows that repeat an id are fingerprinted one by
    one. Null ids count for no minimum; a component of null ids only has a null id. An empty
    table gives an empty result; other columns are ignored.
    """
    rows = fingerprinted(docs, id_col, text_col)
    return rows.join(component_of(rows), "fp").select(
        F.col("id").alias(id_col), hex_digits(F.col("fp")).alias("fingerprint"), "component_id"
    )


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each component, the one of the least id; columns unchanged.

    Of rows that repeat that id one stays, by the hash of its text; equal rows are one.
    """
    rows = fingerprinted(docs, id_col, text_col)
    return first_of_each(docs, rows.join(component_of(rows), "fp"), id_col, text_col)


def first_of_each(docs: DataFrame, rows: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The document of the least id of each component, from (id, text_key, root, component_id)."""
    chosen = (
        rows.where(F.col("id").eqNullSafe(F.col("component_id")))
        .groupBy("root")
        .agg(F.min(F.struct("id", "text_key")).alias("c"))
        .select(F.col("c.id").alias("_id"), F.col("c.text_key").alias("_key"))
        .distinct()
    )
    keyed = docs.select(
        F.struct("*").alias("row"), F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_key")
    )
    same = F.col("id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key"))
    return keyed.join(chosen, same, "left_semi").dropDuplicates(["id", "text_key"]).select("row.*")
