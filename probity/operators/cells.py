"""Exact vector search that leaves out most of the corpus: a layer in cells with centre and radius.

Every vector is written in the cell of its nearest centre, and each cell's radius (the largest
distance of a vector to the centre) is kept beside it. No vector ``x`` of a cell can have a larger
inner product with a query ``q`` than ``q.c + |q| r``, so once k hits are known, the cells whose
bound lies below the k-th need not be read. The bound loses nothing: results equal a full scan.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from probity._shipping import ship_by_value
from probity.sources.layers import delete, replace_layer, stage, work_path, write_layer

from .search import DEFAULT_TOP_K, _matrix, best_per_query, corpus_width, met_in_groups, usable

ship_by_value(__name__)

#: Most centres there are (the square root of the rows, if that is less), and how many vectors at
#: most they are fitted on; every vector is indexed.
CELLS, FITTED_ON, ROUNDS = 256, 20_000, 8
#: Rows of a cell that a task holds at once; larger cells are met in parts.
PART_ROWS = 20_000
#: What bounds are raised by, relative to the lengths involved: more than sums of doubles can be off.
SLACK = 1e-9


def centres(vectors: np.ndarray, count: int, rounds: int = ROUNDS) -> np.ndarray:
    """Up to ``count`` centres of some vectors: far ones first, then moved to the mean of what is nearest."""
    if not len(vectors):
        return vectors
    picked = [0]
    distance = np.full(len(vectors), np.inf)
    while len(picked) < min(count, len(vectors)):
        distance = np.minimum(distance, ((vectors - vectors[picked[-1]]) ** 2).sum(axis=1))
        if distance.max() == 0:
            break
        picked.append(int(distance.argmax()))
    found = vectors[picked].copy()
    for _ in range(rounds):
        near = nearest(vectors, found)[0]
        held = np.bincount(near, minlength=len(found))
        sums = np.zeros_like(found)
        np.add.at(sums, near, vectors)
        found = np.where(held[:, None] > 0, sums / np.maximum(held, 1)[:, None], found)
    return found


def nearest(vectors: np.ndarray, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per vector its nearest centre, and the distance to it (taken from the difference, not from products)."""
    cell = ((found**2).sum(axis=1) - 2 * (vectors @ found.T)).argmin(axis=1)
    return cell, np.sqrt(((vectors - found[cell]) ** 2).sum(axis=1))


@dataclass(frozen=True)
class Cells:
    """What a layer in cells says about itself: one row per cell, of which there are at most ``CELLS``."""

    path: str
    layout: str
    number: np.ndarray
    rows: np.ndarray
    radius: np.ndarray
    centre: np.ndarray

    @property
    def width(self) -> int:
        return self.centre.shape[1]

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """Per query and cell what no inner product there can exceed."""
        length = np.sqrt((queries**2).sum(axis=1))[:, None]
        reach = np.sqrt((self.centre**2).sum(axis=1)) + self.radius
        return queries @ self.centre.T + length * (self.radius + SLACK * (1 + reach))


def write_cells(
    vectors: DataFrame,
    path: str,
    key: str = "global_id",
    embedding: str = "embedding",
    cells: int = CELLS,
    fitted_on: int = FITTED_ON,
    width: int | None = None,
) -> Cells:
    """Writes ``key`` and vector by cell, and the cells' own table; replaces what is at ``path``.

    Centres are fitted on at most about ``fitted_on`` vectors, chosen by a hash of the key; they
    decide how much is skipped and nothing else. Vectors that are null, hold a part that is no number, or
    have not the ``width`` of most are not in the layer, as no search could return them. A cell
    that holds much of the corpus is written by several tasks.
    """
    spark = vectors.sparkSession
    width = corpus_width(vectors, embedding) if width is None else width
    stored = vectors.select(key, embedding).where(usable(F.col(embedding), width))
    total = stored.count()
    every = max(1, -(-total // fitted_on))
    some = stored.where(F.pmod(F.xxhash64(key), F.lit(every)) == 0).select(embedding).toArrow()
    found = centres(_matrix(some[embedding]), min(cells, max(1, math.isqrt(total)))) if len(some) else np.zeros((0, width))
    if not len(found):
        found = np.zeros((1, width))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cell, distance = nearest(_matrix(pa.chunked_array([batch.column(1)])), found)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(cell.astype(np.int32)), pa.array(distance)],
                    [key, embedding, "cell", "distance"],
                )

    types = {f.name: f.dataType.simpleString() for f in stored.schema.fields}
    placed = stored.mapInArrow(place, f"`{key}` {types[key]}, `{embedding}` {types[embedding]}, cell int, distance double")
    version = f"{path.rstrip('/')}.new"
    delete(spark, version)
    parts = max(1, -(-total // (len(found) * PART_ROWS)))
    dealt = placed.repartition("cell", F.pmod(F.xxhash64(key), F.lit(parts)))
    write_layer(dealt, f"{version}/vectors", partition_by=["cell"])
    layout = f"`{key}` {types[key]}, `{embedding}` {types[embedding]}, distance double, cell int"
    write_layer(spark.createDataFrame([(layout,)], "layout string").coalesce(1), f"{version}/layout")
    sizes = spark.read.schema(layout).parquet(f"{version}/vectors").groupBy("cell").agg(F.count("*").alias("rows"), F.max("distance").alias("radius"))
    middles = spark.createDataFrame(pd.DataFrame({"cell": range(len(found)), "centre": found.tolist()}), "cell int, centre array<double>")
    write_layer(middles.join(sizes, "cell").coalesce(1), f"{version}/cells")
    replace_layer(spark, version, path)
    return read_cells(spark, path)


def read_cells(spark: SparkSession, path: str) -> Cells:
    rows = spark.read.parquet(f"{path}/cells").orderBy("cell").toPandas()
    centre = np.array(rows["centre"].tolist(), np.float64) if len(rows) else np.zeros((0, 0))
    layout = spark.read.parquet(f"{path}/layout").first()["layout"]
    return Cells(path, layout, rows["cell"].to_numpy(np.int64), rows["rows"].to_numpy(np.int64), rows["radius"].to_numpy(np.float64), centre)


def search_cells(
    spark: SparkSession,
    layer: Cells,
    queries: DataFrame,
    k: int = DEFAULT_TOP_K,
    key: str = "global_id",
    query_key: str = "query_id",
    embedding: str = "embedding",
    part_rows: int = PART_ROWS,
) -> tuple[DataFrame, DataFrame]:
    """``query_key, key, score, rank`` as :func:`search.top_k_batch` gives them, and the visits made.

    Each query first visits the cells that promise most until they hold k rows; its k-th hit then
    rules out the cells that cannot reach it, and the others are visited. ``visits`` has one row
    per query and visited cell (``query_key, cell, turn``). Queries that no vector of the layer can
    be compared with (see :func:`search.top_k_batch`) have no result.
    """
    asked = queries.select(query_key, embedding).where(usable(F.col(embedding), layer.width if len(layer.rows) else -1))
    asked = stage(asked, "asked")

    def choose(turn: int, known: DataFrame) -> DataFrame:
        """(query_key, embedding, cell, turn) of the cells to visit; ``known`` has the k-th score or null."""
        kinds = known.schema

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                bounds = layer.bounds(_matrix(pa.chunked_array([batch.column(1)])))
                order = np.argsort(-bounds, axis=1, kind="stable")
                before = np.cumsum(layer.rows[order], axis=1) - layer.rows[order]
                first = np.zeros(bounds.shape, bool)
                np.put_along_axis(first, order, before < k, axis=1)
                wanted = first
                if turn == 2:
                    reached = batch.column(2).to_numpy(zero_copy_only=False).astype(np.float64)
                    least = np.where(np.isnan(reached), -np.inf, reached)[:, None]
                    wanted = ~first & (bounds >= least)
                row, cell = np.nonzero(wanted)
                taken = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(taken), batch.column(1).take(taken), pa.array(layer.number[cell].astype(np.int32)),
                     pa.array(np.full(len(row), turn, np.int32))],
                    [query_key, embedding, "cell", "turn"],
                )

        types = {f.name: f.dataType.simpleString() for f in kinds.fields}
        output = f"`{query_key}` {types[query_key]}, `{embedding}` {types[embedding]}, cell int, turn int"
        return stage(known.mapInArrow(run, output), "visits")

    def visit(wanted: DataFrame) -> DataFrame:
        # at most as many numbers as there are cells; the scan then opens no other cell's files
        met = [r.cell for r in wanted.select("cell").distinct().collect()]
        parts = np.ones(int(layer.number.max(initial=0)) + 1, np.int64)
        parts[layer.number] = np.maximum(1, -(-layer.rows // part_rows))
        count = F.get(F.expr(f"array({', '.join(map(str, parts))})"), F.col("cell"))
        stored = spark.read.schema(layer.layout).parquet(f"{layer.path}/vectors").where(F.col("cell").isin(met))
        stored = stored.select(
            key, embedding, F.col("cell").alias("_cell"), F.pmod(F.xxhash64(key), count).cast("int").alias("_part")
        )
        everywhere = F.explode(F.sequence(F.lit(0), count - 1))
        dealt = wanted.select(query_key, embedding, F.col("cell").alias("_cell"), everywhere.alias("_part"))
        groups = int(parts[met].sum())
        return stage(best_per_query(met_in_groups(stored, dealt, k, key, query_key, embedding, groups), k, key, query_key), "hits")

    first = choose(1, asked)
    hits = visit(first)
    kth = hits.where(F.col("rank") == k).select(F.col(query_key).alias("_asked"), F.col("score").alias("_kth"))
    known = asked.join(kth, F.col(query_key).eqNullSafe(F.col("_asked")), "left").select(query_key, embedding, "_kth")
    second = choose(2, known)
    both = hits.drop("rank").unionAll(visit(second).drop("rank"))
    visits = first.unionAll(second).select(query_key, "cell", "turn")
    return best_per_query(both, k, key, query_key), visits


def share_skipped(layer: Cells, queries: int, visits: DataFrame) -> float:
    """Which part of all pairs of a query and a cell was never looked at."""
    return 1 - visits.count() / max(1, queries * len(layer.rows))


def scratch_cells(vectors: DataFrame, key: str, **options) -> Cells:
    """A layer in cells among the intermediates, for one job."""
    return write_cells(vectors, work_path(vectors.sparkSession, "cells"), key, **options)
