"""Distributions on all levels of a hierarchy, exact, and from a layer of mergeable sketches.

Counts add up, distinct counts do not. A layer keeps, for each of the finest groups, the row count
and a sketch of the different values; any coarser level, and any union of layers (days, regions,
runs), is had by merging sketches, without the rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

#: Sketches have 2**SKETCH_BITS registers; the relative error is about 1.04 / sqrt of that (0.8 %).
SKETCH_BITS = 14
#: The level of a row: one bit per column, the first column's the highest, set where the column is summed over.
LEVEL = "level"


def rolled_up(df: DataFrame, by: Sequence[str], distinct: str | Column | None = None) -> DataFrame:
    """``by``, ``level``, ``entities`` and, if asked for, ``distinct_values``, for every prefix of ``by``.

    The last row counts all. A null in a column is a group of its own and is told from a subtotal by
    ``level``. Nulls of ``distinct`` are no values. No rows give the total of zero.
    """
    counts = [F.count(F.lit(1)).alias("entities")]
    if distinct is not None:
        counts.append(F.count_distinct(distinct).alias("distinct_values"))
    return _with_total(df.rollup(*by).agg(F.grouping_id().cast("long").alias(LEVEL), *counts), by, counts, df)


def _with_total(rolled: DataFrame, by: Sequence[str], counts: list[Column], df: DataFrame) -> DataFrame:
    """A roll-up of no rows has no total in Spark, where a plain aggregate has one."""
    nothing = df.agg(*counts).where("entities = 0")
    names = [F.lit(None).cast(df.schema[c].dataType).alias(c) for c in by]
    total = nothing.select(*names, F.lit((1 << len(by)) - 1).cast("long").alias(LEVEL), *nothing.columns)
    return rolled.unionByName(total)


def sketch_layer(df: DataFrame, by: Sequence[str], distinct: str | Column, bits: int = SKETCH_BITS) -> DataFrame:
    """``by``, ``entities``, ``sketch`` of each finest group; a layer to be written and merged later.

    Values are told apart by what they are as text, so that numbers of any type can be counted.
    """
    value = (F.col(distinct) if isinstance(distinct, str) else distinct).cast("string")
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("entities"), F.hll_sketch_agg(value, bits).alias("sketch"))


def merged(layers: Sequence[DataFrame], by: Sequence[str]) -> DataFrame:
    """One layer of several of the same columns: counts add up, sketches unite."""
    rows = reduce(DataFrame.unionByName, layers)
    return rows.groupBy(*by).agg(F.sum("entities").alias("entities"), F.hll_union_agg("sketch").alias("sketch"))


def rolled_up_layer(layer: DataFrame, by: Sequence[str]) -> DataFrame:
    """What :func:`rolled_up` gives, from a layer; ``distinct_values`` is an estimate."""
    unions = [F.sum("entities").alias("entities"), F.hll_union_agg("sketch").alias("_sketch")]
    rolled = layer.rollup(*by).agg(F.grouping_id().cast("long").alias(LEVEL), *unions)
    estimate = F.hll_sketch_estimate("_sketch").alias("distinct_values")
    return rolled.select(*by, LEVEL, "entities", estimate)
