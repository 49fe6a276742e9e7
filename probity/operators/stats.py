"""Exact global order statistics by narrowing an interval: no sort, no single-task state."""

from __future__ import annotations

import math

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, functions as F

LOG_STEPS = 16  # buckets per unit of log(1 + |x|) in the first pass
LINEAR_BUCKETS = 4096  # buckets per later pass
INFINITE, END_BUCKET = float("inf"), 1 << 40  # farther out than any bucket of a finite value
FEW_ROWS = 50_000  # an interval this small is sorted instead of split again


def exact_median(df: DataFrame, value: str | Column, few_rows: int = FEW_ROWS) -> float | None:
    """The median, midpoint of the two middle values for an even count.

    Each pass counts the rows per bucket of the interval that still holds the middle
    ranks, and keeps the bucket that holds them. Buckets are a monotone function of the
    value, so ranks carry over exactly. A pass is one map-side combined aggregate whose
    result is bounded by the bucket number, whatever the row count or the skew. Infinite
    values have buckets of their own at the ends. Null and NaN are no values and are left out.
    """
    value = F.col(value) if isinstance(value, str) else value
    x = F.col("x")
    values = df.select(value.cast("double").alias("x")).where(
        x.isNotNull() & ~F.isnan(x)
    )
    bucket = F.floor(F.signum(x) * F.log1p(F.abs(x)) * LOG_STEPS)
    bucket = F.when(F.abs(x) == INFINITE, F.signum(x).cast("long") * END_BUCKET).otherwise(bucket)
    interval = values
    below = 0
    ranks: tuple[int, int] | None = None
    while True:
        counts = (
            interval.groupBy(bucket.alias("b"))
            .agg(F.count("*").alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi"))
            .orderBy("b")
            .collect()
        )
        if ranks is None:
            total = sum(row.n for row in counts)
            if total == 0:
                return None
            ranks = ((total - 1) // 2, total // 2)
        first, before_first = _bucket_of(counts, below, ranks[0])
        second, _ = _bucket_of(counts, below, ranks[1])
        if first is not second:
            # the ranks are neighbours, so they are the end of one bucket and the start of the next
            return _midpoint(first.hi, second.lo)
        if first.lo == first.hi:
            return first.lo
        interval = values.where((x >= first.lo) & (x <= first.hi))
        below = before_first
        if first.n <= few_rows:
            middle = (
                interval.orderBy("x").offset(ranks[0] - below).limit(ranks[1] - ranks[0] + 1).collect()
            )
            return _midpoint(middle[0].x, middle[-1].x)
        bucket = _linear_bucket(x, first.lo, first.hi)


def median_and_mad(
    df: DataFrame, value: str | Column, approx: bool = False
) -> tuple[float | None, float | None]:
    """Median and median absolute deviation from it; the distance of an infinite value to an
    infinite median is no value.

    Only the value column is kept between passes, on executor memory and disk; blocks of
    lost executors are computed again. ``approx`` takes one quantile sketch per number.
    """
    value = F.col(value) if isinstance(value, str) else value
    values = df.select(value.cast("double").alias("v")).where("v IS NOT NULL")
    if approx:
        return _approx_median_and_mad(values)
    values = values.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        median = exact_median(values, "v")
        if median is None:
            return None, None
        return median, exact_median(values, F.abs(F.col("v") - F.lit(median)))
    finally:
        values.unpersist()


def _approx_median_and_mad(values: DataFrame) -> tuple[float | None, float | None]:
    median = values.agg(F.percentile_approx("v", 0.5)).first()[0]
    if median is None:
        return None, None
    spread = F.abs(F.col("v") - F.lit(median))
    return median, values.agg(F.percentile_approx(spread, 0.5)).first()[0]


def _bucket_of(counts, below: int, rank: int):
    for row in counts:
        if rank < below + row.n:
            return row, below
        below += row.n
    raise AssertionError("the rank lies outside the interval")


def _linear_bucket(x: Column, lo: float, hi: float) -> Column:
    """Equal steps between lo and hi; they never share a bucket, so every pass narrows."""
    scale = 0.5 if math.isinf(hi - lo) else 1.0
    share = (x * scale - F.lit(lo * scale)) / F.lit(hi * scale - lo * scale)
    return F.least(F.floor(share * LINEAR_BUCKETS), F.lit(LINEAR_BUCKETS - 1))


def _midpoint(a: float, b: float) -> float:
    return a if a == b else (a + b) / 2
