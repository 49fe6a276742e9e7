"""Exact medians and spreads of all groups at once, however large one group and however many there are.

Groups of few rows are sorted each on its own, once for median and spread. For all others together, a pass counts rows per
group and bucket of the interval that still holds the group's middle ranks, and narrows every
interval to the bucket that holds them. So a group that holds a third of all rows is summed where
its rows lie, and the passes are as many as the most obstinate group needs.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from probity.sources.layers import own_work, stage

from .stats import END_BUCKET, INFINITE, LOG_STEPS

#: Rows that one task may sort for a group, and buckets per group and pass.
FEW_ROWS, BUCKETS = 10_000, 1024
_STATE = ["_lo", "_hi", "_r1", "_r2", "_n"]


def _same_group(by: Sequence[str], left: DataFrame, right: DataFrame) -> Column:
    return reduce(Column.__and__, [left[k].eqNullSafe(right[f"_g{i}"]) for i, k in enumerate(by)])


def _renamed(df: DataFrame, by: Sequence[str]) -> DataFrame:
    return df.withColumnsRenamed({k: f"_g{i}" for i, k in enumerate(by)})


def _midpoint(a: Column, b: Column) -> Column:
    return F.when(a == b, a).otherwise((a + b) / 2)


def _bucket() -> Column:
    """Buckets that grow with the value in the first pass, then equal steps of what is left."""
    x, lo, hi = F.col("_x"), F.col("_lo"), F.col("_hi")
    far = F.when(F.abs(x) == INFINITE, F.signum(x).cast("long") * END_BUCKET)
    wide = far.otherwise(F.floor(F.signum(x) * F.log1p(F.abs(x)) * LOG_STEPS))
    scale = F.when(hi / 2 - lo / 2 > 4e307, F.lit(0.5)).otherwise(F.lit(1.0))
    steps = F.floor((x * scale - lo * scale) / (hi * scale - lo * scale) * BUCKETS)
    return F.when((lo == -INFINITE) | (hi == INFINITE), wide).otherwise(F.least(steps, F.lit(BUCKETS - 1)))


def grouped_medians(df: DataFrame, by: Sequence[str], value: str | Column, few_rows: int = FEW_ROWS) -> DataFrame:
    """One row per group: ``by``, ``n`` values, and their ``median``, the midpoint for an even count.

    Null and NaN are no values; groups without a value have no row. A null key is a group like any
    other. Infinite values have a rank.
    """
    by = list(by)
    with own_work(df.sparkSession) as keep:
        values = _values(df, by, value)
        large = _large(values, by, few_rows)
        small = _sorted(values, large, by).select(*by, F.size("_l").cast("long").alias("n"), _middle(F.col("_l")).alias("median"))
        return keep(small.unionAll(_medians(values, large, by, few_rows)), "grouped-medians")


def _values(df: DataFrame, by: list[str], value: str | Column) -> DataFrame:
    value = F.col(value) if isinstance(value, str) else value
    values = df.select(*by, value.cast("double").alias("_x")).where("_x IS NOT NULL AND NOT isnan(_x)")
    return stage(values, "grouped-values")


def _large(values: DataFrame, by: list[str], few_rows: int) -> DataFrame:
    """The groups of more values than one task may sort, and how many each has; there are few of them."""
    return stage(values.groupBy(*by).agg(F.count("*").alias("_n")).where(F.col("_n") > few_rows), "large-groups")


def _sorted(values: DataFrame, large: DataFrame, by: list[str]) -> DataFrame:
    """The sorted values ``_l`` of every other group. They are dealt out first: no list is begun where rows lie."""
    other = _renamed(large, by)
    few = values.join(other, _same_group(by, values, other), "left_anti").repartition(*by)
    return few.groupBy(*by).agg(F.sort_array(F.collect_list("_x")).alias("_l"))


def _middle(values: Column) -> Column:
    """The median of a sorted list, null for the empty one."""
    n = F.size(values)
    return _midpoint(*[F.get(values, rank.cast("int")) for rank in ((n - 1) / 2, n / 2)])


def _medians(values: DataFrame, large: DataFrame, by: list[str], few_rows: int) -> DataFrame:
    """``by``, ``n`` and ``median`` of large groups."""
    ranks = [((F.col("_n") - 1) / 2).cast("long").alias("_r1"), (F.col("_n") / 2).cast("long").alias("_r2")]
    state = large.select(*by, F.lit(-INFINITE).alias("_lo"), F.lit(INFINITE).alias("_hi"), *ranks, "_n")
    to_sort, found = [state.limit(0)], []
    while state.limit(1).count():
        step = stage(_narrowed(values, state, by), "narrowed-groups")
        found.append(step.where("_median IS NOT NULL").select(*by, "_median"))
        left = step.where("_median IS NULL").select(*by, *_STATE)
        to_sort.append(left.where(F.col("_n") <= few_rows))
        state = stage(left.where(F.col("_n") > few_rows), "open-groups")
    sort = _renamed(reduce(DataFrame.unionAll, to_sort), by)
    inside = (F.col("_x") >= F.col("_lo")) & (F.col("_x") <= F.col("_hi"))
    few = values.join(sort, _same_group(by, values, sort) & inside).groupBy(*by, "_r1", "_r2")
    # no more than ``few_rows`` values of a group are left
    few = few.agg(F.sort_array(F.collect_list("_x")).alias("_l"))
    middle = [F.get("_l", F.col(r).cast("int")) for r in ("_r1", "_r2")]
    found.append(few.select(*by, _midpoint(*middle).alias("_median")))
    medians = _renamed(reduce(DataFrame.unionAll, found), by)
    return large.join(medians, _same_group(by, large, medians)).select(*by, F.col("_n").alias("n"), F.col("_median").alias("median"))


def _narrowed(values: DataFrame, state: DataFrame, by: list[str]) -> DataFrame:
    """The open groups with their next interval, or with their median where that is known."""
    open_ = _renamed(state, by)
    inside = (F.col("_x") >= F.col("_lo")) & (F.col("_x") <= F.col("_hi"))
    rows = values.join(open_, _same_group(by, values, open_) & inside)
    counts = rows.groupBy(*by, "_r1", "_r2", _bucket().alias("_b")).agg(
        F.count("*").alias("_n"), F.min("_x").alias("_lo"), F.max("_x").alias("_hi")
    )
    # at most one row per bucket of a group
    before = Window.partitionBy(*by).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    holds = lambda r: (F.col("_before") <= F.col(r)) & (F.col(r) < F.col("_before") + F.col("_n"))
    one = lambda r: F.max(F.when(holds(r), F.struct("_b", "_lo", "_hi", "_before", "_n")))
    both = counts.groupBy(*by, "_r1", "_r2").agg(one("_r1").alias("_one"), one("_r2").alias("_two"))
    lo, hi = F.col("_one._lo"), F.col("_one._hi")
    # ranks in two buckets are the end of one and the beginning of the next
    known = F.when(F.col("_one._b") != F.col("_two._b"), _midpoint(hi, F.col("_two._lo"))).when(lo == hi, lo)
    off = F.col("_one._before")
    return both.select(
        *by, known.alias("_median"), lo.alias("_lo"), hi.alias("_hi"),
        (F.col("_r1") - off).alias("_r1"), (F.col("_r2") - off).alias("_r2"), F.col("_one._n").alias("_n"),
    )


def grouped_median_and_mad(df: DataFrame, by: Sequence[str], value: str | Column, few_rows: int = FEW_ROWS) -> DataFrame:
    """One row per group: ``by``, ``n``, ``median`` and ``mad``, the median distance from it.

    The distance of an infinite value to an infinite median is no value; a group that has no distance has no ``mad``.
    """
    by = list(by)
    with own_work(df.sparkSession) as keep:
        values = _values(df, by, value)
        large = _large(values, by, few_rows)
        # a small group is sorted once, for both
        small = _sorted(values, large, by).withColumn("median", _middle(F.col("_l")))
        away = F.transform("_l", lambda x: F.abs(x - F.col("median")))
        small = small.withColumn("_away", F.sort_array(F.filter(away, lambda x: ~F.isnan(x))))
        small = small.select(*by, F.size("_l").cast("long").alias("n"), "median", _middle(F.col("_away")).alias("mad"))
        medians = stage(_medians(values, large, by, few_rows), "large-medians")
        other = _renamed(medians, by)
        away = values.join(other, _same_group(by, values, other)).select(*by, F.abs(F.col("_x") - F.col("median")).alias("_away"))
        spread = _renamed(grouped_medians(away, by, "_away", few_rows).select(*by, F.col("median").alias("mad")), by)
        spread = medians.join(spread, _same_group(by, medians, spread), "left").select(*by, "n", "median", "mad")
        return keep(small.unionAll(spread), "grouped-spreads")
