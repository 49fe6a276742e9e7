"""Versions of a table in key ranges with a fingerprint of each, so that a diff reads only what differs.

A layer is written by ranges of its key, with a manifest that has one row per range: its row count
and two hashes of its rows in any order. The next version takes over the bounds, so equal ranges of
both versions can be told by their manifests alone, and their files are never opened.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from probity.sources.layers import append_history, delete, path_exists, replace_layer, write_layer

from .audit import UNTRACKED, content_of, row_hashes, snapshot_diff

#: Ranges of a layer, and how exact the quantiles are that bound them.
RANGES, ACCURACY = 128, 10_000
_RANGE = "key_range"


@dataclass(frozen=True)
class Ranged:
    """A layer in ranges: where it is, its key, the bounds between its ranges, and its columns."""

    path: str
    key: str
    bounds: list
    layout: str

    def rows(self, spark: SparkSession, ranges: list[int] | None = None) -> DataFrame:
        """The rows of some ranges, or of all; files of other ranges are not opened."""
        held = spark.read.schema(f"{self.layout}, {_RANGE} int").parquet(f"{self.path}/rows")
        return (held if ranges is None else held.where(F.col(_RANGE).isin(ranges))).drop(_RANGE)

    def manifest(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.path}/manifest")


def range_bounds(df: DataFrame, key: str, ranges: int = RANGES) -> list:
    """Keys that part the rows into about equal ranges, taken from quantiles, or from a sample of texts."""
    kind = df.schema[key].dataType.typeName()
    known = df.where(F.col(key).isNotNull())
    shares = [i / ranges for i in range(1, ranges)]
    if not shares:
        return []
    if kind in ("string", "binary", "boolean", "array", "struct"):
        # by the hash of the key, so that every version and every run sees the same sample
        every = max(1, known.count() // (ranges * 100))
        some = known.select(key).where(F.pmod(F.xxhash64(key), F.lit(every)) == 0).distinct()
        numbered = [r[0] for r in some.orderBy(key).collect()]  # about 100 keys per range
        return sorted({numbered[int(s * len(numbered))] for s in shares}) if numbered else []
    found = known.agg(F.percentile_approx(key, shares, ACCURACY)).first()[0]
    return sorted(set(found or []))


def range_of(key: str, bounds: list) -> Column:
    """The number of a key's range: how many bounds are not above it; -1 for a null key."""
    if not bounds:
        return F.when(F.col(key).isNull(), -1).otherwise(0)
    below = F.size(F.filter(F.array(*[F.lit(b) for b in bounds]), lambda b: b <= F.col(key)))
    return F.when(F.col(key).isNull(), -1).otherwise(below)


def write_ranged(df: DataFrame, path: str, key: str = "global_id", like: Ranged | None = None, ranges: int = RANGES) -> Ranged:
    """Writes a version with its manifest and replaces what is at ``path``.

    Bounds are those of ``like``, an earlier version, if given; else they are found anew.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    bounds = range_bounds(df, key, ranges) if like is None else like.bounds
    new = f"{path}.new"
    delete(spark, new)
    placed = df.withColumn(_RANGE, range_of(key, bounds))
    # a range is one task's; one that much of the table falls into is dealt by the hash of its rows
    spread = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) // (len(bounds) + 1))
    dealt = placed.repartition(_RANGE, F.pmod(row_hashes(df)[0], F.lit(spread)))
    write_layer(dealt, f"{new}/rows", partition_by=[_RANGE])
    layout = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    ranged = Ranged(new, key, bounds, layout)
    rows = spark.read.schema(f"{layout}, {_RANGE} int").parquet(f"{new}/rows")
    first, second = row_hashes(rows.drop(_RANGE))
    sums = rows.select(_RANGE, first.alias("_h"), second.alias("_g")).groupBy(_RANGE).agg(*content_of("_h", "_g"))
    write_layer(sums.coalesce(1), f"{new}/manifest")
    kind = df.schema[key].dataType.simpleString()
    about = spark.createDataFrame([(key, bounds, layout)], f"key string, bounds array<{kind}>, layout string")
    write_layer(about.coalesce(1), f"{new}/about")
    replace_layer(spark, new, path)
    return Ranged(path, key, bounds, ranged.layout)


def read_ranged(spark: SparkSession, path: str) -> Ranged:
    path = path.rstrip("/")
    row = spark.read.parquet(f"{path}/about").first()
    return Ranged(path, row["key"], list(row["bounds"]), row["layout"])


def changed_ranges(spark: SparkSession, old: Ranged, new: Ranged) -> list[int] | None:
    """The ranges whose rows differ, from the manifests alone; None if the versions cannot be compared so.

    They cannot if bounds or columns differ. A manifest has as many rows as there are ranges.
    """
    if (old.key, old.bounds, old.layout) != (new.key, new.bounds, new.layout):
        return None
    was, now = ({r[_RANGE]: tuple(r)[1:] for r in v.manifest(spark).collect()} for v in (old, new))
    return sorted(n for n in was.keys() | now.keys() if was.get(n) != now.get(n))


def ranged_diff(
    spark: SparkSession, old: Ranged, new: Ranged, ignore: tuple[str, ...] = UNTRACKED, at: Column | None = None
) -> DataFrame:
    """What :func:`audit.snapshot_diff` gives for two versions, from the ranges that differ."""
    ranges = changed_ranges(spark, old, new)
    # a range that is the same in both versions has no change, and a key is in the same range of both
    return snapshot_diff(old.rows(spark, ranges), new.rows(spark, ranges), old.key, ignore, at)


def log_ranged_version(df: DataFrame, path: str, audit_path: str, key: str = "global_id", at: Column | None = None) -> int:
    """Replaces the version at ``path`` and appends what has changed; returns how many changes there are."""
    spark, path = df.sparkSession, path.rstrip("/")
    if not path_exists(spark, f"{path}/about/_SUCCESS"):
        write_ranged(df, path, key)
        return 0
    old = read_ranged(spark, path)
    new = write_ranged(df, f"{path}.next", key, like=old)
    changes = ranged_diff(spark, old, new, at=at).persist()
    try:
        count = changes.count()
        if count:
            append_history(changes, audit_path)
    finally:
        changes.unpersist()
    replace_layer(spark, new.path, path)
    return count
