"""Versions of a table: field-level differences, fingerprints and layer status."""

from __future__ import annotations

from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructField, StructType

from probity.sources.layers import append_history, path_exists

# Columns a version comparison leaves out besides the key.
UNTRACKED = ("risk_flags", "search_context")
#: The field under which a diff reports that a key has another number of rows.
COPIES = "(copies)"
SEEDS = (0, 1)


def snapshot_diff(
    old: DataFrame,
    new: DataFrame,
    key: str | list[str] = "global_id",
    ignore: tuple[str, ...] = UNTRACKED,
    at: Column | None = None,
) -> DataFrame:
    """One row per key and field whose value differs between two versions.

    Only keys and columns found in both versions are compared; null equals null, a null key
    equals none. Values of one type are compared as such and rendered as text afterwards,
    others as text. The rows of a key are compared as bags: equal rows cancel out, what is
    left is paired in order of content (the last one of the shorter side with all that remain),
    and a key with more rows in one version also has a row for the field ``COPIES``. Both versions are counted in one hash
    aggregate with rows as keys, so nothing is sorted and copies never multiply; only the
    rows that changed are numbered and paired.
    """
    keys = [key] if isinstance(key, str) else list(key)
    tracked = [c for c in old.columns if c in new.columns and c not in (*keys, *ignore)]
    if not tracked:
        tracked_schema = ", ".join(f"`{k}` {old.schema[k].dataType.simpleString()}" for k in keys)
        return old.sparkSession.createDataFrame(
            [], f"{tracked_schema}, field_changed string, old_value string, new_value string, timestamp timestamp"
        )
    same_type = {c for c in tracked if _type(old, c) == _type(new, c)}

    def side(df: DataFrame, is_old: int) -> DataFrame:
        values = [_comparable(df, c) if c in same_type else F.col(c).cast("string").alias(c) for c in tracked]
        known = df.where(F.greatest(F.lit(0), *[F.isnull(k).cast("int") for k in keys]) == 0)
        return known.select(
            *keys, F.struct(*values).alias("_row"), F.lit(is_old).alias("_o"), F.lit(1 - is_old).alias("_n")
        )

    bag = (
        side(old, 1).unionAll(side(new, 0)).groupBy(*keys, "_row").agg(F.sum("_o").alias("_o"), F.sum("_n").alias("_n"))
    )
    copies = bag.groupBy(*keys).agg(F.sum("_o").alias("_olds"), F.sum("_n").alias("_news"))
    copies = copies.where("_olds > 0 AND _news > 0")
    left = bag.where("_o <> _n").join(copies, keys).withColumn("_is_old", F.col("_o") > F.col("_n"))
    turn = Window.partitionBy(*keys, "_is_old").orderBy("_row")
    left = left.withColumn("_turn", F.row_number().over(turn))
    before = left.where("_is_old").select(*keys, "_turn", F.col("_row").alias("_old"))
    after = left.where("NOT _is_old").select(*keys, "_turn", F.col("_row").alias("_new"))
    so_far = Window.partitionBy(*keys).orderBy("_turn")
    both = before.join(after, [*keys, "_turn"], "full").select(
        *keys, *(F.last(c, ignorenulls=True).over(so_far).alias(c) for c in ("_old", "_new"))
    )
    both = both.where("_old IS NOT NULL AND _new IS NOT NULL")

    def change(field: str) -> Column:
        was, now = F.col(f"_old.`{field}`"), F.col(f"_new.`{field}`")
        return F.when(~was.eqNullSafe(now), _changed(F.lit(field), was, now))

    changes = both.select(*keys, F.inline(F.array_compact(F.array(*[change(c) for c in tracked]))))
    counted = copies.where("_olds <> _news").select(
        *keys, F.inline(F.array(_changed(F.lit(COPIES), F.col("_olds"), F.col("_news"))))
    )
    return changes.unionAll(counted).withColumn("timestamp", F.current_timestamp() if at is None else at)


def _changed(field: Column, was: Column, now: Column) -> Column:
    return F.struct(
        field.alias("field_changed"), was.cast("string").alias("old_value"), now.cast("string").alias("new_value")
    )


def log_changes(
    old: DataFrame, new: DataFrame, audit_path: str, key: str | list[str] = "global_id"
) -> int:
    """Appends the differences to the audit history and returns how many there are."""
    now = F.lit(datetime.now(timezone.utc))
    changes = snapshot_diff(old, new, key, at=now).persist()
    try:
        count = changes.count()
        if count:
            append_history(changes, audit_path)
        return count
    finally:
        changes.unpersist()


def changes_per_field(changes: DataFrame) -> DataFrame:
    return changes.groupBy("field_changed").agg(F.count("*").alias("changes"))


def fingerprint(df: DataFrame) -> DataFrame:
    """One row that depends on the rows of a table but not on their order.

    A row's hash covers where its nulls are and how long its lists are, on every level, and
    is taken with two seeds. The exclusive-or alone would cancel equal rows; the sum and the
    count do not.
    """
    first, second = row_hashes(df)
    return df.select(first.alias("h"), second.alias("g")).agg(*content_of("h", "g"))


def row_hashes(df: DataFrame) -> list[Column]:
    """Two hashes of a row's content, by the rules of :func:`fingerprint`."""
    parts = [part for c in df.columns for part in _hashed(_comparable(df, c), _type(df, c))]
    return [F.xxhash64(F.lit(seed), *parts) for seed in SEEDS]


def content_of(first: str, second: str) -> list[Column]:
    """Row count and sums of the hashes of some rows; equal for equal rows in any order."""
    return [
        F.count("*").alias("row_count"),
        F.coalesce(F.bit_xor(first), F.lit(0)).alias("hash_xor"),
        F.coalesce(F.sum(F.col(second).cast("decimal(38,0)")), F.lit(0)).cast("string").alias("hash_sum"),
    ]


def _hashed(value: Column, kind: DataType) -> list[Column]:
    """What the hash of a value is taken of: hashing alone skips nulls and empty lists."""
    if isinstance(kind, StructType):
        return [value.isNull(), *(p for f in kind.fields for p in _hashed(value[f.name], f.dataType))]
    if isinstance(kind, MapType):
        kind = ArrayType(StructType([StructField("key", kind.keyType), StructField("value", kind.valueType)]))
    if isinstance(kind, ArrayType):
        inner = kind.elementType
        return [value.isNull(), F.size(value), F.transform(value, lambda v: F.xxhash64(*_hashed(v, inner)))]
    return [value.isNull(), value]


def same_content(old: DataFrame, new: DataFrame) -> bool:
    """Whether two versions hold the same rows."""
    if sorted(old.columns) != sorted(new.columns):
        return False
    return fingerprint(old).first() == fingerprint(new.select(*old.columns)).first()


def layer_status(spark: SparkSession, layers: dict[str, str | DataFrame]) -> DataFrame:
    """Per layer: ok or missing, row count and fingerprint; ``overall`` is healthy or degraded.

    A layer is a table, or the path of one.
    """
    tables = {
        name: layer
        if isinstance(layer, DataFrame)
        else (spark.read.parquet(layer) if path_exists(spark, layer) else None)
        for name, layer in layers.items()
    }
    overall = "healthy" if all(table is not None for table in tables.values()) else "degraded"

    def status(name: str, table: DataFrame | None) -> DataFrame:
        if table is None:
            counted = spark.range(1).select(
                F.lit(0).cast("bigint").alias("row_count"),
                F.lit(None).cast("bigint").alias("hash_xor"),
                F.lit(None).cast("string").alias("hash_sum"),
            )
        else:
            counted = fingerprint(table)
        state = "missing" if table is None else "ok"
        return counted.select(
            F.lit(name).alias("layer"), F.lit(state).alias("status"), "*", F.lit(overall).alias("overall")
        )

    return reduce(DataFrame.unionByName, [status(name, table) for name, table in tables.items()])


def _type(df: DataFrame, column: str) -> DataType:
    return df.schema[column].dataType


def _comparable(df: DataFrame, column: str) -> Column:
    """Maps have neither order nor hash; their sorted entries have both."""
    if isinstance(_type(df, column), MapType):
        return F.sort_array(F.map_entries(column)).alias(column)
    return F.col(column)
