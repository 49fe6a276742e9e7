"""A table as it was: the field-level audit played back from the current version.

The audit has one row per key, field and change. What a field held at a time is the old value of
its first change after that time, and the current value if there was none. Per key and field only
that one change is kept while the history is aggregated, so neither a key with a long history nor
a hot field is ever held whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from .audit import COPIES

_PREFIX = "_was_"


def _after(history: DataFrame, at: Column) -> DataFrame:
    return history.where((F.col("timestamp") > at) & (F.col("field_changed") != COPIES))


def state_at(
    current: DataFrame,
    history: DataFrame,
    at: str | Column,
    key: str | Sequence[str] = "global_id",
    fields: Sequence[str] | None = None,
) -> DataFrame:
    """The rows of ``current`` with the values that their fields had at ``at``; columns unchanged.

    ``history`` are rows as :func:`audit.snapshot_diff` gives them, of runs one after the other.
    ``fields`` are the columns to set back (all but the key, if not named); values are read from
    their text as the column's type, so lists and structures cannot be among them. Keys that were
    not there then, or are not now, are no changes to the audit: the rows of now come back, with
    the values that are known of them. Rows with a null key, and of keys that repeat, are set back
    by what the audit says of their key. Of two changes of a field at one time the smaller old value counts.
    """
    keys = [key] if isinstance(key, str) else list(key)
    at = F.lit(at).cast("timestamp") if isinstance(at, str) else at
    fields = [c for c in current.columns if c not in keys] if fields is None else list(fields)
    nested = [f for f in fields if current.schema[f].dataType.typeName() in ("array", "map", "struct")]
    if nested:
        raise ValueError(f"values of these columns cannot be read from the audit: {', '.join(nested)}")

    def first_change(field: str) -> Column:
        here = F.struct("timestamp", F.col("old_value").isNotNull().alias("known"), F.col("old_value").alias("value"))
        return F.min(F.when(F.col("field_changed") == field, here)).alias(_PREFIX + field)

    wanted = _after(history, at).where(F.col("field_changed").isin(fields))
    back = wanted.groupBy(*keys).agg(*[first_change(f) for f in fields]) if fields else wanted.select(*keys).distinct()
    joined = current.join(back, keys, "left")

    def then(field: str) -> Column:
        was = F.col(_PREFIX + field)
        value = was["value"].cast(current.schema[field].dataType)
        return F.when(was.isNotNull(), value).otherwise(F.col(field)).alias(field)

    return joined.select(*[then(c) if c in fields else F.col(c) for c in current.columns])


def periods(history: DataFrame, current: DataFrame, field: str, key: str = "global_id") -> DataFrame:
    """``key, value, since, until`` of one field: which value it held from when to when.

    ``since`` is null for what was there before the first change, ``until`` for what is there now.
    """
    changes = history.where(F.col("field_changed") == field).select(key, "timestamp", "old_value", "new_value")
    ended = changes.select(key, F.col("timestamp").alias("until"), F.col("old_value").alias("value"))
    # one period ends where the next begins; only the changes of this one field are put in order
    order = Window.partitionBy(key).orderBy("until")
    ended = ended.withColumn("since", F.lag("until").over(order))
    last = changes.groupBy(key).agg(F.max("timestamp").alias("since"))
    now = current.select(key, F.col(field).cast("string").alias("value")).join(last, key, "left")
    now = now.select(key, "value", "since", F.lit(None).cast("timestamp").alias("until"))
    return ended.select(key, "value", "since", "until").unionByName(now)
