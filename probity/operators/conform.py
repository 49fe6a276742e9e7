"""Schema conformance, stacking and deterministic survivors."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import MapType, NumericType, StructType

from probity import functions as P


def rename_fields(df: DataFrame, mapping: Mapping[str, str], dtype: str = "string") -> list[Column]:
    """Source fields cast and renamed; a typed null where the table lacks the field."""
    present = set(df.columns)
    return [
        (F.col(source) if source in present else F.lit(None)).cast(dtype).alias(target)
        for source, target in mapping.items()
    ]


def align(df: DataFrame, schema: StructType) -> DataFrame:
    """Exactly the columns of ``schema``, in its order and types; absent ones are null."""
    present = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def unnest(df: DataFrame, *struct_columns: str) -> DataFrame:
    """Hoists the fields of struct columns; columns that are not there are ignored."""
    inner = [name for name in struct_columns if name in df.columns]
    outer = [F.col(name) for name in df.columns if name not in inner]
    return df.select(*outer, *[F.col(f"{name}.*") for name in inner])


def money(df: DataFrame, name: str, repeated_marks: bool = False) -> Column:
    """A money column as double: numbers as they are, text by the separator rules."""
    if isinstance(df.schema[name].dataType, NumericType):
        return F.coalesce(F.col(name).cast("double"), F.lit(0.0))
    return P.parse_money(name) if repeated_marks else P.clean_money(name)


def stack(frames: Iterable[DataFrame], how: str = "strict") -> DataFrame:
    """Rows of all frames: ``strict`` (same names and types), ``relaxed`` (same names,
    widened types) or ``diagonal`` (any names, absent columns are null)."""
    frames = list(frames)
    if how == "strict":
        first = [(f.name, f.dataType) for f in frames[0].schema.fields]
        for other in frames[1:]:
            if [(f.name, f.dataType) for f in other.schema.fields] != first:
                raise ValueError(f"schemas differ: {frames[0].schema} / {other.schema}")
    elif how not in ("relaxed", "diagonal"):
        raise ValueError(f"unknown way to stack: {how}")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=how == "diagonal"), frames)


def first_per_key(df: DataFrame, keys: list[str], order_by: list[str | Column]) -> DataFrame:
    """One row per key: the first in ``order_by``, ties broken by the remaining columns.

    An aggregate, not a window: rows of a hot key are already reduced before the shuffle.
    Spark sorts the rows for it on either side of the shuffle, as its hash aggregate cannot
    hold a struct; where many rows are equal, pass ``df.distinct()``, which is hashed. Maps
    have no order and break no ties.
    """
    rest = [name for name in df.columns if name not in keys]
    if not rest:
        return df.distinct()
    order = [F.col(o) if isinstance(o, str) else o for o in order_by]
    ties = [F.sort_array(F.map_entries(c)) if isinstance(df.schema[c].dataType, MapType) else F.col(c) for c in rest]
    best = F.min_by(F.struct(*rest), F.struct(*order, *ties))
    return df.groupBy(*keys).agg(best.alias("_first")).select(*keys, "_first.*")
