"""Measures over list columns, computed inside the row: nothing is exploded or shuffled."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from ._args import ColumnOrName, as_column
from .numbers import to_double, to_long
from .text import fold_accents


def list_count(items: ColumnOrName) -> Column:
    return F.coalesce(F.array_size(as_column(items)), F.lit(0)).cast("bigint")


def list_sum(items: ColumnOrName, field: str = "decValor") -> Column:
    """Sum of one numeric field; what cannot be read counts 0, no list gives 0."""
    values = F.transform(as_column(items), lambda item: F.coalesce(to_double(item[field]), F.lit(0.0)))
    return F.coalesce(F.aggregate(values, F.lit(0.0), lambda total, v: total + v), F.lit(0.0))


def public_experience(
    items: ColumnOrName,
    sector_field: str = "strSector",
    years_field: str = "intAnioTrabajo",
    ignore_accents: bool = False,
) -> Column:
    """Years worked in the public sector; a public job without years counts one.

    ``ignore_accents`` lets an accented sector name count as well.
    """

    def years(job: Column) -> Column:
        sector = F.upper(job[sector_field].cast("string"))
        if ignore_accents:
            sector = fold_accents(sector)
        worked = F.when(job[years_field].isNull(), F.lit(1)).otherwise(to_long(job[years_field]))
        return F.when(F.contains(sector, F.lit("PUBLICO")), F.coalesce(worked, F.lit(0))).otherwise(F.lit(0))

    total = F.aggregate(
        F.transform(as_column(items), years), F.lit(0).cast("bigint"), lambda done, y: done + y
    )
    return F.coalesce(total, F.lit(0)).cast("bigint")


def sum_across(*values: ColumnOrName) -> Column:
    """Sum over columns of one row in which null counts 0."""
    return reduce(lambda a, b: a + b, [F.coalesce(as_column(v), F.lit(0)) for v in values])


def without_nulls(items: ColumnOrName, nested: bool = False) -> Column:
    """A list fit for output: no null list, no null item, one level."""
    items = as_column(items)
    if nested:
        items = F.flatten(F.filter(items, lambda inner: inner.isNotNull()))
    return F.coalesce(F.array_compact(items), F.array().cast("array<string>"))
