"""Pages and point lookups."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from probity import functions as P

# Page size if none is given, and the largest allowed.
DEFAULT_LIMIT = 20
MAX_LIMIT = 100

SHALLOW = 100_000  # rows a sorted take may hold
SPLITS = 64
SAMPLE = 2048


@dataclass(frozen=True)
class Page:
    rows: DataFrame
    total: int
    limit: int
    offset: int
    has_next: bool


def page_limit(limit: int | None) -> int:
    """The default for none; a size that is not allowed is refused, not cut."""
    if limit is None:
        return DEFAULT_LIMIT
    if not 1 <= limit <= MAX_LIMIT:
        raise ValueError(f"a page has 1 to {MAX_LIMIT} rows, not {limit}")
    return limit


def page_offset(offset: int) -> int:
    if offset < 0:
        raise ValueError(f"the offset {offset} is negative")
    return offset


def _order(df: DataFrame, key: str, descending: bool) -> list[Column]:
    """By key; rows without one come last, whatever the direction, in an order of their own."""
    column = F.col(key).desc_nulls_last() if descending else F.col(key).asc_nulls_last()
    return [column, F.when(F.col(key).isNull(), F.xxhash64(*_sortable(df)))]


def page(
    df: DataFrame,
    key: str,
    limit: int | None = None,
    offset: int = 0,
    descending: bool = False,
    shallow: int = SHALLOW,
) -> DataFrame:
    """One page in the order of a unique key; empty beyond the end. Rows without a key come last.

    A sorted take holds ``offset + limit`` rows in one place. For a deep offset the rows are
    first counted per key range, and only the range that holds the page is sorted. The
    ranges come from a sample, the counts are exact, so the page is exact as well.
    """
    size, offset = page_limit(limit), page_offset(offset)
    order = _order(df, key, descending)
    if offset + size > shallow:
        df, offset = _from_range(df, key, offset, descending, shallow)
    return df.orderBy(*order).offset(offset).limit(size)


def page_after(
    df: DataFrame,
    key: str,
    last: object | None,
    limit: int | None = None,
    descending: bool = False,
    keyless: int = 0,
) -> DataFrame:
    """The page that follows the key ``last``: its cost does not grow with the depth.

    ``None`` starts at the first row. Rows without a key come last; once a page ends in them,
    pass how many of them were seen as ``keyless`` to go on.
    """
    column, size = F.col(key), page_limit(limit)
    if keyless:
        return df.where(column.isNull()).orderBy(*_order(df, key, descending)).offset(keyless).limit(size)
    if last is not None:
        beyond = column < F.lit(last) if descending else column > F.lit(last)
        df = df.where(beyond | column.isNull())
    return df.orderBy(*_order(df, key, descending)).limit(size)


def page_info(df: DataFrame, limit: int | None = None, offset: int = 0) -> DataFrame:
    """The envelope of a page: total, limit, offset and whether another page follows."""
    size, offset = page_limit(limit), page_offset(offset)
    return df.agg(F.count("*").alias("total")).select(
        "total",
        F.lit(size).cast("bigint").alias("limit"),
        F.lit(offset).cast("bigint").alias("offset"),
        (F.lit(offset + size) < F.col("total")).alias("has_next"),
    )


def fetch_page(df: DataFrame, key: str, limit: int | None = None, offset: int = 0) -> Page:
    total, size, offset, has_next = page_info(df, limit, offset).first()
    return Page(page(df, key, limit, offset), total, size, offset, has_next)


def lookup(df: DataFrame, column: str, value: object) -> DataFrame:
    """The row with this id, empty if there is none; of several the smallest."""
    return df.where(F.col(column) == F.lit(value)).orderBy(*_sortable(df)).limit(1)


def response_rows(df: DataFrame, list_column: str = "risk_flags", nested: bool = False) -> DataFrame:
    """Rows as they are handed out: lists without null, never null themselves."""
    return df.withColumn(list_column, P.without_nulls(list_column, nested))


def _from_range(
    df: DataFrame, key: str, offset: int, descending: bool, shallow: int
) -> tuple[DataFrame, int]:
    """The rows from the start of the key range that holds ``offset``, and the offset there."""
    column = F.col(key)
    rows = df.select(key).where(column.isNotNull())
    while True:
        counts = (
            rows.groupBy(_range_number(column, _split_points(rows, key)).alias("number"))
            .agg(F.count("*").alias("n"), F.min(key).alias("lo"), F.max(key).alias("hi"))
            .collect()
        )
        for span in sorted(counts, key=lambda row: row.number, reverse=descending):
            if offset < span.n:
                break
            offset -= span.n
        else:
            return df.where(column.isNull()), offset
        if span.n <= shallow or len(counts) == 1:
            here = column <= F.lit(span.hi) if descending else column >= F.lit(span.lo)
            return df.where(here | column.isNull()), offset
        rows = rows.where(column.between(span.lo, span.hi))


def _split_points(rows: DataFrame, key: str) -> list:
    """Keys that cut the rows into ranges of similar size, out of a sample by hash."""
    sample = rows.orderBy(F.xxhash64(key), key).limit(SAMPLE).collect()
    values = sorted({row[key] for row in sample})
    step = max(1, len(values) // SPLITS)
    return values[step::step]


def _range_number(column: Column, bounds: list) -> Column:
    """How many of the bounds are at most the key."""
    if not bounds:
        return F.lit(0)
    return F.size(F.filter(F.array(*[F.lit(b) for b in bounds]), lambda b: b <= column))


def _sortable(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if f.dataType.typeName() != "map"]
