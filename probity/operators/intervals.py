"""What was in force when: joins of days with intervals of days, without comparing each with each.

A day is compared with the intervals of its keys where these have few. For all other keys every interval is cut into few pieces that begin and end at powers of two (a day, two days, four
...), at most two of a size. A day lies in exactly one piece of each size, so day and interval meet
by equality of (keys, size, piece), and meet once if the day lies within. Long and open intervals
have hardly more pieces than short ones.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from probity.sources.layers import stage

#: Sizes of pieces: 2**0 to 2**(SIZES - 1) days. Days are counted from ORIGIN days before 1970.
SIZES, ORIGIN = 23, 1 << 20
#: Rows of a piece, or of keys with few intervals, from which on they are dealt to several tasks.
HOT_ROWS = 100_000
#: Intervals of the same keys up to which each of their days is compared with each of them.
FEW_INTERVALS = 8

_PIECE = ["_size", "_piece"]


def day_number(day: str | Column) -> Column:
    """Days since long before our era; text that is no date, and null, give null."""
    day = F.col(day) if isinstance(day, str) else day
    return (F.unix_date(day.try_cast("date")) + F.lit(ORIGIN)).cast("int")


def pieces(first: Column, last: Column) -> Column:
    """The pieces (size, piece) of the days from ``first`` to ``last``; none if ``last`` is before ``first``."""

    def of_size(size: Column) -> Column:
        width = F.call_function("shiftleft", F.lit(1), size)
        low, high = F.ceil(first / width).cast("int"), F.floor((last + 1) / width).cast("int")
        left = (low < high) & (low % 2 == 1)
        right = (high % 2 == 1) & (high - 1 >= low + left.cast("int"))
        piece = lambda number: F.struct(size.alias("_size"), number.alias("_piece"))
        return F.array_compact(F.array(F.when(left, piece(low)), F.when(right, piece(high - 1))))

    return F.flatten(F.transform(F.sequence(F.lit(0), F.lit(SIZES - 1)), of_size))


def valid_days(start: str | Column, end: str | Column) -> tuple[Column, Column]:
    """First and last day of an interval; an open end reaches as far as days are counted."""
    most = (1 << (SIZES - 1)) - 1
    bound = lambda value, otherwise: F.least(F.greatest(F.coalesce(day_number(value), F.lit(otherwise)), F.lit(0)), F.lit(most))
    return bound(start, 0), bound(end, most)


def in_force(
    events: DataFrame,
    intervals: DataFrame,
    on: Sequence[str],
    at: str,
    start: str,
    end: str,
    hot_rows: int = HOT_ROWS,
    few_intervals: int = FEW_INTERVALS,
) -> DataFrame:
    """Each event with each interval of the same keys that its day ``at`` lies in, both ends included.

    A null (or undatable) ``start`` means since ever, a null ``end`` until further notice, both null
    always; an interval that ends before it starts is never in force. Events without a day, and null
    keys, meet nothing. Columns are those of the events, then those of the intervals without the
    keys; of equal rows each counts. Keys of up to ``few_intervals`` intervals compare each event
    with each of them, so an event becomes that many rows at most; of all others events are cut
    into pieces. Keys and pieces that many events share are dealt to several tasks.
    """
    on = list(on)
    other = [c for c in intervals.columns if c not in on]
    clash = sorted({c.lower() for c in other} & {c.lower() for c in events.columns})
    if clash:
        raise ValueError(f"columns on both sides: {', '.join(clash)}")
    keyed = F.greatest(F.lit(0), *[F.isnull(k).cast("int") for k in on]) == 0
    first, last = valid_days(start, end)
    held = intervals.where(keyed).select("*", first.alias("_first"), last.alias("_last"))
    dated = events.withColumn("_day", day_number(at)).where(keyed & F.col("_day").isNotNull())
    many = held.groupBy(*on).agg(F.count("*").alias("_n")).where(F.col("_n") > few_intervals).select(*on)
    many = stage(many, "many-intervals")
    if many.isEmpty():
        return _compared(dated, held, on, events.columns, other, hot_rows)
    direct = _compared(dated.join(many, on, "left_anti"), held.join(many, on, "left_anti"), on, events.columns, other, hot_rows)
    return direct.unionAll(
        _met_in_pieces(dated.join(many, on, "left_semi"), held.join(many, on, "left_semi"), on, events.columns, other, hot_rows)
    )


def _compared(dated: DataFrame, held: DataFrame, on: list[str], columns: list[str], other: list[str], hot_rows: int) -> DataFrame:
    """Events next to all intervals of their keys, those kept that their day lies in."""
    within = F.col("_day").between(F.col("_first"), F.col("_last"))
    return _shared_join(dated, held, on, columns, hot_rows).where(within).select(*columns, *other)


def _met_in_pieces(dated: DataFrame, held: DataFrame, on: list[str], columns: list[str], other: list[str], hot_rows: int) -> DataFrame:
    """Events next to the intervals that have a piece their day lies in."""
    held = held.select(*on, *other, F.inline(pieces(F.col("_first"), F.col("_last"))))
    held = stage(held, "interval-pieces")

    # only sizes that some interval has, of which there are at most SIZES
    sizes = sorted(r[0] for r in held.select("_size").distinct().collect())
    spots = F.array(*[F.struct(F.lit(s).alias("_size"), F.shiftright(F.col("_day"), s).alias("_piece")) for s in sizes])
    if not sizes:
        spots = F.array().cast("array<struct<_size:int,_piece:int>>")
    asked = dated.select(*columns, F.inline(spots))
    return _shared_join(asked, held, [*on, *_PIECE], columns, hot_rows).select(*columns, *other)


def _shared_join(asked: DataFrame, held: DataFrame, place: list[str], columns: list[str], hot_rows: int) -> DataFrame:
    """An inner join by ``place``, where a place with many rows on the left is dealt to several tasks."""
    crowds = asked.groupBy(*place).agg(F.count("*").alias("_rows")).where(F.col("_rows") > hot_rows)
    hot = stage(crowds.select(*place, F.ceil(F.col("_rows") / hot_rows).cast("int").alias("_shares")), "hot-pieces")
    shares = F.coalesce("_shares", F.lit(1))
    asked = asked.join(hot, place, "left").withColumn("_share", F.pmod(F.xxhash64(*columns), shares).cast("int"))
    held = held.join(hot, place, "left").withColumn("_share", F.explode(F.sequence(F.lit(0), shares - 1)))
    return asked.drop("_shares").join(held.drop("_shares"), [*place, "_share"])


def in_force_on(intervals: DataFrame, day: str | Column, start: str, end: str) -> DataFrame:
    """The intervals in force on one day, by the same rules."""
    wanted = day_number(F.lit(day) if isinstance(day, str) else day)
    first, last = valid_days(start, end)
    return intervals.where(wanted.between(first, last))
