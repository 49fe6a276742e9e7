"""Numbers out of dirty text. ANSI casts raise, so only guarded ``try_cast`` is used."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ._args import ColumnOrName, as_column

# try_cast alone would also take '10d', ' 1' and 'NaN'.
_DECIMAL = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\z"
_INTEGER = r"^[+-]?[0-9]+\z"


def to_double(value: ColumnOrName) -> Column:
    """Double, or null where the text is not a plain decimal number."""
    text = as_column(value).cast("string")
    return F.when(text.rlike(_DECIMAL), text.try_cast("double"))


def to_long(value: ColumnOrName) -> Column:
    """Long, or null where the text is not a whole number."""
    text = as_column(value).cast("string")
    return F.when(text.rlike(_INTEGER), text.try_cast("bigint"))


def clean_money(text: ColumnOrName) -> Column:
    """Money text to double by the fixed separator rules; what cannot be read is 0.

    A ``.`` or ``,`` before three closing digits is a thousands mark, the first comma
    left over is the decimal mark, and every other character is dropped (sign included).
    For numeric columns use :func:`probity.operators.conform.money`.
    """
    kept = F.regexp_replace(F.coalesce(as_column(text).cast("string"), F.lit("0")), r"[^\p{Nd}.,]", "")
    no_dots = F.regexp_replace(kept, r"\.([0-9]{3})(,|\z)", "$1$2")
    no_commas = F.regexp_replace(no_dots, r",([0-9]{3})(\.|\z)", "$1$2")
    one_mark = F.regexp_replace(no_commas, r"^([^,]*),", "$1.")
    return F.coalesce(one_mark.try_cast("double"), F.lit(0.0))


def parse_money(text: ColumnOrName) -> Column:
    """Money text to double, also with repeated thousands marks, ``S/.`` and a sign.

    The last mark is the decimal mark unless exactly three digits follow it and the
    part before it is neither 0 nor grouped by the other mark.
    """
    raw = F.coalesce(as_column(text).cast("string"), F.lit(""))
    number = F.regexp_extract(raw, r"([0-9][0-9.,]*[0-9]|[0-9])", 1)
    negative = raw.rlike(r"^[^0-9]*-[^0-9]*[0-9]")
    fraction = F.regexp_extract(number, r"[.,]([0-9]*)\z", 1)
    mark = F.regexp_extract(number, r"([.,])[0-9]*\z", 1)
    whole = F.regexp_extract(number, r"^(.*)[.,][0-9]*\z", 1)
    other_mark = F.when(mark == ".", F.lit(",")).otherwise(F.lit("."))
    has_decimals = (
        (mark != "")
        & ~F.contains(whole, mark)
        & ((F.length(fraction) != 3) | (whole == "0") | F.contains(whole, other_mark))
    )
    digits = F.regexp_replace(number, "[.,]", "")
    decimal = F.concat(F.regexp_replace(whole, "[.,]", ""), F.lit("."), fraction)
    amount = F.when(has_decimals, decimal).otherwise(digits).try_cast("double")
    return F.coalesce(F.when(negative, -amount).otherwise(amount), F.lit(0.0))


def round_half_up(value: Column, digits: int = 2) -> Column:
    """Rounding of the binary double itself, for values that are not negative."""
    scale = float(10**digits)
    return F.floor(value * F.lit(scale) + F.lit(0.5)) / F.lit(scale)
