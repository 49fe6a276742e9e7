"""What the operators share: word rules, lower-casing of A-Z, row ids, small tables."""

from __future__ import annotations

import string
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from probity._shipping import ship_by_value

ship_by_value(__name__)

#: Words as runs of anything but ASCII blanks, and as runs of a-z, 0-9 and letters beyond ASCII.
BLANK_WORD = r"[^\x20\x09-\x0D]+"
LETTER_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
NO_LETTER = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: A table whose estimated rows times row width stays below this may be sent to all tasks.
BROADCAST_BYTES = 32 << 20
#: Rows that go to a Python worker at once where each holds a whole text and comes back with arrays.
BATCH_ROWS, ROWS_SETTING = 1000, "spark.sql.execution.arrow.maxRecordsPerBatch"


def whole(text: Column) -> Column:
    """The text, with null as the empty one."""
    return F.coalesce(text, F.lit(""))


def lower_ascii(text: Column) -> Column:
    """Lower-cases A-Z and nothing else; pure ASCII takes the built-in, which is far faster."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )


def split_words(spaced: Column) -> Column:
    """The words of a text whose words are parted by single blanks, none for the empty text."""
    return F.when(spaced == "", F.array().cast("array<string>")).otherwise(F.split(spaced, " "))


def letter_words(text: Column) -> Column:
    """The runs of 0-9, A-Z, a-z and anything beyond ASCII, in order; for lower-cased texts."""
    return split_words(F.trim(F.regexp_replace(text, NO_LETTER, " ")))


def rolling(words: str, width: int) -> Column:
    """For each word the ``width`` words from it on, as struct fields ``w0``, ``w1`` and so on.

    Shifted copies of the array are zipped, so the rows made from it need no lambda; the last
    words have nulls behind them.
    """
    shifted = [F.slice(words, k + 1, F.size(words)).alias(f"w{k}") for k in range(1, width)]
    return F.arrays_zip(F.col(words).alias("w0"), *shifted)


def lookup(small: DataFrame, rows: int, row_bytes: int) -> DataFrame:
    """Marks a table for broadcast if its counted size allows it; else Spark shuffles the join."""
    return F.broadcast(small) if rows * row_bytes <= BROADCAST_BYTES else small


def literal_table(spark: SparkSession, rows: list[tuple], names: list[str]) -> DataFrame:
    """A table of a few constant rows, built by Spark from literals."""
    cells = [F.struct(*(F.lit(v).alias(n) for n, v in zip(names, row))) for row in rows]
    return spark.range(1).select(F.inline(F.array(*cells)))


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """What is written inside sends Python workers few rows at a time; a session that sends fewer does so on.

    A task holds a batch several times over, in the JVM's Arrow buffers and in Python.
    """
    had = spark.conf.get(ROWS_SETTING)
    if not 0 < int(had) <= BATCH_ROWS:  # 0 stands for no bound
        spark.conf.set(ROWS_SETTING, BATCH_ROWS)
    try:
        yield
    finally:
        spark.conf.set(ROWS_SETTING, had)


def slices(texts: list, chars: int) -> Iterator[list]:
    """Texts in groups of about so many characters, so that a task's memory is bounded by them."""
    group, size = [], 0
    for text in texts:
        group.append(text)
        size += len(text or "")
        if size >= chars:
            yield group
            group, size = [], 0
    if group:
        yield group
