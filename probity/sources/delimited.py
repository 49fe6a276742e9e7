"""Tolerant readers for delimited registry files: every column is read as text."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType


def read_delimited(
    spark: SparkSession,
    path: str | list[str],
    sep: str = "|",
    quoted: bool = True,
    multi_line: bool = False,
    columns: list[str] | None = None,
) -> DataFrame:
    """Header file(s) as text columns, without inference, so ids keep leading zeros.

    Short rows are filled with null, surplus fields are dropped and bytes that are not
    UTF-8 are replaced. ``quoted=False`` takes quote signs as plain text. ``multi_line``
    allows line breaks in quotes, at the price of one task per file. With ``columns`` a
    missing file gives an empty table of these columns.
    """
    reader = spark.read.options(
        sep=sep,
        header=True,
        inferSchema=False,
        mode="PERMISSIVE",
        encoding="UTF-8",
        quote='"' if quoted else "",
        escape='"' if quoted else "",
        multiLine=multi_line,
    )
    try:
        return reader.csv(path)
    except AnalysisException as error:
        if columns is None or error.getCondition() != "PATH_NOT_FOUND":
            raise
        fields = [StructField(name, StringType()) for name in columns]
        return spark.createDataFrame([], StructType(fields))
