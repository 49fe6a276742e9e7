"""How a query is registered, and how it reads the test tables."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


class Tables:
    """The tables of one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def sql(self, text: str, **frames: DataFrame) -> DataFrame:
        """SQL in the part both engines share; tables are written ``{orders}``."""
        names = set(re.findall(r"\{(\w+)\}", text)) - set(frames)
        return self.spark.sql(text, **{name: getattr(self, name) for name in names}, **frames)


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(sql: str | None = None, **inputs: str):
    """Registers a function of :class:`Tables` under its name.

    ``inputs`` are named SELECTs put before ``sql``; the function reads the same texts.
    """

    def register(function: Callable[[Tables], DataFrame]):
        oracle = None
        if sql is not None:
            parts = [f"{name} AS ({plain(text)})" for name, text in inputs.items()]
            oracle = (f"WITH {', '.join(parts)} " if parts else "") + plain(sql)
        QUERIES[function.__name__] = Query(lambda spark, folder: function(Tables(spark, folder)), oracle)
        return function

    return register


def plain(text: str) -> str:
    """The shared SQL as the oracle reads it: tables by their bare names."""
    return re.sub(r"\{(%s)\}" % "|".join(TABLES), r"\1", text)
