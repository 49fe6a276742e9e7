"""Silver from files as they arrive: each file is read once, however often the job runs.

A finite stream (it takes what is there and ends) reads new résumé files, cleans them with the same
projection as the whole refresh, and appends them to a table, valid and rejected rows apart. What
was read is kept in the checkpoint and what was written in the table's own log, both in the shared
store: a batch that breaks off is done again, and one that was written before is not written twice.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from probity.operators.quality import REASON, ROUTES, QualityReport, routed
from probity.sources.layers import COMPRESSION, empty, path_exists
from probity.sources.resumes import CATEGORIES, CORRUPT, stream_resumes

from .silver import reject_reason, to_silver


@dataclass(frozen=True)
class Arrivals:
    """A table of arrived rows, and where the stream keeps what it has read."""

    path: str
    checkpoint: str


def take_in(
    spark: SparkSession,
    root: str,
    to: Arrivals,
    categories: tuple[str, ...] = CATEGORIES,
    one_record_per_file: bool = True,
    files_per_batch: int = 1_000,
    reject_zero_id: bool = False,
    **options,
) -> StructType:
    """Appends what has arrived below ``root`` since the last run, and ends. Returns the rows' schema.

    Files are told by their path: a file that changes after it was read is not read again.
    """
    files = stream_resumes(spark, root, categories, one_record_per_file=one_record_per_file, files_per_batch=files_per_batch)
    rows = to_silver(files, **options)
    apart = routed(rows, reject_reason(rows, reject_zero_id), helpers=(CORRUPT,))
    query = (
        apart.writeStream.format("parquet")
        .option("path", to.path)
        .option("compression", COMPRESSION)
        .option("checkpointLocation", to.checkpoint)
        .partitionBy(*ROUTES)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return apart.schema


def _arrived(spark: SparkSession, to: Arrivals, schema: StructType, valid: bool) -> DataFrame:
    if not path_exists(spark, f"{to.path}/_spark_metadata"):
        return empty(spark, schema).drop(ROUTES[0])
    return spark.read.schema(schema).parquet(to.path).where(F.col(ROUTES[0]) == valid).drop(ROUTES[0])


def valid_arrivals(spark: SparkSession, to: Arrivals, schema: StructType) -> DataFrame:
    return _arrived(spark, to, schema, True).drop(REASON)


def rejected_arrivals(spark: SparkSession, to: Arrivals, schema: StructType) -> DataFrame:
    """The rejected rows of all runs with their reasons."""
    return _arrived(spark, to, schema, False)


def arrival_quality(spark: SparkSession, to: Arrivals, schema: StructType) -> QualityReport:
    """Counts of all that has arrived, for a breaker over the whole."""
    valid, rejected = valid_arrivals(spark, to, schema).count(), rejected_arrivals(spark, to, schema).count()
    return QualityReport(valid + rejected, rejected)
