"""Data quality: classify rows, route them, quarantine the bad ones, stop on too many."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, functions as F

from probity import functions as P
from probity.sources.layers import append_history, empty, read_layer, work_path, write_layer

REASON = "motivo_rechazo"
MAX_ERROR_RATIO = 0.2
#: Column that rows are routed by, and so the name of the folders they are written to.
_ROUTE = "row_is_valid"

# Wording of the rejection reasons.
BAD_ID_AND_NAME = "dni invalido y nombres nulos"
BAD_ID = "dni invalido (no es num o dif 8 chars)"
BAD_NAME = "campo critico nulo: nombres"


class DataQualityError(Exception):
    """Too many invalid rows."""


@dataclass(frozen=True)
class QualityReport:
    total: int
    invalid: int

    @property
    def ratio(self) -> float:
        return self.invalid / self.total if self.total else 0.0


def has_text(column: str) -> Column:
    return F.coalesce(F.length(column) > 0, F.lit(False))


def silver_reason(
    id_column: str = "dni", name_column: str = "nombres", reject_zero_id: bool = False
) -> Column:
    """Why a Silver row is rejected, null for a valid one.

    ``reject_zero_id`` also rejects the id of zeros only that a missing id is padded to.
    """
    good_id = P.is_national_id(id_column)
    if reject_zero_id:
        good_id = good_id & (F.col(id_column) != "0" * 8)
    good_name = has_text(name_column)
    return (
        F.when(~good_id & ~good_name, F.lit(BAD_ID_AND_NAME))
        .when(~good_id, F.lit(BAD_ID))
        .when(~good_name, F.lit(BAD_NAME))
    )


def first_broken_rule(rules: dict[str, Column]) -> Column:
    """Name of the first rule a row does not meet; an undecided rule counts as broken."""
    broken = [F.when(~F.coalesce(holds, F.lit(False)), F.lit(name)) for name, holds in rules.items()]
    return F.coalesce(*broken)


def classify(df: DataFrame, reason: Column | None = None) -> DataFrame:
    return df.withColumn(REASON, silver_reason() if reason is None else reason)


def valid_rows(classified: DataFrame) -> DataFrame:
    return classified.where(F.col(REASON).isNull()).drop(REASON)


def rejected_rows(classified: DataFrame) -> DataFrame:
    return classified.where(F.col(REASON).isNotNull())


def quality_counts(classified: DataFrame) -> DataFrame:
    """One row: total, invalid, and their ratio."""
    counts = classified.agg(
        F.count("*").alias("total"), F.count_if(F.col(REASON).isNotNull()).alias("invalid")
    )
    return counts.withColumn("error_ratio", F.coalesce(F.try_divide("invalid", "total"), F.lit(0.0)))


def routed(df: DataFrame, reason: Column | None = None, helpers: tuple[str, ...] = ()) -> DataFrame:
    """The rows with the two columns that they are written by: whether they are valid, and why not.

    ``helpers`` are columns that only the reason needs; they are dropped.
    """
    return classify(df, reason).withColumn(_ROUTE, F.col(REASON).isNull()).drop(*helpers)


#: What :func:`routed` rows are partitioned by when they are written.
ROUTES = (_ROUTE, REASON)


def write_routed(
    df: DataFrame, path: str, reason: Column | None = None, helpers: tuple[str, ...] = ()
) -> tuple[DataFrame, DataFrame, QualityReport]:
    """Valid rows, rejected rows with their reason, and how many there are, in one pass over the input.

    Both kinds are written side by side below ``path``, and are counted while they are written;
    nothing is read again to be counted. The folder ``valid_folder`` names can be moved to where a layer is.
    """
    spark = df.sparkSession
    classified = routed(df, reason, helpers)
    seen = Observation()
    counts = F.count(F.lit(1)).alias("total"), F.count_if(~F.col(_ROUTE)).alias("invalid")
    write_layer(classified.observe(seen, *counts), path, partition_by=ROUTES)
    report = QualityReport(seen.get["total"], seen.get["invalid"])
    rejects = f"{path}/{_ROUTE}=false"
    reasons = classified.drop(_ROUTE).schema
    rejected = spark.read.schema(reasons).parquet(rejects) if report.invalid else empty(spark, reasons)
    return read_layer(spark, valid_folder(path), classified.drop(*ROUTES).schema), rejected, report


def valid_folder(path: str) -> str:
    """Where :func:`write_routed` puts the valid rows, which have no reason; it is not there if there are none."""
    return f"{path}/{_ROUTE}=true/{REASON}=__HIVE_DEFAULT_PARTITION__"


def enforce_quality(
    df: DataFrame,
    reject_path: str,
    reason: Column | None = None,
    max_error_ratio: float = MAX_ERROR_RATIO,
    path: str | None = None,
    helpers: tuple[str, ...] = (),
) -> tuple[DataFrame, QualityReport]:
    """The valid rows; rejects are appended to ``reject_path`` before anything is raised.

    Rows are computed, routed, counted and written once, below ``path`` (an intermediate if it is
    not named); only the rejects are written again, to their history.
    """
    path = work_path(df.sparkSession, "routed") if path is None else path
    valid, rejected, report = write_routed(df, path, reason, helpers)
    if report.invalid:
        append_history(rejected, reject_path)
        if report.ratio > max_error_ratio:
            raise DataQualityError(
                f"{report.invalid} of {report.total} rows are invalid ({report.ratio:.1%}, allowed {max_error_ratio:.1%})"
            )
    return valid, report


def mark_known(
    df: DataFrame, column: str, known: DataFrame, known_column: str, flag: str = "is_known"
) -> DataFrame:
    """Referential rule: whether the value of a column occurs in a table of known ones.

    One join marks all rows; routing them is a filter on the mark.
    """
    keys = known.select(F.col(known_column).alias(column)).where(F.col(column).isNotNull()).distinct()
    marked = df.join(keys.withColumn(flag, F.lit(True)), column, "left")
    return marked.withColumn(flag, F.coalesce(flag, F.lit(False)))
