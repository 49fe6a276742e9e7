"""Reports over layers: completeness, distribution, freshness, link evaluation, identities."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from probity import functions as P

from .conform import first_per_key
from .similarity import jaro_winkler


def completeness(df: DataFrame, source: str = "source_category") -> DataFrame:
    """Percentage of non-null values per source and column, in one aggregate."""
    columns = [c for c in df.columns if c != source]
    shares = df.groupBy(source).agg(
        *[(F.count(c) * F.lit(100.0) / F.count("*")).alias(c) for c in columns]
    )
    return shares.unpivot(source, columns, "field", "percent_present")


def distribution(df: DataFrame, *by: str) -> DataFrame:
    """Number of rows per value of the given columns."""
    return df.groupBy(*by).agg(F.count("*").alias("entities"))


def freshness(df: DataFrame, source: str, cut_off: str, date_format: str | None = None) -> DataFrame:
    """Latest cut-off date per source; text that is no date is left out."""
    date = F.try_to_date(cut_off, date_format) if date_format else F.col(cut_off).try_cast("date")
    return df.groupBy(source).agg(F.max(date).alias("latest"), F.count(date).alias("dated_rows"))


def evaluate_thresholds(
    pairs: DataFrame, thresholds: list[float], left: str = "left", right: str = "right", label: str = "same"
) -> DataFrame:
    """Precision and recall of the fuzzy link per threshold, from labelled pairs.

    Each pair is scored once; all thresholds are counted in the same pass.
    """
    scored = pairs.select(jaro_winkler(left, right).alias("score"), F.col(label).alias("same"))
    hit = {t: F.col("score") >= F.lit(t) for t in thresholds}
    counted = scored.agg(
        F.count_if("same").alias("positives"),
        *[F.count_if(hit[t]).alias(f"found_{i}") for i, t in enumerate(thresholds)],
        *[F.count_if(hit[t] & F.col("same")).alias(f"right_{i}") for i, t in enumerate(thresholds)],
    )
    rows = [
        F.struct(
            F.lit(float(t)).alias("threshold"),
            F.col(f"found_{i}").alias("found"),
            F.col(f"right_{i}").alias("correct"),
        )
        for i, t in enumerate(thresholds)
    ]
    return counted.select("positives", F.inline(F.array(*rows))).select(
        "threshold",
        "found",
        "correct",
        F.try_divide("correct", "found").alias("precision"),
        F.try_divide("correct", "positives").alias("recall"),
    )


def identity_variants(df: DataFrame, names: list[str], key: str = "global_id") -> DataFrame:
    """Every spelling found under one identity and how often: one row each, never a list."""
    return df.groupBy(key, *names).agg(F.count("*").alias("occurrences"))


def canonical_identities(df: DataFrame, names: list[str], key: str = "global_id") -> DataFrame:
    """One row per identity: its most frequent spelling, the smallest of equals."""
    variants = identity_variants(df, names, key)
    best = F.min(F.struct((-F.col("occurrences")).alias("_n"), *names)).alias("best")
    return variants.groupBy(key).agg(
        best, F.count("*").alias("variants"), F.sum("occurrences").alias("occurrences")
    ).select(key, *[F.col(f"best.{n}").alias(n) for n in names], "variants", "occurrences")


def backfill(
    df: DataFrame, detail: DataFrame, key: str, columns: list[str], prefer_detail: bool = False
) -> DataFrame:
    """Fills missing fields from a second source; empty lists, maps and blank text count as missing.

    ``prefer_detail`` also replaces values the second source contradicts.
    """
    other = first_per_key(detail.select(key, *[F.col(c).alias(f"_detail_{c}") for c in columns]), [key], [])
    joined = df.join(other, key, "left")

    def known(name: str, source: str):
        kind = df.schema[source].dataType.typeName()
        column = F.col(name)
        if kind in ("array", "map"):
            return F.when(F.size(column) > 0, column)
        if kind == "string":
            return F.when(P.strip_spaces(column) != "", column)
        return column

    def value(name: str):
        first, second = known(name, name), known(f"_detail_{name}", name)
        return F.coalesce(second, first) if prefer_detail else F.coalesce(first, second)

    return joined.select(
        *[value(c).alias(c) if c in columns else F.col(c) for c in df.columns]
    )
