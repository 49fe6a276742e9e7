"""Risk scores, index, flags and plan texts of a Silver table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from probity import functions as P
from probity.schemas import GOLD, PLANS

from .conform import align, first_per_key
from .stats import median_and_mad


def financial_score(df: DataFrame, approx: bool = False) -> DataFrame:
    """Robust score of assets against income.

    Median and spread are numbers by the time the rows are scored, so scoring is a
    projection: no join, no window.
    """
    ratio = P.wealth_ratio("valor_total_bienes", "ingresos_totales", "experiencia_publica_anios")
    median, mad = median_and_mad(df, ratio, approx)
    score = P.robust_score(ratio, F.lit(median).cast("double"), F.lit(mad).cast("double"))
    return df.withColumn("score_financiero", score)


def legal_score(df: DataFrame) -> DataFrame:
    return df.withColumn("score_legal", P.legal_score("conteo_sentencias"))


def stability_score(df: DataFrame) -> DataFrame:
    score = P.stability_score("cantidad_renuncias", "experiencia_publica_anios")
    return df.withColumn("score_estabilidad", score)


def risk_index(df: DataFrame) -> DataFrame:
    index = P.risk_index("score_financiero", "score_legal", "score_estabilidad")
    return df.withColumn("score_itr", index)


def risk_flags(df: DataFrame) -> DataFrame:
    flags = P.risk_flags(
        "ingresos_totales",
        "experiencia_publica_anios",
        "score_financiero",
        "conteo_sentencias",
        "score_estabilidad",
        "osce_match_score",
        "ruc_sancionado",
    )
    return df.withColumn("risk_flags", flags)


def plan_contexts(plans: DataFrame) -> DataFrame:
    """One text per organisation out of the four dimensions of its plan."""
    organisation, *dimensions = PLANS.names
    texts = plans.select(
        F.col(organisation).cast("string").alias(organisation),
        P.join_context(*dimensions).alias("search_context"),
    )
    return first_per_key(texts, [organisation], ["search_context"])


def add_plan_context(df: DataFrame, plans: DataFrame | None) -> DataFrame:
    """The plan text of each person's organisation; without plans the text is empty."""
    organisation = PLANS.names[0]
    if plans is None or organisation not in df.columns:
        return df.withColumn("search_context", F.lit(""))
    people = df.withColumn(organisation, F.col(organisation).cast("string"))
    return people.join(plan_contexts(plans), organisation, "left")


def wide_table(df: DataFrame) -> DataFrame:
    """The Gold columns in their fixed order."""
    return align(df, GOLD)
