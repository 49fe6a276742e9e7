"""Gold: Silver scored, linked, flagged and laid out for serving."""

from __future__ import annotations

from dataclasses import dataclass
from uuid import uuid4

from pyspark.sql import DataFrame

from probity.operators.audit import log_changes
from probity.operators.linking import link_companies
from probity.operators.risk import (
    add_plan_context,
    financial_score,
    legal_score,
    risk_flags,
    risk_index,
    stability_score,
    wide_table,
)
from probity.sources.layers import path_exists, read_layer, replace_layer, write_layer


def to_gold(
    silver: DataFrame,
    company_links: DataFrame,
    sanctions: DataFrame,
    plans: DataFrame | None = None,
    approx_median: bool = False,
) -> DataFrame:
    scored = (
        silver.transform(financial_score, approx_median).transform(legal_score).transform(stability_score)
    )
    return (
        scored.transform(link_companies, company_links, sanctions)
        .transform(risk_index)
        .transform(risk_flags)
        .transform(add_plan_context, plans)
        .transform(wide_table)
    )


@dataclass(frozen=True)
class GoldRun:
    gold: DataFrame
    changes: int


def build_gold(
    silver: DataFrame,
    company_links: DataFrame,
    sanctions: DataFrame,
    gold_path: str,
    audit_path: str,
    plans: DataFrame | None = None,
    **options,
) -> GoldRun:
    """Writes the new version once, audits it against the last one, then puts it in its place."""
    spark = silver.sparkSession
    version = f"{gold_path.rstrip('/')}.new-{uuid4().hex}"
    write_layer(to_gold(silver, company_links, sanctions, plans, **options), version, sort_by="global_id")
    changes = 0
    if path_exists(spark, gold_path):
        changes = log_changes(
            read_layer(spark, gold_path), read_layer(spark, version), audit_path, ["global_id", "source_category"]
        )
    replace_layer(spark, version, gold_path)
    return GoldRun(read_layer(spark, gold_path), changes)
