"""All layers anew: from raw folders to the served Gold table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession

from probity.schemas import PLANS
from probity.sources.layers import own_work, path_exists, read_layer
from probity.sources.registry import load_registry
from probity.sources.resumes import CATEGORIES, read_resumes

from .gold import GoldRun, build_gold
from .silver import SilverRun, build_silver


@dataclass(frozen=True)
class Folders:
    """Where the layers are. Every path can be in any store Spark can reach."""

    resumes: str
    registry: str
    staging: str
    silver: str
    gold: str
    rejected: str
    audit: str
    plans: str | None = None


def refresh_layers(
    spark: SparkSession,
    folders: Folders,
    categories: tuple[str, ...] = CATEGORIES,
    one_record_per_file: bool = True,
    **silver_options,
) -> tuple[SilverRun, GoldRun]:
    """Runs all steps; what they staged on the way is deleted at the end."""
    with own_work(spark):
        return _refresh(spark, folders, categories, one_record_per_file, **silver_options)


def _refresh(spark, folders, categories, one_record_per_file, **silver_options) -> tuple[SilverRun, GoldRun]:
    resumes = read_resumes(spark, folders.resumes, categories, one_record_per_file=one_record_per_file)
    registry = load_registry(spark, folders.registry, folders.staging)
    silver = build_silver(
        resumes, folders.silver, folders.rejected, folders.audit, **silver_options
    )
    plans = None
    if folders.plans and path_exists(spark, folders.plans):
        plans = read_layer(spark, folders.plans, PLANS)
    gold = build_gold(
        silver.silver, registry.company_links, registry.sanctions, folders.gold, folders.audit, plans
    )
    return silver, gold
