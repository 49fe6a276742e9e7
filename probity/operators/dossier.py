"""Company dossiers out of sanctions, penalties and consortium memberships."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from probity import functions as P

from .conform import stack

SANCTION_FIELDS = (
    "ruc",
    "nombre_empresa",
    "tipo_sancion",
    "fecha_inicio",
    "fecha_fin",
    "motivo",
    "monto",
    "numero_resolucion",
)


def consortium_roles(consortia: DataFrame) -> DataFrame:
    """One row per company a consortium row names, be it the consortium or the member.

    Both keys become one, so the lookup is an equality and not an OR of two.
    """
    companies = F.array_distinct(F.array_compact(F.array("ruc_consorcio", "ruc_miembro")))
    return consortia.select(F.explode(companies).alias("ruc"), *consortia.columns)


def company_dossiers(
    sanctions: DataFrame,
    penalties: DataFrame,
    consortia: DataFrame,
    company_links: DataFrame | None = None,
) -> DataFrame:
    """One row per company found in any feed: name, page, counts and flags.

    Each feed is counted by company first, in hash aggregates and map-side; names are made
    distinct before the smallest is taken. What is left, at most one row per company and feed, is stacked and aggregated again, so no
    outer join is needed. The sanctions themselves stay rows (:func:`dossier_sanctions`):
    a list per company would gather any number of them in one task. The name comes from
    the sanctions, else from the penalties, else from the company links.
    """

    def counted(rows: DataFrame, feed: str) -> DataFrame:
        return rows.where(F.col("ruc").isNotNull()).groupBy("ruc").agg(F.count("*").alias(feed))

    def named(rows: DataFrame, feed: str) -> DataFrame:
        # names are few: the filter reaches the scan and skips what has none
        known = rows.where(F.col("ruc").isNotNull() & F.col("nombre_empresa").isNotNull())
        # hashing cannot hold a least text, only a set of texts: the sort is over what that leaves
        different = known.select("ruc", "nombre_empresa").distinct()
        return different.groupBy("ruc").agg(F.min("nombre_empresa").alias(f"{feed}_name"))

    parts = [
        counted(sanctions, "sanction"),
        named(sanctions, "sanction"),
        counted(penalties, "penalty"),
        named(penalties, "penalty"),
        counted(consortium_roles(consortia), "consortium"),
    ]
    if company_links is not None:
        parts.append(named(company_links, "link"))
    stacked = stack(parts, "diagonal")
    names = [f"{feed}_name" for feed in ("sanction", "penalty", "link") if f"{feed}_name" in stacked.columns]
    found = (
        stacked.groupBy("ruc")
        .agg(
            F.coalesce(*[F.min(name) for name in names]).alias("nombre_empresa"),
            *[
                F.coalesce(F.sum(feed), F.lit(0)).alias(total)
                for feed, total in (
                    ("sanction", "total_sanciones"),
                    ("penalty", "total_penalidades"),
                    ("consortium", "total_consorcios"),
                )
            ],
        )
        .where("total_sanciones + total_penalidades + total_consorcios > 0")
    )
    return found.select(
        "ruc",
        P.supplier_page("ruc").alias("fup_url"),
        "nombre_empresa",
        "total_sanciones",
        (F.col("total_penalidades") > 0).alias("en_penalidades"),
        "total_penalidades",
        (F.col("total_consorcios") > 0).alias("en_consorcios"),
        "total_consorcios",
    )


def dossier_sanctions(sanctions: DataFrame) -> DataFrame:
    """The sanction records of the dossiers, one row each."""
    return sanctions.select(*SANCTION_FIELDS).where(F.col("ruc").isNotNull())


def company_dossier(
    tax_id: str,
    sanctions: DataFrame,
    penalties: DataFrame,
    consortia: DataFrame,
    company_links: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Dossier row and sanction rows of one company; both are empty if it is not found.

    The key is filtered before anything else, down to the scans.
    """
    wanted = tax_id.strip()
    if not (wanted.isascii() and wanted.isdigit() and len(wanted) == 11):
        raise ValueError(f"a tax id has exactly eleven digits: {tax_id!r}")

    def mine(df: DataFrame) -> DataFrame:
        return df.where(F.col("ruc") == wanted)

    memberships = consortia.where((F.col("ruc_consorcio") == wanted) | (F.col("ruc_miembro") == wanted))
    dossier = company_dossiers(
        mine(sanctions), mine(penalties), memberships, None if company_links is None else mine(company_links)
    )
    return mine(dossier), dossier_sanctions(mine(sanctions))


def requested_dossiers(requests: DataFrame, dossiers: DataFrame, column: str = "ruc") -> DataFrame:
    """Answers a table of tax ids: ``found``, ``not_found`` or ``invalid`` and the dossier."""
    asked = requests.select(P.strip_spaces(column).alias("ruc"), P.is_tax_id(column).alias("_valid"))
    answered = asked.join(dossiers.withColumn("_found", F.lit(True)), "ruc", "left")
    status = (
        F.when(~F.col("_valid"), F.lit("invalid"))
        .when(F.col("_found"), F.lit("found"))
        .otherwise(F.lit("not_found"))
    )
    return answered.withColumn("status", status).drop("_valid", "_found")
