"""Links from people to sanctioned companies: by exact keys first, by fuzzy name for the rest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, StructType

from probity import functions as P
from probity.schemas import MATCHES
from probity.sources.layers import empty, stage

from .conform import align, first_per_key
from .fuzzy import best_matches

# Method tags, link threshold, and the columns that may name a company.
DETERMINISTIC = "DETERMINISTIC"
FUZZY = "FUZZY"
THRESHOLD = 0.92
COMPANY_COLUMNS = ("titularidad", "empresa", "empresa_candidato")
COMPANY_FIELDS = ("empresa", "strPersonaJuridica")
LINK_COLUMNS = ("osce_match_score", "ruc_sancionado", "fup_url", "osce_match_method", "osce_sancionada_match")


def deterministic_links(
    people: DataFrame, company_links: DataFrame, sanctions: DataFrame, id_column: str = "dni"
) -> DataFrame:
    """Person id to company to sanction.

    Links are cut to sanctioned companies first, and people to distinct ids, so copies on
    either side are gone before the many-to-many join. Ids are padded on both sides, as files
    lose leading zeros. Tax ids without a digit other than zero name no company and link to
    none: junk would make one key of them all.
    """

    def document(name: str) -> Column:
        return P.normalize_national_id(P.strip_spaces(F.col(name).cast("string")))

    person = (
        people.where(F.col(id_column).isNotNull())
        .select("global_id", document(id_column).alias("numero_documento"))
        .distinct()
    )
    sanctions = sanctions.where(P.names_company("ruc"))
    company_links = company_links.where(F.col("numero_documento").isNotNull() & P.names_company("ruc"))
    kinds = sanctions.select("ruc", F.col("nombre_empresa").alias("osce_sancionada_match"), "tipo_sancion")
    sanctioned = company_links.select(
        document("numero_documento").alias("numero_documento"),
        "ruc",
        F.col("nombre_empresa").alias("empresa_candidato"),
    ).join(kinds.distinct(), "ruc")
    found = person.join(sanctioned, "numero_documento").select(
        "global_id",
        "empresa_candidato",
        "osce_sancionada_match",
        F.lit(1.0).alias("osce_match_score"),
        F.col("ruc").alias("ruc_sancionado"),
        "tipo_sancion",
        F.lit(DETERMINISTIC).alias("osce_match_method"),
    )
    return _with_page(found.distinct())


def fuzzy_links(
    people: DataFrame,
    sanctions: DataFrame,
    company_column: str = "empresa_candidato",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """Best sanctioned company by name for each distinct person and company name."""
    claims = (
        people.select("global_id", F.col(company_column).alias("empresa_candidato"))
        .dropna()
        .distinct()
        .withColumn("name", P.normalize_company("empresa_candidato"))
    )
    claims = stage(claims, "claims")
    registry = first_per_key(
        sanctions.select(
            F.col("nombre_empresa_norm").alias("match"),
            F.col("ruc").alias("ruc_sancionado"),
            F.col("nombre_empresa").alias("osce_sancionada_match"),
            "tipo_sancion",
        ).where(F.col("match").isNotNull()),
        ["match"],
        ["ruc_sancionado", "osce_sancionada_match", "tipo_sancion"],
    )
    best = best_matches(claims.select("name"), registry.select(F.col("match").alias("name")), threshold)
    found = claims.join(best.join(registry, "match"), "name").select(
        "global_id",
        "empresa_candidato",
        "osce_sancionada_match",
        F.col("score").alias("osce_match_score"),
        "ruc_sancionado",
        "tipo_sancion",
        F.lit(FUZZY).alias("osce_match_method"),
    )
    return _with_page(found)


def company_matches(
    people: DataFrame,
    company_links: DataFrame,
    sanctions: DataFrame,
    threshold: float = THRESHOLD,
    id_column: str = "dni",
    company_column: str = "empresa_candidato",
) -> DataFrame:
    """Both phases: fuzzy names only for people without an exact link.

    A phase whose input column the people lack is left out.
    """
    exact = empty(people.sparkSession, MATCHES)
    if id_column in people.columns:
        exact = deterministic_links(people, company_links, sanctions, id_column)
    if company_column not in people.columns:
        return exact
    # read twice below: as a result, and to find who is left
    exact = stage(exact, "exact-links")
    open_people = people.join(exact.select("global_id").distinct(), "global_id", "left_anti")
    return exact.unionByName(fuzzy_links(open_people, sanctions, company_column, threshold))


def best_match_per_person(matches: DataFrame) -> DataFrame:
    """One link per person: highest score, exact before fuzzy, then smallest tax id and name."""
    ranked = F.struct(
        (-F.col("osce_match_score")).alias("rank"),
        "osce_match_method",
        "ruc_sancionado",
        "osce_sancionada_match",
        "fup_url",
    )
    best = matches.groupBy("global_id").agg(F.min(ranked).alias("best"))
    return best.select(
        "global_id",
        (-F.col("best.rank")).alias("osce_match_score"),
        *[F.col(f"best.{field}").alias(field) for field in LINK_COLUMNS[1:]],
    )


def company_column(people: DataFrame) -> str | None:
    return next((name for name in COMPANY_COLUMNS if name in people.columns), None)


def company_claims(people: DataFrame) -> DataFrame:
    """Person, id and one claimed company per row; a list of companies is unfolded."""
    columns = ["global_id", *[c for c in ("dni",) if c in people.columns]]
    name = company_column(people)
    if name is None:
        return people.select(*columns)
    kind = people.schema[name].dataType
    claim = F.col(name)
    if isinstance(kind, ArrayType):
        people = people.select(*columns, F.explode_outer(name).alias(name))
        kind = kind.elementType
    if isinstance(kind, StructType):
        field = next((f for f in COMPANY_FIELDS if f in kind.names), kind.names[0])
        claim = F.col(name)[field]
    return people.select(*columns, claim.cast("string").alias("empresa_candidato"))


def link_companies(
    people: DataFrame, company_links: DataFrame, sanctions: DataFrame, threshold: float = THRESHOLD
) -> DataFrame:
    """People with the five columns of their best link, null where there is none."""
    matches = company_matches(company_claims(people), company_links, sanctions, threshold)
    return people.join(best_match_per_person(matches), "global_id", "left")


def _with_page(found: DataFrame) -> DataFrame:
    return align(found.withColumn("fup_url", P.supplier_page("ruc_sancionado")), MATCHES)
