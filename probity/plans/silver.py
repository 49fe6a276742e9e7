"""Silver: résumés cleaned, identified, checked and compared with the last version."""

from __future__ import annotations

from dataclasses import dataclass
from uuid import uuid4

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType

from probity import functions as P
from probity.operators.audit import log_changes
from probity.operators.conform import money, rename_fields, unnest
from probity.operators.quality import (
    MAX_ERROR_RATIO,
    QualityReport,
    enforce_quality,
    silver_reason,
    valid_folder,
)
from probity.schemas import PERSONAL_FIELDS, SILVER
from probity.sources.resumes import CORRUPT
from probity.sources.layers import delete, path_exists, read_layer, replace_layer, write_layer

#: Fixed value: wording of the reason of files that are no JSON.
UNREADABLE = "archivo ilegible"
INCOME_FIELDS = ("decRemuBrutaPublico", "decRemuBrutaPrivado")


def conform_resumes(
    resumes: DataFrame,
    income_fields: tuple[str, ...] = INCOME_FIELDS,
    repeated_marks: bool = False,
    ignore_accents: bool = False,
) -> DataFrame:
    """Résumé records as one flat row each: mapped fields, sums and counts of the lists.

    Columns a source lacks count as empty. ``repeated_marks`` reads money by the fuller
    rules, ``ignore_accents`` also counts accented public sectors.
    """
    df = unnest(resumes, "oDatosPersonales", "oIngresos")
    present = set(df.columns)

    def measure(name: str, function, *args) -> Column:
        return function(name, *args) if name in present else F.lit(0)

    income = [money(df, name, repeated_marks) for name in income_fields if name in present]
    columns = [
        *rename_fields(df, PERSONAL_FIELDS),
        P.sum_across(F.lit(0.0), *income).cast("double").alias("ingresos_totales"),
        P.sum_across(measure("lBienInmueble", P.list_count), measure("lBienMueble", P.list_count))
        .cast("bigint")
        .alias("cantidad_bienes"),
        P.sum_across(
            measure("lBienInmueble", P.list_sum, "decValor"),
            measure("lBienInmueble", P.list_sum, "decAutovaluo"),
            measure("lBienMueble", P.list_sum, "decValor"),
        )
        .cast("double")
        .alias("valor_total_bienes"),
        P.sum_across(measure("lSentenciaPenal", P.list_count), measure("lSentenciaObliga", P.list_count))
        .cast("bigint")
        .alias("conteo_sentencias"),
        measure(
            "lExperienciaLaboral", P.public_experience, "strSector", "intAnioTrabajo", ignore_accents
        )
        .cast("bigint")
        .alias("experiencia_publica_anios"),
        measure("lRenunciaOP", P.list_count).cast("bigint").alias("cantidad_renuncias"),
        F.col("source_category"),
    ]
    return df.select(*columns, *_extras(df))


def identify(df: DataFrame) -> DataFrame:
    """Padded id, global identity, and names in their final spelling."""
    flat = {name: P.flat_name(name) for name in ("nombres", "apellido_paterno", "apellido_materno")}
    born = P.strip_spaces(F.coalesce(F.col("fecha_nacimiento"), F.lit("")))
    key = P.natural_key(*flat.values(), born)
    return df.withColumn("dni", P.normalize_national_id("dni")).withColumns(
        {
            "global_id": P.global_id("dni", key),
            **{name: P.title_case(flat_name) for name, flat_name in flat.items()},
            "cargo": P.standardize_text("cargo", "title"),
            "partido": P.standardize_text("partido", "title"),
        }
    )


def to_silver(resumes: DataFrame, **options) -> DataFrame:
    """The whole cleaning as one projection: no shuffle, no Python."""
    df = identify(conform_resumes(resumes, **options))
    return df.select(*SILVER.names, *[c for c in df.columns if c not in SILVER.names])


def reject_reason(rows: DataFrame, reject_zero_id: bool = False) -> Column:
    """Why a row of :func:`to_silver` is rejected: files that are no JSON are told apart from bad fields."""
    reason = silver_reason(reject_zero_id=reject_zero_id)
    if CORRUPT not in rows.columns:
        return reason
    return F.when(F.col(CORRUPT).isNotNull(), F.lit(UNREADABLE)).otherwise(reason)


@dataclass(frozen=True)
class SilverRun:
    silver: DataFrame
    quality: QualityReport
    changes: int


def build_silver(
    resumes: DataFrame,
    silver_path: str,
    reject_path: str,
    audit_path: str,
    max_error_ratio: float = MAX_ERROR_RATIO,
    reject_zero_id: bool = False,
    **options,
) -> SilverRun:
    """Cleans, checks, audits against the last version, then replaces it. Silver is written once."""
    spark = resumes.sparkSession
    rows = to_silver(resumes, **options)
    version = f"{silver_path.rstrip('/')}.new-{uuid4().hex}"
    try:
        valid, report = enforce_quality(
            rows, reject_path, reject_reason(rows, reject_zero_id), max_error_ratio, version, helpers=(CORRUPT,)
        )
        changes = 0
        if path_exists(spark, silver_path):
            # one person can be in several categories, so the category belongs to the key
            changes = log_changes(
                read_layer(spark, silver_path), valid, audit_path, ["global_id", "source_category"]
            )
        new = valid_folder(version)
        if not path_exists(spark, new):  # no row is valid
            write_layer(valid, new)
        replace_layer(spark, new, silver_path)
    finally:
        delete(spark, version)
    return SilverRun(read_layer(spark, silver_path), report, changes)


def _extras(df: DataFrame) -> list[Column]:
    """Beyond the fixed columns: claimed companies, and the organisation that has a plan."""
    extras = []
    if "lTitularidad" in df.columns and isinstance(df.schema["lTitularidad"].dataType, ArrayType):
        names = F.transform("lTitularidad", lambda item: item["strPersonaJuridica"])
        extras.append(F.array_distinct(F.array_compact(names)).alias("titularidad"))
    if "idOrganizacionPolitica" in df.columns:
        extras.append(F.col("idOrganizacionPolitica").cast("string").alias("id_organizacion_politica"))
    if CORRUPT in df.columns:
        extras.append(F.col(CORRUPT))
    return extras
