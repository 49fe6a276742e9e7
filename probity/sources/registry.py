"""State-procurement registries: sanctions, penalties, consortia and company links."""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from probity import functions as P
from probity.operators.audit import fingerprint
from probity.operators.conform import align, first_per_key
from probity.schemas import COMPANY_LINKS, CONSORTIA, PENALTIES, SANCTIONS

from .delimited import read_delimited
from .layers import empty, path_exists, write_layer

# File names, source columns and sanction types of the registry feeds.
BANS_FILE = "sancionados.csv"
FINES_FILE = "sancionados_multa.csv"
COURT_BANS_FILE = "inhabilitaciones_judiciales.csv"
PENALTIES_FILE = "penalidades.csv"
COMPANY_LINKS_FILE = "conformacion_juridica.csv"
CONSORTIA_FILES = "CONOSCE_CONSORCIO*"
BAN = "INHABILITACION"
FINE = "MULTA"
COURT_BAN = "INHABILITACION_JUDICIAL"
COMPANY_NAME = "NOMBRE_RAZONODENOMINACIONSOCIAL"


def sanction_feed(
    raw: DataFrame,
    kind: str,
    tax_id: str = "RUC",
    reason: str | None = "DE_MOTIVO_INFRACCION",
    amount: str | None = None,
) -> DataFrame:
    """One sanction file on the common schema, tagged with its type."""

    def text(name: str | None) -> Column:
        return F.col(name) if name else F.lit(None).cast("string")

    return raw.select(
        P.normalize_tax_id(tax_id).alias("ruc"),
        F.col(COMPANY_NAME).alias("nombre_empresa"),
        F.lit(kind).alias("tipo_sancion"),
        F.col("FECHA_INICIO").alias("fecha_inicio"),
        F.col("FECHA_FIN").alias("fecha_fin"),
        text(reason).alias("motivo"),
        (P.to_double(amount) if amount else F.lit(None).cast("double")).alias("monto"),
        F.col("NUMERO_RESOLUCION").alias("numero_resolucion"),
    )


def sanctions_registry(feeds: list[DataFrame]) -> DataFrame:
    """All feeds as one registry: rows with a company name, and its normalised form."""
    rows = reduce(DataFrame.unionByName, feeds).where(F.col("nombre_empresa").isNotNull())
    return align(rows.withColumn("nombre_empresa_norm", P.normalize_company("nombre_empresa")), SANCTIONS)


def read_sanctions(spark: SparkSession, folder: str) -> DataFrame:
    """The three sanction files of a folder; files that are not there count as empty."""
    head = ["RUC", COMPANY_NAME, "FECHA_INICIO", "FECHA_FIN", "DE_MOTIVO_INFRACCION", "NUMERO_RESOLUCION"]
    bans = read_delimited(spark, f"{folder}/{BANS_FILE}", columns=head)
    fines = read_delimited(spark, f"{folder}/{FINES_FILE}", columns=[*head, "MONTO"])
    court = read_delimited(spark, f"{folder}/{COURT_BANS_FILE}", columns=["RUC_DNI", *head[1:]])
    return sanctions_registry(
        [
            sanction_feed(bans, BAN),
            sanction_feed(fines, FINE, amount="MONTO"),
            sanction_feed(court, COURT_BAN, tax_id="RUC_DNI", reason=None),
        ]
    )


def penalties(raw: DataFrame) -> DataFrame:
    """Contract penalties; the file names no contractor, so that name stays null."""
    return align(
        raw.select(
            P.normalize_tax_id("RUC CONTRATISTA").alias("ruc"),
            F.col("TIPO PENALIDAD").alias("tipo_penalidad"),
            F.col("ENTIDAD CONTRATANTE").alias("entidad_contratante"),
            F.col("FECHA PENALIDAD").alias("fecha_penalidad"),
            F.col("`DESCRIPCION/MOTIVO`").alias("descripcion"),
            P.to_double("MONTO").alias("monto"),
            F.lit("").alias("nombre_empresa_norm"),
        ),
        PENALTIES,
    )


def read_penalties(spark: SparkSession, folder: str) -> DataFrame:
    """The penalties file: unquoted, with rows of uneven length."""
    columns = [
        "RUC CONTRATISTA",
        "TIPO PENALIDAD",
        "OBJETO CONTRATO",
        "ENTIDAD CONTRATANTE",
        "FECHA PENALIDAD",
        "DESCRIPCION/MOTIVO",
        "MONTO",
    ]
    return penalties(read_delimited(spark, f"{folder}/{PENALTIES_FILE}", quoted=False, columns=columns))


def company_links(raw: DataFrame) -> DataFrame:
    """Person id to company, one row per pair; the smallest company name survives."""
    pairs = raw.select(
        P.strip_spaces(F.col("NUMERO_DOCUMENTO").cast("string")).alias("numero_documento"),
        P.normalize_tax_id("RUC").alias("ruc"),
        F.col(COMPANY_NAME).alias("nombre_empresa"),
    ).where(F.col("numero_documento").isNotNull() & F.col("ruc").isNotNull())
    # equal rows go in a hash aggregate, so that little is left for the one that sorts
    return align(first_per_key(pairs.distinct(), ["numero_documento", "ruc"], ["nombre_empresa"]), COMPANY_LINKS)


def read_company_links(spark: SparkSession, folder: str) -> DataFrame:
    columns = ["NUMERO_DOCUMENTO", "RUC", COMPANY_NAME]
    return company_links(read_delimited(spark, f"{folder}/{COMPANY_LINKS_FILE}", columns=columns))


def consortia(raw: DataFrame) -> DataFrame:
    """Consortium memberships; header names are matched trimmed and in lower case."""
    raw = raw.toDF(*[name.lower().strip() for name in raw.columns])
    return align(
        raw.select(
            P.to_long("año").alias("anio"),
            P.normalize_tax_id("ruc_consorcio").alias("ruc_consorcio"),
            F.col("consorcio").cast("string").alias("consorcio"),
            P.normalize_tax_id("ruc_miembro").alias("ruc_miembro"),
            F.col("miembro").cast("string").alias("miembro"),
        ),
        CONSORTIA,
    )


@dataclass(frozen=True)
class ConsortiaScan:
    rows: DataFrame
    skipped: list[str]


def read_consortia(
    spark: SparkSession, folder: str, pattern: str = CONSORTIA_FILES, sep: str = "|"
) -> ConsortiaScan:
    """Yearly consortium files (CSV or Parquet) as one table.

    Files are grouped by their header, so that the plan has one scan per distinct header
    and not one per file. The headers of all CSV files are read in one job. Files whose header
    lacks a column are left out and reported; a file that cannot be read is an error.
    """
    listing = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", True)
        .load(folder)
        .select("path")
    )
    paths = sorted(row.path for row in listing.collect())
    tables = [p for p in paths if p.endswith(".parquet")]
    texts = [p for p in paths if not p.endswith(".parquet")]
    groups: dict[tuple[str, tuple[str, ...]], list[str]] = defaultdict(list)
    skipped: list[str] = []
    for path in tables:
        groups["parquet", tuple(_scan(spark, "parquet", [path], sep).columns)].append(path)
    shapes: dict[str, list[str]] = defaultdict(list)
    for path, line in _first_lines(spark, texts).items():
        shapes[line].append(path)
    for same in shapes.values():
        groups["csv", tuple(_scan(spark, "csv", same[:1], sep).columns)] += same
    frames = []
    for (kind, header), paths in groups.items():
        names = {name.lower().strip() for name in header}
        if {"año", "ruc_consorcio", "consorcio", "ruc_miembro", "miembro"} <= names:
            frames.append(consortia(_scan(spark, kind, paths, sep)))
        else:
            skipped += paths
    rows = reduce(DataFrame.unionByName, frames) if frames else empty(spark, CONSORTIA)
    return ConsortiaScan(rows, sorted(skipped))


def _first_lines(spark: SparkSession, paths: list[str]) -> dict[str, str]:
    """The first line of each file; places are numbers, so that no task sorts or holds lines to find the least."""
    if not paths:
        return {}
    place = F.monotonically_increasing_id().alias("place")
    lines = spark.read.text(paths).select("value", "_metadata.file_path", "_metadata.file_block_start", place)
    lines = lines.where("file_block_start = 0")
    places = [r.place for r in lines.groupBy("file_path").agg(F.min("place").alias("place")).collect()]
    first = lines.where(F.col("place").isin(places)).select("file_path", F.col("value").alias("line")).collect()
    wanted = {unquote(p).split(":", 1)[-1].lstrip("/"): p for p in paths}
    return {wanted[unquote(r.file_path).split(":", 1)[-1].lstrip("/")]: r.line for r in first}


def _scan(spark: SparkSession, kind: str, paths: list[str], sep: str) -> DataFrame:
    return spark.read.parquet(*paths) if kind == "parquet" else read_delimited(spark, paths, sep)


@dataclass(frozen=True)
class Registry:
    """The four staged reference tables, and the consortium files that could not be used."""

    sanctions: DataFrame
    company_links: DataFrame
    consortia: DataFrame
    penalties: DataFrame
    skipped: DataFrame


def raw_state(spark: SparkSession, folder: str) -> DataFrame:
    """One row that changes with the names, sizes and times of the files below a folder."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(folder)
        .select("path", "length", "modificationTime")
    )
    return fingerprint(files)


def load_registry(spark: SparkSession, raw_folder: str, staging_folder: str) -> Registry:
    """Reads the staged tables; builds and writes them first if they are not there in full,
    or if the raw files are not those they were built from.

    What they were built from is written last, so staging that did not end is done again.
    """
    state_path = f"{staging_folder}/built_from"
    now = raw_state(spark, raw_folder).first()
    built = path_exists(spark, f"{state_path}/_SUCCESS")
    if not built or spark.read.parquet(state_path).first() != now:
        scan = read_consortia(spark, raw_folder)
        skipped = spark.createDataFrame([(path,) for path in scan.skipped], "path string")
        write_layer(read_sanctions(spark, raw_folder), f"{staging_folder}/sanctions")
        write_layer(read_company_links(spark, raw_folder), f"{staging_folder}/company_links")
        write_layer(scan.rows, f"{staging_folder}/consortia")
        write_layer(read_penalties(spark, raw_folder), f"{staging_folder}/penalties")
        write_layer(skipped, f"{staging_folder}/skipped")
        write_layer(spark.createDataFrame([now]), state_path)
    tables = ("sanctions", "company_links", "consortia", "penalties", "skipped")
    return Registry(*(spark.read.parquet(f"{staging_folder}/{name}") for name in tables))
