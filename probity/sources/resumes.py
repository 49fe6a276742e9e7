"""Résumé files: one JSON record per file, flat or wrapped, for all categories in one scan."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from urllib.parse import quote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, DataType, StringType, StructField, StructType

from probity import functions as P
from probity.schemas import PROFILE_PARTS, RESUME, SECTIONS

# Category folders; the first two are names of the same one.
CATEGORIES = ("presidentes", "presidenciales", "parlamento_andino", "senadores", "diputados")

# Personal fields of the wrapped shape, by where they are looked for.
_MAIN_FIELDS = {
    "strDocumentoIdentidad": "documentoIdentidad",
    "strNombres": "nombres",
    "strApellidoPaterno": "apellidoPaterno",
    "strApellidoMaterno": "apellidoMaterno",
    "strFechaNacimiento": "fechaNacimiento",
    "strCargoEleccion": "cargo",
    "strOrganizacionPolitica": "organizacionPolitica",
}

# résumé columns that one part of a profile holds together, under their own names.
SHARED_PART = "info_adicional"
SHARED_COLUMNS = ("lRenunciaOP", "lTitularidad")

#: What a record that is no JSON is kept in.
CORRUPT = "_corrupt_record"


def wrapped_schema(parts: Mapping[str, str] = PROFILE_PARTS) -> StructType:
    """Every shape in one schema. Parts of a profile stay JSON text until their type is known."""
    profile = StructType([StructField(name, StringType()) for name in ["principal", SHARED_PART, *parts]])
    return StructType(
        [
            *RESUME.fields,
            StructField("data", RESUME),
            StructField("base_info", StringType()),
            StructField("consolidated_profile", profile),
            StructField(CORRUPT, StringType()),
        ]
    )


def read_resumes(
    spark: SparkSession,
    root: str,
    categories: tuple[str, ...] = CATEGORIES,
    parts: Mapping[str, str] = PROFILE_PARTS,
    one_record_per_file: bool = True,
) -> DataFrame:
    """All ``*.json`` below ``root/<category>``, as flat résumés with ``source_category``.

    Files that are no JSON keep one row whose ``_corrupt_record`` is set. A missing root
    gives an empty table. With ``one_record_per_file=False`` files hold one record per line
    and are split over tasks.
    """
    folder = root.rstrip("/")
    try:
        raw = _options(spark.read, parts, one_record_per_file).json(folder)
        path = F.col("_metadata.file_path")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        raw = spark.createDataFrame([], wrapped_schema(parts))
        path = F.lit("")
    return flatten_profiles(_tagged(raw, path, folder, categories), parts)


def stream_resumes(
    spark: SparkSession,
    root: str,
    categories: tuple[str, ...] = CATEGORIES,
    parts: Mapping[str, str] = PROFILE_PARTS,
    one_record_per_file: bool = True,
    files_per_batch: int = 1_000,
) -> DataFrame:
    """The same of files as they arrive below a folder that is there: a stream of flat résumés."""
    folder = root.rstrip("/")
    reader = _options(spark.readStream, parts, one_record_per_file).option("maxFilesPerTrigger", files_per_batch)
    return flatten_profiles(_tagged(reader.json(folder), F.col("_metadata.file_path"), folder, categories), parts)


def _options(reader, parts: Mapping[str, str], one_record_per_file: bool):
    return (
        reader.schema(wrapped_schema(parts))
        .option("multiLine", one_record_per_file)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.json")
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
    )


def _tagged(raw: DataFrame, path: Column, folder: str, categories: tuple[str, ...]) -> DataFrame:
    below = quote(folder.split("://")[-1].lstrip("./"), safe="/-_.~=")
    # the folder right below the root; \\Q..\\E takes the root as plain text
    category = F.regexp_extract(path, rf"\Q{below}\E/+([^/]+)/", 1)
    return raw.withColumn("source_category", category).where(F.col("source_category").isin(*categories))


def flatten_profiles(df: DataFrame, parts: Mapping[str, str] = PROFILE_PARTS) -> DataFrame:
    """Wrapped records as flat ones; flat records pass through.

    A record is wrapped as the ``data`` of a service response, or as list entry and fetched
    profile. ``parts`` names the résumé column each part of a profile becomes; the part
    ``SHARED_PART`` holds several. Each JSON text is parsed once.
    """
    wanted = {f.name: f.dataType for f in RESUME.fields}
    person = _text_struct(f.name for f in wanted["oDatosPersonales"].fields)
    shared = StructType([StructField(name, wanted[name]) for name in SHARED_COLUMNS])
    profile = F.col("consolidated_profile")
    df = df.withColumns(
        {
            "_base": F.from_json("base_info", person),
            "_main": F.from_json(profile["principal"], StructType([StructField("datoGeneral", _text_struct(_MAIN_FIELDS.values()))])),
            "_more": F.from_json(profile[SHARED_PART], shared),
        }
    )
    column_of = {target: F.col(f"consolidated_profile.{part}") for part, target in parts.items()}
    columns = []
    for field in RESUME.fields:
        flat = F.coalesce(F.col(field.name), F.col(f"data.{field.name}"))
        if field.name == "oDatosPersonales":
            flat = F.coalesce(flat, F.when(F.col("base_info").isNotNull(), _personal(field.dataType)))
        elif field.name in column_of:
            flat = F.coalesce(flat, _parsed(column_of[field.name], field.dataType))
        if field.name in SHARED_COLUMNS:
            flat = F.coalesce(flat, F.col("_more")[field.name])
        columns.append(flat.alias(field.name))
    return df.select(*columns, "source_category", CORRUPT)


def rename_section(section: str, value: Column) -> Column:
    """A section struct under its domain names; numbers that are absent become 0."""
    fields = []
    for source, (target, dtype) in SECTIONS[section].items():
        field = value[source]
        if dtype == "double":
            field = F.coalesce(P.to_double(field), F.lit(0.0))
        elif dtype == "bigint":
            field = P.to_long(field)
        fields.append(field.cast(dtype).alias(target))
    return F.struct(*fields)


def rename_items(section: str, items: Column) -> Column:
    """A list of section structs under their domain names; no list becomes an empty one."""
    renamed = F.transform(items, lambda item: rename_section(section, item))
    return F.coalesce(renamed, F.array_repeat(F.get(renamed, F.lit(0)), 0))


def candidate_summary(resumes: DataFrame) -> DataFrame:
    """The domain view of a candidate: identity, total income, number of properties, record."""
    person = F.col("oDatosPersonales")
    income = F.col("oIngresos")
    earned = [
        F.coalesce(P.to_double(income[name]), F.lit(0.0))
        for name, (_, dtype) in SECTIONS["ingresos"].items()
        if dtype == "double"
    ]
    records = P.sum_across(P.list_count("lSentenciaPenal"), P.list_count("lSentenciaObliga"))
    return resumes.select(
        *[
            person[source].cast(dtype).alias({"cargo_postula": "cargo_postulacion"}.get(target, target))
            for source, (target, dtype) in SECTIONS["datos_personales"].items()
            if target != "fecha_nacimiento"
        ],
        P.sum_across(*earned).alias("total_ingresos"),
        P.list_count("lBienInmueble").alias("num_propiedades"),
        (records > 0).alias("tiene_antecedentes"),
    )


def _text_struct(names: Iterable[str]) -> StructType:
    return StructType([StructField(name, StringType()) for name in names])


def _personal(dtype: DataType) -> Column:
    """Personal data of a wrapped record: the list entry first, then the main part."""
    fields = []
    for field in dtype.fields:
        found = F.col("_base")[field.name]
        if field.name in _MAIN_FIELDS:
            found = F.coalesce(found, F.col("_main.datoGeneral")[_MAIN_FIELDS[field.name]])
        fields.append(found.try_cast(field.dataType).alias(field.name))
    return F.struct(*fields)


def _parsed(text: Column, dtype: DataType) -> Column:
    """A part of a profile in its type; a list where one struct is due gives its first item."""
    if isinstance(dtype, ArrayType):
        return F.from_json(text, dtype)
    return F.get(F.from_json(text, ArrayType(dtype)), F.lit(0))
