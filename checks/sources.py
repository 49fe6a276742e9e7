"""Readers on files Spark first derives from the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from probity import functions as P
from probity.operators.quality import BAD_ID, BAD_ID_AND_NAME, BAD_NAME, REASON
from probity.plans import arrivals
from probity.plans.silver import to_silver
from probity.sources.delimited import read_delimited
from probity.sources.layers import delete, export_csv, materialize, move_file, read_layer, work_path, write_layer
from probity.sources.registry import load_registry, read_consortia, read_penalties, read_sanctions
from probity.sources.resumes import candidate_summary, flatten_profiles, read_resumes, rename_items

from .cleaning import sql_company, sql_standard, sql_title, sql_uuid5
from .registered import Tables, query


def pad(column: str, width: int = 11) -> str:
    return f"lpad(CAST({column} AS STRING), {width}, '0')"


def _write(df: DataFrame, path: str, quoted: bool = True) -> None:
    df.write.csv(path, sep="|", header=True, quote='"' if quoted else "", escape='"')


SANCTION_FILES = f"""
    SELECT CASE s_suppkey % 3 WHEN 0 THEN 'INHABILITACION' WHEN 1 THEN 'MULTA' ELSE 'INHABILITACION_JUDICIAL' END
            AS kind,
        ' 20-' || {pad('s_suppkey', 9)} AS tax_id,
        CASE WHEN s_suppkey % 7 <> 2 THEN s_name || ' "Norte" S.A.C.' END AS name,
        '2023-01-01' AS starts, CAST(NULL AS STRING) AS ends, 'motivo | ' || s_name AS reason,
        CASE WHEN s_suppkey % 2 = 0 THEN CAST(s_suppkey AS STRING) || '.5' ELSE 'S/M' END AS amount,
        'RES-' || CAST(s_suppkey AS STRING) AS resolution
    FROM {{supplier}}"""


def _sanction_folder(t: Tables) -> str:
    folder = work_path(t.spark, "raw-registry")
    rows = t.sql(SANCTION_FILES)
    columns = {
        "tax_id": "RUC",
        "name": "NOMBRE_RAZONODENOMINACIONSOCIAL",
        "starts": "FECHA_INICIO",
        "ends": "FECHA_FIN",
        "reason": "DE_MOTIVO_INFRACCION",
        "amount": "MONTO",
        "resolution": "NUMERO_RESOLUCION",
    }
    files = {
        "INHABILITACION": ("sancionados.csv", ["amount"]),
        "MULTA": ("sancionados_multa.csv", []),
        "INHABILITACION_JUDICIAL": ("inhabilitaciones_judiciales.csv", ["amount", "reason"]),
    }
    for kind, (name, left_out) in files.items():
        feed = rows.where(F.col("kind") == kind).drop("kind", *left_out).withColumnsRenamed(columns)
        if kind == "INHABILITACION_JUDICIAL":
            feed = feed.withColumnRenamed("RUC", "RUC_DNI")
        _write(feed, f"{folder}/{name}")
    return folder


@query(
    f"""SELECT lpad(regexp_replace(tax_id, '[^0-9]', '', 'g'), 11, '0') AS ruc, name AS nombre_empresa,
        kind AS tipo_sancion, starts AS fecha_inicio, ends AS fecha_fin,
        CASE WHEN kind <> 'INHABILITACION_JUDICIAL' THEN reason END AS motivo,
        CASE WHEN kind = 'MULTA' THEN try_cast(amount AS DOUBLE) END AS monto, resolution AS numero_resolucion,
        {sql_company('name')} AS nombre_empresa_norm
    FROM files WHERE name IS NOT NULL""",
    files=SANCTION_FILES,
)
def sanction_files(t: Tables) -> DataFrame:
    return read_sanctions(t.spark, _sanction_folder(t))


PENALTY_FILE = f"""
    SELECT {pad('l_suppkey')} AS tax_id, l_linestatus AS kind, 'objeto' AS subject, 'entidad "' || l_returnflag AS entity,
        'orden ' || CAST(l_orderkey AS STRING) AS happened,
        CASE WHEN l_linenumber % 2 = 0 THEN 'demora' END AS reason,
        CASE WHEN l_linenumber % 3 = 0 THEN 'n/d' ELSE CAST(CAST(l_quantity AS BIGINT) AS STRING) END AS amount
    FROM {{lineitem}} WHERE l_returnflag = 'R'"""


@query(
    """SELECT tax_id AS ruc, CAST(NULL AS VARCHAR) AS nombre_empresa, kind AS tipo_penalidad,
        entity AS entidad_contratante, happened AS fecha_penalidad, reason AS descripcion,
        try_cast(amount AS DOUBLE) AS monto, '' AS nombre_empresa_norm
    FROM file""",
    file=PENALTY_FILE,
)
def penalty_file(t: Tables) -> DataFrame:
    folder = work_path(t.spark, "raw-penalties")
    names = [
        "RUC CONTRATISTA",
        "TIPO PENALIDAD",
        "OBJETO CONTRATO",
        "ENTIDAD CONTRATANTE",
        "FECHA PENALIDAD",
        "DESCRIPCION/MOTIVO",
        "MONTO",
    ]
    _write(t.sql(PENALTY_FILE).toDF(*names), f"{folder}/penalidades.csv", quoted=False)
    return read_penalties(t.spark, folder)


CONSORTIUM_ROWS = f"""
    SELECT CAST(l_linenumber AS STRING) AS y, {pad('l_partkey')} AS c, 'Consorcio ' || l_returnflag AS cn,
        CAST(l_suppkey AS STRING) AS m, 'Miembro ' || l_linestatus AS mn, l_returnflag
    FROM {{lineitem}}"""


@query(
    """SELECT CAST(y AS BIGINT) AS anio, c AS ruc_consorcio, cn AS consorcio, lpad(m, 11, '0') AS ruc_miembro,
        mn AS miembro FROM consortium_rows""",
    consortium_rows=CONSORTIUM_ROWS,
)
def consortium_files(t: Tables) -> DataFrame:
    """Files with two spellings of the header and one that is no consortium file."""
    folder = work_path(t.spark, "raw-consortia")
    rows = t.sql(CONSORTIUM_ROWS)
    old = rows.where("l_returnflag = 'R'").drop("l_returnflag")
    new = rows.where("l_returnflag <> 'R'").drop("l_returnflag")
    _write(old.toDF("AÑO", "RUC_CONSORCIO", "CONSORCIO", "RUC_MIEMBRO", "MIEMBRO "), f"{folder}/old")
    _write(new.toDF("año", "ruc_consorcio", "consorcio", "ruc_miembro", "miembro"), f"{folder}/new")
    _write(t.nation, f"{folder}/other")
    return read_consortia(t.spark, folder, pattern="part-*").rows


COMPANY_LINK_FILE = f"""
    SELECT ' ' || {pad('o_custkey', 8)} || ' ' AS person, CAST(l_suppkey AS STRING) AS tax_id,
        'Supplier ' || CAST(l_suppkey AS STRING) || ' ' || l_returnflag AS name
    FROM {{orders}} JOIN {{lineitem}} ON o_orderkey = l_orderkey"""


@query(
    """SELECT trim(person) AS numero_documento, lpad(tax_id, 11, '0') AS ruc, min(name) AS nombre_empresa
    FROM file GROUP BY 1, 2""",
    file=COMPANY_LINK_FILE,
)
def company_link_file(t: Tables) -> DataFrame:
    """The staged registry: built from raw files on the first read, then only read."""
    folder = _sanction_folder(t)
    rows = t.sql(COMPANY_LINK_FILE)
    _write(
        rows.toDF("NUMERO_DOCUMENTO", "RUC", "NOMBRE_RAZONODENOMINACIONSOCIAL"),
        f"{folder}/conformacion_juridica.csv",
    )
    staging = work_path(t.spark, "staging")
    load_registry(t.spark, folder, staging)
    return load_registry(t.spark, folder, staging).company_links


@query(
    """SELECT 'table' AS what, trim(person) AS numero_documento, lpad(tax_id, 11, '0') AS ruc,
        min(name || ' bis') AS nombre_empresa FROM file GROUP BY 2, 3
    UNION ALL SELECT 'skipped', CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), 'CONOSCE_CONSORCIO_x'""",
    file=COMPANY_LINK_FILE,
)
def registry_restaged(t: Tables) -> DataFrame:
    """Raw files that changed are staged anew, also over staging that did not end; what was left out is told."""
    folder, staging = _sanction_folder(t), work_path(t.spark, "staging")
    names = ("NUMERO_DOCUMENTO", "RUC", "NOMBRE_RAZONODENOMINACIONSOCIAL")
    rows = t.sql(COMPANY_LINK_FILE)
    _write(rows.toDF(*names).limit(10), f"{folder}/conformacion_juridica.csv")
    load_registry(t.spark, folder, staging)
    delete(t.spark, f"{folder}/conformacion_juridica.csv")
    _write(rows.withColumn("name", F.concat("name", F.lit(" bis"))).toDF(*names), f"{folder}/conformacion_juridica.csv")
    t.nation.coalesce(1).write.csv(f"{folder}/other", header=True, sep="|")
    move_file(t.spark, f"{folder}/other/part-*.csv", f"{folder}/CONOSCE_CONSORCIO_x")
    registry = load_registry(t.spark, folder, staging)
    told = registry.skipped.select(F.regexp_extract("path", "[^/]+$", 0).alias("nombre_empresa"))
    table = registry.company_links.withColumn("what", F.lit("table"))
    return table.unionByName(told.withColumn("what", F.lit("skipped")), allowMissingColumns=True)


@query(
    """SELECT 'written' AS layer, count(*) AS n, sum(c_custkey)::BIGINT AS keys FROM customer
    UNION ALL SELECT 'missing', 0, NULL UNION ALL SELECT 'empty', 0, NULL"""
)
def tolerant_layers(t: Tables) -> DataFrame:
    """A layer that is there, one that never was, and one without rows, by one schema."""
    rows = t.customer.select("c_custkey", "c_name")
    paths = {name: work_path(t.spark, name) for name in ("written", "missing", "empty")}
    write_layer(rows, paths["written"], sort_by="c_custkey")
    write_layer(rows.limit(0), paths["empty"])
    counted = [
        read_layer(t.spark, path, rows.schema)
        .agg(F.count("*").alias("n"), F.sum("c_custkey").alias("keys"))
        .select(F.lit(name).alias("layer"), "n", "keys")
        for name, path in paths.items()
    ]
    return counted[0].unionAll(counted[1]).unionAll(counted[2])


@query("SELECT c_custkey, c_name, c_mktsegment || '|\"' || c_name AS odd FROM customer")
def layer_round_trip(t: Tables) -> DataFrame:
    """Parquet layer, CSV export and tolerant read, in a row."""
    rows = t.customer.select(
        "c_custkey", "c_name", F.concat("c_mktsegment", F.lit('|"'), "c_name").alias("odd")
    )
    layer, export = work_path(t.spark, "layer"), work_path(t.spark, "export")
    write_layer(rows, layer)
    export_csv(read_layer(t.spark, layer, rows.schema), export, sep="|")
    back = read_delimited(t.spark, export)
    again = materialize(t.spark, work_path(t.spark, "kept"), lambda: back)
    return again.select(P.to_long("c_custkey").alias("c_custkey"), "c_name", "odd")


# Résumés derived from documents: one line of text is one asset and one job.
RESUME_LINES = """string_split(text, chr(10))"""


def _resumes(t: Tables) -> DataFrame:
    lines = F.split("text", "\n")
    size = F.length
    person = F.struct(
        F.col("doc_id").alias("idHojaVida"),
        (F.col("doc_id") % 7).cast("string").alias("idOrganizacionPolitica"),
        F.when(F.col("doc_id") % 4 == 0, F.col("doc_id").cast("string"))
        .otherwise(F.concat(F.col("doc_id").cast("string"), F.lit("00000000")))
        .alias("strDocumentoIdentidad"),
        F.concat(F.lit(" josé  "), "lang").alias("strNombres"),
        F.upper("source").alias("strApellidoPaterno"),
        F.lit("o'brien-núñez").alias("strApellidoMaterno"),
        F.lit(" 1970-01-01 ").alias("strFechaNacimiento"),
        F.lit("SENADOR nacional").alias("strCargoEleccion"),
        F.concat(F.lit("partido "), "source").alias("strOrganizacionPolitica"),
    )
    income = F.struct(
        F.concat(F.lit("S/ "), F.col("n_chars").cast("string")).alias("decRemuBrutaPublico"),
        F.concat(F.col("doc_id").cast("string"), F.lit(",50")).alias("decRemuBrutaPrivado"),
        (F.col("n_chars") + 0.25).alias("decRentaIndividualPublico"),
    )

    def property_of(line):
        return F.struct(
            size(line).cast("string").alias("decValor"),
            F.when(size(line) % 2 == 0, F.lit("1.5")).otherwise(F.lit("?")).alias("decAutovaluo"),
        )

    def job(line):
        return F.struct(
            F.when(size(line) % 3 == 0, F.lit("publico")).otherwise(F.lit("privado")).alias("strSector"),
            F.when(size(line) % 2 == 0, F.lit("2")).alias("intAnioTrabajo"),
        )

    return t.documents.select(
        "doc_id",
        person.alias("oDatosPersonales"),
        income.alias("oIngresos"),
        F.when(F.col("lang") != "de", F.transform(lines, property_of)).alias("lBienInmueble"),
        F.array(F.struct(F.lit("10").alias("decValor"))).alias("lBienMueble"),
        F.transform(lines, job).alias("lExperienciaLaboral"),
        F.when(F.col("doc_id") % 3 == 0, F.array(F.create_map(F.lit("texto"), F.col("lang")))).alias(
            "lSentenciaPenal"
        ),
        F.array(F.struct(F.col("source").alias("strPersonaJuridica"))).alias("lTitularidad"),
        F.array_repeat(F.create_map(F.lit("motivo"), F.col("lang")), (F.col("doc_id") % 5).cast("int")).alias(
            "lRenunciaOP"
        ),
    )


SILVER_SQL = f"""SELECT dni, nombres, apellido_paterno, apellido_materno, fecha_nacimiento, cargo, partido,
        ingresos_totales, cantidad_bienes, valor_total_bienes, conteo_sentencias, experiencia_publica_anios,
        cantidad_renuncias, source_category,
        {sql_uuid5("CASE WHEN regexp_full_match(dni, '[0-9]{8}') THEN dni ELSE k END")} AS global_id
    FROM (SELECT
        CASE WHEN doc_id % 4 = 0 THEN lpad(CAST(doc_id AS VARCHAR), CAST(greatest(8, length(CAST(doc_id AS VARCHAR))) AS INTEGER), '0')
            ELSE CAST(doc_id AS VARCHAR) || '00000000' END AS dni,
        {sql_title("'jose ' || lang")} AS nombres, {sql_title('lower(source)')} AS apellido_paterno,
        'O''Brien-Nuñez' AS apellido_materno, ' 1970-01-01 ' AS fecha_nacimiento, 'Senador Nacional' AS cargo,
        {sql_title(sql_standard("'partido ' || source"))} AS partido,
        'jose ' || lang || '|' || lower(source) || '|o''brien-nuñez|1970-01-01' AS k,
        CAST(n_chars AS DOUBLE) + doc_id + 0.5 AS ingresos_totales,
        CAST(CASE WHEN lang <> 'de' THEN len(lines) ELSE 0 END + 1 AS BIGINT) AS cantidad_bienes,
        CASE WHEN lang <> 'de' THEN list_sum(list_transform(lines, lambda l:
            length(l) + CASE WHEN length(l) % 2 = 0 THEN 1.5e0 ELSE 0 END)) ELSE 0 END + 1e1 AS valor_total_bienes,
        CAST(CASE WHEN doc_id % 3 = 0 THEN 1 ELSE 0 END AS BIGINT) AS conteo_sentencias,
        CAST(list_sum(list_transform(lines, lambda l: CASE WHEN length(l) % 3 <> 0 THEN 0
            WHEN length(l) % 2 = 0 THEN 2 ELSE 1 END)) AS BIGINT) AS experiencia_publica_anios,
        CAST(doc_id % 5 AS BIGINT) AS cantidad_renuncias,
        CASE doc_id % 2 WHEN 0 THEN 'senadores' ELSE 'diputados' END AS source_category
    FROM (SELECT *, {RESUME_LINES} AS lines FROM documents) d) r"""


SILVER_COLUMNS = (
    "dni nombres apellido_paterno apellido_materno fecha_nacimiento cargo partido ingresos_totales "
    "cantidad_bienes valor_total_bienes conteo_sentencias experiencia_publica_anios cantidad_renuncias "
    "source_category global_id"
).split()


@query(SILVER_SQL)
def resume_files_to_silver(t: Tables) -> DataFrame:
    """JSON files in one folder per category, read in one scan and cleaned to Silver.

    Half of the records are written wrapped, half flat.
    """
    root = work_path(t.spark, "raw-resumes")
    resumes = _resumes(t)
    flat = resumes.where("doc_id % 2 = 0").drop("doc_id")
    flat.write.json(f"{root}/senadores/2026")
    person = F.col("oDatosPersonales")
    profile = F.struct(
        F.struct(
            F.struct(
                person["strNombres"].alias("nombres"), person["strApellidoPaterno"].alias("apellidoPaterno")
            ).alias("datoGeneral")
        ).alias("principal"),
        F.col("lExperienciaLaboral").alias("experiencia_laboral"),
        F.array("oIngresos").alias("ingresos"),
        F.col("lBienInmueble").alias("bienes_inmuebles"),
        F.col("lBienMueble").alias("bienes_muebles"),
        F.col("lSentenciaPenal").alias("sentencia_penal"),
        F.struct("lRenunciaOP", "lTitularidad").alias("info_adicional"),
    )
    base = person.dropFields("strNombres", "strApellidoPaterno")
    wrapped = resumes.where("doc_id % 2 = 1").select(
        base.alias("base_info"), profile.alias("consolidated_profile")
    )
    wrapped.write.json(f"{root}/diputados")
    read = read_resumes(t.spark, root, one_record_per_file=False).drop("_corrupt_record")
    return to_silver(read).select(*SILVER_COLUMNS)


@query(
    f"""SELECT *, CASE WHEN NOT good_id AND NOT good_name THEN '{BAD_ID_AND_NAME}' WHEN NOT good_id THEN '{BAD_ID}'
        WHEN NOT good_name THEN '{BAD_NAME}' END AS motivo_rechazo
    FROM (SELECT *, regexp_full_match(dni, '[0-9]{{8}}') AS good_id, length(nombres) > 0 AS good_name
        FROM ({SILVER_SQL}) s) r"""
)
def arrived_resumes(t: Tables) -> DataFrame:
    """Résumé files that come in two drops, taken in by three runs; each row once, valid and rejected apart."""
    to = arrivals.Arrivals(work_path(t.spark, "arrived"), work_path(t.spark, "arrivals"))
    root = work_path(t.spark, "raw-resumes")
    resumes = _resumes(t)
    for drop, category in enumerate(("senadores", "diputados")):
        resumes.where(F.col("doc_id") % 2 == drop).drop("doc_id").write.json(f"{root}/{category}/drop")
        schema = arrivals.take_in(t.spark, root, to, one_record_per_file=False)
    arrivals.take_in(t.spark, root, to, one_record_per_file=False)
    valid = arrivals.valid_arrivals(t.spark, to, schema).withColumn(REASON, F.lit(None).cast("string"))
    rows = valid.unionByName(arrivals.rejected_arrivals(t.spark, to, schema))
    good = F.col(REASON).isNull()
    return rows.select(
        *SILVER_COLUMNS,
        (good | (F.col(REASON) == BAD_NAME)).alias("good_id"),
        (good | (F.col(REASON) == BAD_ID)).alias("good_name"),
        REASON,
    )


@query(SILVER_SQL)
def resumes_to_silver(t: Tables) -> DataFrame:
    category = F.when(F.col("doc_id") % 2 == 0, F.lit("senadores")).otherwise(F.lit("diputados"))
    return to_silver(_resumes(t).withColumn("source_category", category)).select(*SILVER_COLUMNS)


@query(
    f"""SELECT doc_id AS id_hoja_vida,
        CASE WHEN doc_id % 4 = 0 THEN CAST(doc_id AS VARCHAR) ELSE CAST(doc_id AS VARCHAR) || '00000000' END AS dni,
        upper(source) AS apellido_paterno, 'o''brien-núñez' AS apellido_materno, ' josé  ' || lang AS nombres,
        'partido ' || source AS partido, 'SENADOR nacional' AS cargo_postulacion,
        n_chars + 0.25e0 AS total_ingresos,
        CAST(CASE WHEN lang <> 'de' THEN len({RESUME_LINES}) ELSE 0 END AS BIGINT) AS num_propiedades,
        doc_id % 3 = 0 AS tiene_antecedentes
    FROM documents"""
)
def candidate_summaries(t: Tables) -> DataFrame:
    """The domain view; incomes that are money text count 0, those that are numbers add up."""
    return candidate_summary(flatten_profiles(_conformed_resumes(t)))


@query(
    f"""SELECT doc_id, CAST(len(lines) AS BIGINT) AS n,
        list_aggregate(list_transform(lines, lambda l: CAST(length(l) AS VARCHAR)), 'string_agg', ';') AS valores,
        list_sum(list_transform(lines, lambda l: CASE WHEN length(l) % 2 = 0 THEN 1.5e0 ELSE 0e0 END)) AS autovaluos
    FROM (SELECT doc_id, CASE WHEN lang <> 'de' THEN {RESUME_LINES} ELSE [] END AS lines FROM documents) d"""
)
def section_renames(t: Tables) -> DataFrame:
    """A section under its domain names, with numbers and defaults filled in."""
    items = rename_items("bienes_inmuebles", F.col("lBienInmueble"))
    renamed = _conformed_resumes(t).select(
        F.col("oDatosPersonales.idHojaVida").alias("doc_id"), items.alias("items")
    )
    values = F.transform("items", lambda i: i["valor"].cast("bigint").cast("string"))
    return renamed.select(
        "doc_id",
        F.size("items").cast("bigint").alias("n"),
        F.when(F.size("items") > 0, F.array_join(values, ";")).alias("valores"),
        F.when(F.size("items") > 0, P.list_sum("items", "autovaluo")).alias("autovaluos"),
    )


def _conformed_resumes(t: Tables) -> DataFrame:
    """The derived résumés in the full source schema."""
    from probity.schemas import RESUME
    from probity.sources.resumes import wrapped_schema

    text = _resumes(t).select(F.to_json(F.struct("*")).alias("j"))
    parsed = text.select(F.from_json("j", wrapped_schema()).alias("r")).select("r.*")
    return parsed.select(
        *RESUME.names,
        "data",
        "base_info",
        "consolidated_profile",
        F.lit("senadores").alias("source_category"),
        F.lit(None).cast("string").alias("_corrupt_record"),
    )
