from __future__ import annotations

import json
from pathlib import Path

import pytest

from probity.schemas import COMPANY_LINKS, CONSORTIA, PENALTIES, SANCTIONS, SILVER
from probity.sources import layers as Y
from probity.sources import registry as R
from probity.sources.delimited import read_delimited
from probity.sources.resumes import candidate_summary, read_resumes, rename_items, rename_section
from pyspark.sql import functions as F

HEAD = "RUC|NOMBRE_RAZONODENOMINACIONSOCIAL|FECHA_INICIO|FECHA_FIN|DE_MOTIVO_INFRACCION|NUMERO_RESOLUCION"


def write(path, text, encoding="utf-8"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode(encoding) if isinstance(text, str) else text)


def test_ids_keep_leading_zeros_and_odd_rows_are_read(spark, tmp_path):
    write(tmp_path / "f.csv", b'A|B|C\n007|"x|""y"""|1\n1|short\n2|b|c|surplus\n3|\xff|z\n')
    rows = [tuple(r) for r in read_delimited(spark, str(tmp_path / "f.csv")).collect()]
    assert rows[:3] == [("007", 'x|"y"', "1"), ("1", "short", None), ("2", "b", "c")]
    assert rows[3][1] == "�"


def test_unquoted_files_take_quotes_as_text(spark, tmp_path):
    write(tmp_path / "f.csv", 'A|B\n"x|y"\n')
    assert tuple(read_delimited(spark, str(tmp_path / "f.csv"), quoted=False).first()) == ('"x', 'y"')


def test_one_sanction_is_read_and_normalised(spark, tmp_path):
    write(tmp_path / "sancionados.csv", f"{HEAD}\n20987654321|Molinos del Alba S.A.|2019-05-02|2020-05-01|entrega tardía|R-77-2019\n")
    rows = R.read_sanctions(spark, str(tmp_path)).collect()
    assert len(rows) == 1
    assert (rows[0].ruc, rows[0].nombre_empresa_norm, rows[0].tipo_sancion) == (
        "20987654321",
        "MOLINOS DEL ALBA",
        "INHABILITACION",
    )


def test_three_feeds_make_one_registry(spark, tmp_path):
    write(tmp_path / "sancionados.csv", f"{HEAD}\n1|A SAC|a|b|m|r\n2||a|b|m|r\n")
    write(tmp_path / "sancionados_multa.csv", f"{HEAD}|MONTO\n3|B|a|b|m|r|10.5\n4|C|a|b|m|r|x\n")
    court = HEAD.replace("RUC|", "RUC_DNI|").replace("DE_MOTIVO_INFRACCION|", "")
    write(tmp_path / "inhabilitaciones_judiciales.csv", f"{court}\n5|D|a|b|r\n")
    df = R.read_sanctions(spark, str(tmp_path))
    assert df.schema.names == SANCTIONS.names
    found = {(r.ruc[-1], r.tipo_sancion, r.motivo, r.monto) for r in df.collect()}
    assert found == {
        ("1", "INHABILITACION", "m", None),
        ("3", "MULTA", "m", 10.5),
        ("4", "MULTA", "m", None),
        ("5", "INHABILITACION_JUDICIAL", None, None),
    }


def test_missing_files_give_empty_tables_of_the_right_schema(spark, tmp_path):
    folder = str(tmp_path)
    for df, schema in (
        (R.read_sanctions(spark, folder), SANCTIONS),
        (R.read_penalties(spark, folder), PENALTIES),
        (R.read_company_links(spark, folder), COMPANY_LINKS),
        (R.read_consortia(spark, folder).rows, CONSORTIA),
        (Y.read_layer(spark, f"{folder}/none", SILVER), SILVER),
    ):
        assert df.count() == 0
        assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in schema]


def test_penalties_take_the_real_contracting_entity(spark, tmp_path):
    head = "RUC CONTRATISTA|TIPO PENALIDAD|OBJETO CONTRATO|ENTIDAD CONTRATANTE|FECHA PENALIDAD|DESCRIPCION/MOTIVO|MONTO"
    write(tmp_path / "penalidades.csv", f'{head}\n20|T|obj|ent "1|f|d|7|more\n21|T|obj\n')
    first, second = R.read_penalties(spark, str(tmp_path)).orderBy("ruc").collect()
    assert (first.ruc, first.entidad_contratante, first.monto, first.nombre_empresa) == (
        "00000000020",
        'ent "1',
        7.0,
        None,
    )
    assert second.entidad_contratante is None and second.nombre_empresa_norm == ""


def test_company_links_are_unique_pairs(spark, tmp_path):
    text = "NUMERO_DOCUMENTO|RUC|NOMBRE_RAZONODENOMINACIONSOCIAL\n 01 |5|B\n01|5|A\n|5|C\n02||D\n"
    write(tmp_path / "conformacion_juridica.csv", text)
    rows = [tuple(r) for r in R.read_company_links(spark, str(tmp_path)).collect()]
    assert rows == [("01", "00000000005", "A")]


def test_consortium_files_with_other_headers_are_skipped_and_named(spark, tmp_path):
    write(tmp_path / "CONOSCE_CONSORCIO_2022.csv", "AÑO| RUC_CONSORCIO |CONSORCIO|RUC_MIEMBRO|MIEMBRO\n2022|1|c|2|m\n")
    write(tmp_path / "CONOSCE_CONSORCIO_2023.csv", "año|ruc_consorcio|consorcio|ruc_miembro|miembro\nx|3|c|4|m\n")
    write(tmp_path / "CONOSCE_CONSORCIO_2024.csv", "a|b\n1|2\n")
    write(tmp_path / "CONOSCE_CONSORCIO_2025.csv", "x\n")
    write(tmp_path / "other.csv", "a|b\n1|2\n")
    scan = R.read_consortia(spark, str(tmp_path))
    assert {(r.anio, r.ruc_miembro) for r in scan.rows.collect()} == {
        (2022, "00000000002"),
        (None, "00000000004"),
    }
    assert [path.rsplit("_", 1)[1] for path in scan.skipped] == ["2024.csv", "2025.csv"]
    write(tmp_path / "CONOSCE_CONSORCIO_2026.parquet", "no parquet")
    with pytest.raises(Exception, match="2026"):
        R.read_consortia(spark, str(tmp_path))


def test_registry_is_built_once_and_then_read(spark, tmp_path):
    raw, staging = tmp_path / "raw", str(tmp_path / "staging")
    write(raw / "sancionados.csv", f"{HEAD}\n1|A|a|b|m|r\n")
    assert R.load_registry(spark, str(raw), staging).sanctions.count() == 1
    write(tmp_path / "staging/sanctions/_kept", "")
    assert R.load_registry(spark, str(raw), staging).sanctions.count() == 1
    assert Y.path_exists(spark, staging + "/sanctions/_kept"), "raw files are the same, so nothing is written"
    write(raw / "sancionados.csv", f"{HEAD}\n1|A|a|b|m|r\n2|B|a|b|m|r\n")
    write(raw / "CONOSCE_CONSORCIO_2024.csv", "a|b\n1|2\n")
    changed = R.load_registry(spark, str(raw), staging)
    assert changed.sanctions.count() == 2
    assert [r.path.rsplit("/", 1)[1] for r in changed.skipped.collect()] == ["CONOSCE_CONSORCIO_2024.csv"]


def test_unfinished_tables_are_built_again(spark, tmp_path):
    path = str(tmp_path / "kept")
    build = lambda: spark.range(3)
    assert Y.materialize(spark, path, build).count() == 3
    assert Y.materialize(spark, path, lambda: spark.range(5)).count() == 3
    write(tmp_path / "part/part-0.parquet", "half a file")
    assert Y.materialize(spark, str(tmp_path / "part"), build).count() == 3


def test_layers(spark, tmp_path):
    df = spark.range(100).selectExpr("id", "id % 3 AS part")
    path = str(tmp_path / "layer")
    Y.write_layer(df, path, sort_by="id")
    Y.write_layer(df.where("id < 50"), path, partition_by=["part"])
    assert Y.read_layer(spark, path).count() == 50
    assert Y.path_exists(spark, path) and not Y.path_exists(spark, path + "x")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        Y.read_layer(spark, path + "x")
    staged = Y.stage(df, "numbers")
    assert staged.dtypes == df.dtypes and staged.count() == 100
    assert Y.spread(df.coalesce(1)).rdd.getNumPartitions() == 8
    Y.export_csv(df, str(tmp_path / "csv"))
    assert read_delimited(spark, str(tmp_path / "csv"), sep=",").count() == 100


FLAT = {
    "oDatosPersonales": {"idHojaVida": 7, "strDocumentoIdentidad": "12345678", "strNombres": "Juan"},
    "oIngresos": {"decRemuBrutaPublico": 1200.5, "decRemuBrutaPrivado": "S/ 1,000.00"},
    "lBienInmueble": [{"decValor": 10, "decAutovaluo": "2.5"}],
    "lRenunciaOP": [{"strAny": "x", "nested": {"a": 1}}],
    "unknown": 1,
}
WRAPPED = {
    "base_info": {"strDocumentoIdentidad": "87654321", "idOrganizacionPolitica": 3, "idHojaVida": 12345},
    "consolidated_profile": {
        "principal": {"datoGeneral": {"nombres": "Juan", "apellidoPaterno": "Perez"}},
        "experiencia_laboral": [],
        "ingresos": [{"decRemuBrutaPublico": 5}],
        "bienes_inmuebles": {"decValor": 1},
        "sentencia_penal": None,
        "info_adicional": {"lRenunciaOP": [{"a": "b"}, {}], "lTitularidad": [{"strPersonaJuridica": "Molino"}]},
    },
}


def test_flat_wrapped_and_broken_files_in_one_scan(spark, tmp_path):
    root = tmp_path / "raw data"
    write(root / "senadores" / "a.json", json.dumps(FLAT, indent=4))
    write(root / "presidenciales" / "deep" / "b.json", json.dumps(WRAPPED, indent=4))
    write(root / "diputados" / "c.json", "{ no json")
    write(root / "diputados" / "note.txt", "{}")
    write(root / "elsewhere" / "d.json", json.dumps(FLAT))
    response = {"success": True, "data": FLAT, "message": None}
    write(root / "parlamento_andino" / "e.json", json.dumps(response))
    df = read_resumes(spark, str(root)).cache()
    rows = {r.source_category: r for r in df.collect()}
    assert set(rows) == {"senadores", "presidenciales", "diputados", "parlamento_andino"}
    answered = rows["parlamento_andino"]
    assert answered.oDatosPersonales == rows["senadores"].oDatosPersonales and answered.lEduUniversitaria is None
    flat, wrapped = rows["senadores"], rows["presidenciales"]
    assert flat.oIngresos.decRemuBrutaPublico == "1200.5" and json.loads(flat.lRenunciaOP[0]["nested"]) == {"a": 1}
    person = wrapped.oDatosPersonales
    assert (person.strNombres, person.strApellidoPaterno, person.strDocumentoIdentidad) == (
        "Juan",
        "Perez",
        "87654321",
    )
    assert (person.idHojaVida, person.idOrganizacionPolitica) == (12345, "3")
    assert wrapped.lExperienciaLaboral == [] and wrapped.oIngresos.decRemuBrutaPublico == "5"
    assert wrapped.lBienInmueble[0].decValor == "1" and wrapped.lSentenciaPenal is None
    assert len(wrapped.lRenunciaOP) == 2 and wrapped.lTitularidad[0].strPersonaJuridica == "Molino"
    assert rows["diputados"]._corrupt_record is not None and rows["diputados"].oDatosPersonales is None


def test_no_resumes(spark, tmp_path):
    assert read_resumes(spark, str(tmp_path / "none")).count() == 0


def test_sections_under_domain_names(spark, tmp_path):
    write(tmp_path / "senadores" / "a.json", json.dumps(FLAT))
    df = read_resumes(spark, str(tmp_path))
    item = df.select(rename_items("bienes_inmuebles", F.col("lBienInmueble")).alias("x")).first().x[0]
    assert item.asDict() == {"tipo": None, "direccion": None, "valor": 10.0, "autovaluo": 2.5}
    assert df.select(rename_items("bienes_muebles", F.col("lBienMueble")).alias("x")).first().x == []
    person = df.select(rename_section("datos_personales", F.col("oDatosPersonales")).alias("p")).first().p
    assert (person.id_hoja_vida, person.dni, person.partido) == (7, "12345678", None)
    summary = candidate_summary(df).first()
    assert (summary.total_ingresos, summary.num_propiedades, summary.tiene_antecedentes) == (1200.5, 1, False)


def test_first_lines_are_found_without_sorting(spark, tmp_path, monkeypatch):
    """Of many files, some longer than a block and some in one task, by hash aggregates only."""
    from pyspark.sql.classic.dataframe import DataFrame

    from probity.sources import registry

    files = {str(tmp_path / f"CONOSCE {i}"): [f"head {i}", *(f"{9 - i} row {j}" for j in range(500 * i))] for i in range(6)}
    for path, lines in files.items():
        Path(path).write_text("\n".join(lines) + "\n")
    plans, real = [], DataFrame.collect
    monkeypatch.setattr(DataFrame, "collect", lambda df: plans.append(df._jdf.queryExecution().toString()) or real(df))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
    try:
        assert registry._first_lines(spark, list(files)) == {p: lines[0] for p, lines in files.items()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert plans and not any("SortAggregate" in p for p in plans)


def test_staged_tables_leave_no_shuffle_files(spark):
    """What a write shuffled goes with it, and the session's own setting stays."""
    blocks = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager()
    files = lambda: {f for f in blocks.getAllFiles().mkString("\n").split("\n") if "shuffle_" in f}
    before, had = files(), spark.conf.get(Y.CLEANUP)
    assert Y.stage(spark.range(1000).groupBy(F.col("id") % 10).count(), "shuffled").limit(99).collect()
    assert not files() - before and spark.conf.get(Y.CLEANUP) == had
