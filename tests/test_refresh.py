"""All layers from raw files, twice."""

from __future__ import annotations

import json

import pytest

from probity.operators.paging import lookup
from probity.operators.quality import DataQualityError
from probity.plans.refresh import Folders, refresh_layers
from probity.schemas import GOLD
from probity.sources.layers import append_history, path_exists, read_history, read_layer, work_folder


def resume(number, **changes):
    person = {
        "strDocumentoIdentidad": str(number),
        "strNombres": "josé  maría",
        "strApellidoPaterno": "o'brien",
        "strApellidoMaterno": None,
        "strFechaNacimiento": "1970-01-01",
        "strOrganizacionPolitica": "partido  único",
        "idOrganizacionPolitica": number % 2,
    }
    record = {
        "oDatosPersonales": {**person, **changes.pop("person", {})},
        "oIngresos": {"decRemuBrutaPublico": "S/ 1,200.00", "decRemuBrutaPrivado": "800"},
        "lBienInmueble": [{"decValor": str(1000 * number), "decAutovaluo": "1"}],
    }
    return {**record, **changes}


@pytest.fixture
def folders(spark, tmp_path):
    def write(path, text):
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text, encoding="utf-8")

    for number in range(1, 11):
        record = resume(number)
        if number == 2:
            record["lTitularidad"] = [{"strPersonaJuridica": "Minera Andina SAC"}]
        if number == 3:
            record["lSentenciaPenal"] = [{"a": "b"}, {"a": "c"}]
        if number == 10:
            record["oDatosPersonales"]["strNombres"] = " "
        write(tmp_path / "raw" / "senadores" / f"{number}.json", json.dumps(record, indent=2))
    head = "RUC|NOMBRE_RAZONODENOMINACIONSOCIAL|FECHA_INICIO|FECHA_FIN|DE_MOTIVO_INFRACCION|NUMERO_RESOLUCION"
    write(tmp_path / "osce" / "sancionados.csv", f"{head}\n5|Mineria Andina S.A.|a|b|m|r\n6|Otra|a|b|m|r\n")
    links = "NUMERO_DOCUMENTO|RUC|NOMBRE_RAZONODENOMINACIONSOCIAL\n00000001|6|Otra puente\n"
    write(tmp_path / "osce" / "conformacion_juridica.csv", links)
    plans = spark.createDataFrame(
        [("1", "s", None, "a", "i")],
        "id_organizacion_politica string, dimension_social string, dimension_economica string, "
        "dimension_ambiental string, dimension_institucional string",
    )
    append_history(plans, str(tmp_path / "plans"))
    at = lambda name: str(tmp_path / name)
    return Folders(
        at("raw"), at("osce"), at("staging"), at("silver"), at("gold"), at("rejected"), at("audit"), at("plans")
    )


def test_two_refreshes(spark, folders, tmp_path):
    silver, gold = refresh_layers(spark, folders)
    assert silver.quality.total == 10 and silver.quality.invalid == 1 and silver.changes == 0
    assert read_history(spark, folders.rejected).first().motivo_rechazo == "campo critico nulo: nombres"
    assert gold.gold.columns == GOLD.names and gold.gold.count() == 9
    rows = {r.dni: r for r in gold.gold.collect()}
    person = rows["00000001"]
    assert (person.nombres, person.apellido_paterno, person.partido) == ("Jose Maria", "O'Brien", "Partido Unico")
    assert person.ingresos_totales == 2000 and person.valor_total_bienes == 1001
    assert (person.osce_match_method, person.ruc_sancionado) == ("DETERMINISTIC", "00000000006")
    assert person.search_context == "s \n  \n a \n i" and rows["00000002"].search_context is None
    assert (rows["00000002"].osce_match_method, rows["00000002"].ruc_sancionado) == ("FUZZY", "00000000005")
    assert rows["00000003"].score_legal == 0 and rows["00000004"].osce_match_score is None
    assert lookup(gold.gold, "global_id", person.global_id).first().dni == "00000001"

    changed = resume(4, lRenunciaOP=[{"x": "y"}])
    (tmp_path / "raw" / "senadores" / "4.json").write_text(json.dumps(changed), encoding="utf-8")
    silver, gold = refresh_layers(spark, folders)
    assert silver.changes == 1
    fields = {r.field_changed for r in read_history(spark, folders.audit).collect()}
    assert {"cantidad_renuncias", "score_estabilidad", "score_itr"} <= fields
    assert gold.changes == 3

    assert not path_exists(spark, f"{work_folder(spark)}/run-*"), "a run deletes what it staged"
    assert not path_exists(spark, f"{tmp_path}/*.new-*") and not path_exists(spark, f"{tmp_path}/*.old-*")
    assert path_exists(spark, f"{folders.gold}/_SUCCESS")


def test_too_many_bad_records_stop_before_silver_is_replaced(spark, folders, tmp_path):
    for number in range(20, 30):
        bad = resume(number, person={"strDocumentoIdentidad": "x"})
        (tmp_path / "raw" / "senadores" / f"{number}.json").write_text(json.dumps(bad), encoding="utf-8")
    with pytest.raises(DataQualityError):
        refresh_layers(spark, folders)
    assert not path_exists(spark, folders.silver)
    assert read_history(spark, folders.rejected).count() == 11
