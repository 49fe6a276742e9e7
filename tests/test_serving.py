from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from probity.operators import dossier as D
from probity.operators import paging as G


@pytest.fixture
def feeds(spark):
    sanctions = spark.createDataFrame(
        [("00000000001", "B"), ("00000000001", "A")], "ruc string, nombre_empresa string"
    ).selectExpr(
        "ruc", "nombre_empresa", "'MULTA' AS tipo_sancion", "'a' AS fecha_inicio", "'b' AS fecha_fin",
        "'m' AS motivo", "1D AS monto", "'r' AS numero_resolucion",
    )
    penalties = spark.createDataFrame([("00000000002", None)] * 2, "ruc string, nombre_empresa string")
    consortia = spark.createDataFrame(
        [(2020, "00000000001", "c", "00000000003", "m"), (2021, "00000000003", "c", "00000000003", "m")],
        "anio bigint, ruc_consorcio string, consorcio string, ruc_miembro string, miembro string",
    )
    links = spark.createDataFrame(
        [("x", "00000000002", "Enlace"), ("x", "00000000009", "Nadie")],
        "numero_documento string, ruc string, nombre_empresa string",
    )
    return sanctions, penalties, consortia, links


def test_dossiers_count_each_feed(feeds):
    rows = {r.ruc[-1]: r for r in D.company_dossiers(*feeds).collect()}
    assert set(rows) == {"1", "2", "3"}
    one, two, three = rows["1"], rows["2"], rows["3"]
    assert (one.nombre_empresa, one.total_sanciones, one.en_penalidades, one.total_consorcios) == ("A", 2, False, 1)
    assert (two.nombre_empresa, two.total_penalidades, two.en_consorcios) == ("Enlace", 2, False)
    # a row that names one company twice counts once
    assert (three.nombre_empresa, three.total_consorcios, three.en_consorcios) == (None, 2, True)
    assert one.fup_url.endswith("/00000000001")


def test_one_company(feeds):
    dossier, sanctions = D.company_dossier(" 00000000001 ", *feeds)
    assert dossier.count() == 1 and sanctions.count() == 2
    missing, none = D.company_dossier("00000000009", *feeds)
    assert missing.count() == 0 and none.count() == 0
    for bad in ("1", "0000000000x", "000000000011", "0000000000²"):
        with pytest.raises(ValueError):
            D.company_dossier(bad, *feeds)


def test_requests(spark, feeds):
    asked = spark.createDataFrame([(" 00000000001 ",), ("00000000009",), ("7",)], "ruc string")
    rows = D.requested_dossiers(asked, D.company_dossiers(*feeds)).collect()
    assert {(r.ruc, r.status) for r in rows} == {
        ("00000000001", "found"),
        ("00000000009", "not_found"),
        ("7", "invalid"),
    }


def test_pages_and_their_envelope(spark):
    df = spark.range(45).repartition(4)
    first = G.fetch_page(df, "id")
    assert [r.id for r in first.rows.collect()] == list(range(20))
    assert (first.total, first.limit, first.offset, first.has_next) == (45, 20, 0, True)
    last = G.fetch_page(df, "id", limit=20, offset=40)
    assert [r.id for r in last.rows.collect()] == list(range(40, 45)) and not last.has_next
    beyond = G.fetch_page(df, "id", offset=99)
    assert beyond.rows.count() == 0 and not beyond.has_next
    assert G.page_limit(None) == 20 and G.page_limit(100) == 100
    for limit, offset in ((101, 0), (0, 0), (-1, 0), (5, -1)):
        for refused in (G.page, G.page_info):
            with pytest.raises(ValueError):
                refused(*([df, "id"] if refused is G.page else [df]), limit=limit, offset=offset)
    assert G.page_info(df, limit=45).first().has_next is False


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("dtype", ["bigint", "string"])
def test_deep_pages_equal_sorting(spark, descending, dtype):
    rnd = random.Random(3)
    keys = rnd.sample(range(10**6), 3000)
    keys = [str(k) for k in keys] if dtype == "string" else keys
    df = spark.createDataFrame([(k,) for k in keys], f"k {dtype}").repartition(5)
    ordered = sorted(keys, reverse=descending)
    for offset in (0, 1234, 2990, 3000):
        rows = G.page(df, "k", 20, offset, descending, shallow=30).collect()
        assert [r.k for r in rows] == ordered[offset : offset + 20]


def test_pages_by_key(spark):
    df = spark.range(10)
    assert [r.id for r in G.page_after(df, "id", None, 3).collect()] == [0, 1, 2]
    assert [r.id for r in G.page_after(df, "id", 2, 3).collect()] == [3, 4, 5]
    assert [r.id for r in G.page_after(df, "id", 3, 2, descending=True).collect()] == [2, 1]
    assert G.page_after(df, "id", 9).count() == 0


def test_lookup(spark):
    df = spark.createDataFrame([("a", 2), ("a", 1), ("b", 3)], "global_id string, n int")
    assert G.lookup(df, "global_id", "a").first().n == 1
    assert G.lookup(df, "global_id", "z").count() == 0


def test_responses(spark):
    df = spark.createDataFrame([([None, "x"],), (None,)], "risk_flags array<string>")
    assert [r.risk_flags for r in G.response_rows(df).collect()] == [["x"], []]
    assert G.response_rows(df).columns == ["risk_flags"]
    assert F.col is not None


@pytest.mark.parametrize("descending", [False, True])
def test_rows_without_key_come_last_and_are_all_reached(spark, descending):
    df = spark.createDataFrame([(k, f"r{i}") for i, k in enumerate([*range(200), *[None] * 30])], "k int, r string").repartition(4)
    whole = [r.r for r in G.page(df, "k", 100, 0, descending).collect()]
    whole += [r.r for r in G.page(df, "k", 100, 100, descending).collect()]
    whole += [r.r for r in G.page(df, "k", 100, 200, descending).collect()]
    assert len(whole) == 230 == len(set(whole))
    for offset in (0, 50, 190, 205, 229, 230):
        deep = [r.r for r in G.page(df, "k", 20, offset, descending, shallow=10).collect()]
        assert deep == whole[offset : offset + 20]
    walked, last, keyless = [], None, 0
    while page := G.page_after(df, "k", last, 40, descending, keyless).collect():
        walked += [r.r for r in page]
        keyless += sum(r.k is None for r in page)
        last = page[-1].k
    assert walked == whole
    assert G.page_info(df, 20, 220).first().total == 230
