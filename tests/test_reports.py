from __future__ import annotations

from datetime import date

from probity.operators import conform as C
from probity.operators import reports as R

import pytest


def test_completeness(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", None, "x"), ("b", 1, "x")], "source_category string, n int, s string")
    rows = {(r.source_category, r.field): r.percent_present for r in R.completeness(df).collect()}
    assert rows == {("a", "n"): 50, ("a", "s"): 50, ("b", "n"): 100, ("b", "s"): 100}


def test_distribution_and_freshness(spark):
    df = spark.createDataFrame([("a", "2024-01-02"), ("a", "2025-01-02"), ("b", "x")], "s string, d string")
    assert {(r.s, r.entities) for r in R.distribution(df, "s").collect()} == {("a", 2), ("b", 1)}
    assert {(r.s, r.latest, r.dated_rows) for r in R.freshness(df, "s", "d").collect()} == {
        ("a", date(2025, 1, 2), 2),
        ("b", None, 0),
    }
    other = spark.createDataFrame([("a", "20250102")], "s string, d string")
    assert R.freshness(other, "s", "d", "yyyyMMdd").first().latest == date(2025, 1, 2)


def test_thresholds(spark):
    pairs = spark.createDataFrame(
        [("MARTHA", "MARTHA", True), ("MARTHA", "MARHTA", True), ("MARTHA", "MARTHI", False), ("A", "Z", True)],
        "left string, right string, same boolean",
    )
    rows = {r.threshold: r for r in R.evaluate_thresholds(pairs, [0.5, 0.97, 1.0]).collect()}
    assert (rows[0.5].found, rows[0.5].correct) == (3, 2)
    assert rows[1.0].precision == 1 and rows[1.0].recall == pytest.approx(1 / 3)


def test_identities(spark):
    df = spark.createDataFrame([("k", "a"), ("k", "b"), ("k", "b"), ("l", "z"), ("l", "y")], "global_id string, n string")
    variants = {tuple(r) for r in R.identity_variants(df, ["n"]).collect()}
    assert variants == {("k", "a", 1), ("k", "b", 2), ("l", "z", 1), ("l", "y", 1)}
    chosen = {tuple(r) for r in R.canonical_identities(df, ["n"]).collect()}
    assert chosen == {("k", "b", 2, 3), ("l", "y", 2, 2)}


def test_backfill(spark):
    schema = "id int, t string, l array<string>, n int"
    df = spark.createDataFrame([(1, " ", [], None), (2, "a", ["x"], 5), (3, None, None, None)], schema)
    detail = spark.createDataFrame([(1, "d", ["y"], 7), (1, "e", ["z"], 8), (2, "d", ["y"], 7)], schema)
    filled = {tuple(map(str, r)) for r in R.backfill(df, detail, "id", ["t", "l", "n"]).collect()}
    assert filled == {
        ("1", "d", "['y']", "7"),
        ("2", "a", "['x']", "5"),
        ("3", "None", "None", "None"),
    }
    replaced = R.backfill(df, detail, "id", ["t", "n"], prefer_detail=True).where("id = 2").first()
    assert (replaced.t, replaced.n, replaced.l) == ("d", 7, ["x"])


def test_stacking(spark):
    a = spark.createDataFrame([(1, "x")], "n int, s string")
    b = spark.createDataFrame([("y", 2)], "s string, n int")
    c = spark.createDataFrame([(3,)], "n bigint")
    with pytest.raises(ValueError):
        C.stack([a, b])
    with pytest.raises(ValueError):
        C.stack([a, a], "sideways")
    assert C.stack([a, a]).count() == 2
    assert {tuple(r) for r in C.stack([a, b], "relaxed").collect()} == {(1, "x"), (2, "y")}
    assert {tuple(r) for r in C.stack([a, c], "diagonal").collect()} == {(1, "x"), (3, None)}


def test_survivors(spark):
    df = spark.createDataFrame([("k", 2, "b"), ("k", 1, "c"), ("k", 1, "a"), ("l", None, None)], "k string, n int, s string")
    assert {tuple(r) for r in C.first_per_key(df, ["k"], ["n"]).collect()} == {("k", 1, "a"), ("l", None, None)}
    assert C.first_per_key(df.select("k"), ["k"], []).count() == 2


def test_unnest_and_align(spark):
    df = spark.createDataFrame([((1, "x"), 2)], "s struct<a: int, b: string>, c int")
    assert C.unnest(df, "s", "absent").columns == ["c", "a", "b"]
    schema = spark.createDataFrame([], "c string, z double").schema
    assert C.align(df, schema).first() == ("2", None)
