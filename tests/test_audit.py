from __future__ import annotations

from pyspark.sql import functions as F

from probity.operators import audit as A
from probity.sources.layers import read_history

SCHEMA = "global_id string, a string, n bigint, x double, risk_flags array<string>"


def test_only_changed_fields_of_common_keys(spark):
    old = spark.createDataFrame(
        [("k", "v", 1, 1.5, ["f"]), ("gone", "v", 1, 1.0, []), ("same", None, None, 2.0, None)],
        SCHEMA,
    ).withColumn("only_old", F.lit(1))
    new = spark.createDataFrame(
        [("k", None, 2, 1.5, ["g"]), ("came", "v", 1, 1.0, []), ("same", None, None, 2.0, ["h"])],
        SCHEMA,
    ).withColumn("only_new", F.lit(1))
    found = A.snapshot_diff(old, new).collect()
    assert {(r.global_id, r.field_changed, r.old_value, r.new_value) for r in found} == {
        ("k", "a", "v", None),
        ("k", "n", "1", "2"),
    }
    assert all(r.timestamp is not None for r in found)


def test_fields_of_other_types_compare_as_text(spark):
    old = spark.createDataFrame([("k", 1), ("l", 2)], "global_id string, n int")
    new = spark.createDataFrame([("k", "1"), ("l", "two")], "global_id string, n string")
    assert [(r.global_id, r.old_value, r.new_value) for r in A.snapshot_diff(old, new).collect()] == [("l", "2", "two")]


def test_repeated_keys_do_not_multiply(spark):
    old = spark.createDataFrame([("k", "a")] * 50, "global_id string, v string")
    new = spark.createDataFrame([("k", "b")] * 50, "global_id string, v string")
    assert A.snapshot_diff(old, new).count() == 1


def test_composite_keys_and_map_columns(spark):
    old = spark.createDataFrame([("k", "c1", {"a": "1"}), ("k", "c2", {"a": "1", "b": "2"})], "id string, c string, m map<string,string>")
    new = spark.createDataFrame([("k", "c1", {"a": "2"}), ("k", "c2", {"b": "2", "a": "1"})], "id string, c string, m map<string,string>")
    assert [(r.c, r.field_changed) for r in A.snapshot_diff(old, new, ["id", "c"]).collect()] == [("c1", "m")]


def test_log_counts_and_appends(spark, tmp_path):
    path = str(tmp_path / "audit")
    old = spark.createDataFrame([("k", "a"), ("l", "b")], "global_id string, v string")
    new = spark.createDataFrame([("k", "x"), ("l", "y")], "global_id string, v string")
    assert A.log_changes(old, old, path) == 0
    assert A.log_changes(old.limit(0), new, path) == 0
    assert A.log_changes(old.select("global_id"), new, path) == 0
    assert A.log_changes(old, new, path) == 2
    assert A.log_changes(new, old, path) == 2
    history = read_history(spark, path)
    assert history.count() == 4 and history.select("timestamp").distinct().count() == 2
    assert sum(r.changes for r in A.changes_per_field(history).collect()) == 4


def test_fingerprint_depends_on_rows_not_on_order(spark):
    df = spark.range(100).selectExpr("id", "map('k', id) AS m")
    mark = A.fingerprint(df).first()
    assert A.fingerprint(df.orderBy(F.desc("id")).repartition(7)).first() == mark
    assert A.same_content(df, df.select("m", "id"))
    assert not A.same_content(df, df.where("id <> 5"))
    assert not A.same_content(df, df.unionAll(df).unionAll(df))
    assert not A.same_content(df, df.drop("m"))
    assert A.fingerprint(df.limit(0)).first().row_count == 0


def test_status_of_layers(spark, tmp_path):
    rows = A.layer_status(spark, {"gold": spark.range(3), "silver": str(tmp_path / "none")}).collect()
    assert [(r.layer, r.status, r.row_count, r.overall) for r in rows] == [
        ("gold", "ok", 3, "degraded"),
        ("silver", "missing", 0, "degraded"),
    ]
    assert A.layer_status(spark, {"gold": spark.range(3)}).first().overall == "healthy"


def test_copies_of_a_key_are_compared_as_bags(spark):
    def diff(old, new):
        frames = [spark.createDataFrame([("p", v) for v in side], "global_id string, v int") for side in (old, new)]
        return sorted((r.field_changed, r.old_value, r.new_value) for r in A.snapshot_diff(*frames).collect())

    assert diff([1, 5], [1, 6]) == [("v", "5", "6")]
    assert diff([1], [1, 9]) == [("(copies)", "1", "2")]
    assert diff([1, 1], [1]) == [("(copies)", "2", "1")]
    assert diff([1, 2, 3], [3, 2, 1]) == []
    assert diff([1], [2, 3]) == [("(copies)", "1", "2"), ("v", "1", "2"), ("v", "1", "3")]
    assert diff([1, None], [None, 2]) == [("v", "1", "2")]
    assert diff([], [1]) == []


def test_diff_sorts_no_whole_rows(spark):
    df = spark.range(10).selectExpr("id AS global_id", "CAST(id AS string) AS v")
    plan = A.snapshot_diff(df, df)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan


def test_fingerprint_sees_nulls(spark):
    schema = "a string, b string, l array<string>, s struct<x:string,y:string>, m map<string,string>"
    row = ("x", None, None, ("x", None), {"k": None})
    same = lambda other: A.same_content(spark.createDataFrame([row], schema), spark.createDataFrame([other], schema))
    assert same(row)
    for place, value in ((2, []), (3, (None, "x")), (3, None), (4, {}), (4, None), (4, {"k": ""}), (2, [None])):
        assert not same((*row[:place], value, *row[place + 1 :]))
    assert not same((None, "x", *row[2:]))
    lists = [spark.createDataFrame([(v,)], "l array<string>") for v in (["a", None], [None, "a"], ["a"], [])]
    assert sum(A.same_content(a, b) for a in lists for b in lists) == len(lists)
