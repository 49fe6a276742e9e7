"""Range manifests next to whole diffs, and the audit played back."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from probity.operators import audit as A
from probity.operators import manifests as M
from probity.operators import replay as R
from probity.sources.layers import read_history

SCHEMA = "global_id {}, a string, b double, m map<string,int>"


def version(spark, rows, kind="long"):
    return spark.createDataFrame(rows, SCHEMA.format(kind))


def rows_of(n, kind="long", **changed):
    name = (lambda i: i) if kind == "long" else (lambda i: f"k{i:04}")
    return [(name(i), changed.get(f"x{i}", f"v{i}"), i / 7, {"z": i, "y": 1}) for i in range(n)]


def same(one, other):
    columns = ["global_id", "field_changed", "old_value", "new_value"]
    return sorted(map(tuple, one.select(columns).collect()), key=str) == sorted(map(tuple, other.select(columns).collect()), key=str)


@pytest.mark.parametrize("kind", ["long", "string"])
def test_a_diff_opens_only_the_ranges_that_differ(spark, tmp_path, kind):
    old = version(spark, rows_of(900, kind) + [(None, "n", 0.0, None)], kind)
    new = version(spark, rows_of(900, kind, x3="w", x4=None, x450="w")[:-1] + [(None, "other", 0.0, None)], kind)
    one = M.write_ranged(old, str(tmp_path / "old"), ranges=20)
    two = M.write_ranged(new, str(tmp_path / "new"), like=one)
    assert len(one.bounds) >= 15 and M.read_ranged(spark, one.path) == one
    changed = M.changed_ranges(spark, one, two)
    assert -1 in changed and 3 <= len(changed) <= 4
    assert same(M.ranged_diff(spark, one, two), A.snapshot_diff(old, new))
    read = one.rows(spark, changed).inputFiles()
    assert 0 < len(two.rows(spark, changed)._jdf.queryExecution().executedPlan().toString()) and read
    opened = one.rows(spark, changed).select(F.input_file_name()).distinct().count()
    assert opened <= len(changed) * 4 < one.rows(spark).select(F.input_file_name()).distinct().count()


def test_equal_versions_and_other_columns_and_nothing(spark, tmp_path):
    old = version(spark, rows_of(50))
    one = M.write_ranged(old, str(tmp_path / "a"), ranges=4)
    again = M.write_ranged(old.repartition(7), str(tmp_path / "b"), like=one)
    assert M.changed_ranges(spark, one, again) == [] and M.ranged_diff(spark, one, again).count() == 0
    wider = M.write_ranged(old.withColumn("c", F.lit(1)).withColumn("a", F.lit("q")), str(tmp_path / "c"), like=one)
    assert M.changed_ranges(spark, one, wider) is None
    assert M.ranged_diff(spark, one, wider).count() == 50
    none = M.write_ranged(old.limit(0), str(tmp_path / "d"))
    assert none.bounds == [] and none.rows(spark).count() == 0
    assert M.ranged_diff(spark, one, M.write_ranged(old.limit(0), str(tmp_path / "e"), like=one)).count() == 0


def test_one_range_may_hold_a_third(spark, tmp_path):
    old = version(spark, [(5, f"v{i}", 0.0, None) for i in range(300)] + rows_of(600))
    new = version(spark, [(5, f"v{i}", 0.0, None) for i in range(1, 301)] + rows_of(600, x7="w"))
    one = M.write_ranged(old, str(tmp_path / "old"), ranges=10)
    two = M.write_ranged(new, str(tmp_path / "new"), like=one)
    assert same(M.ranged_diff(spark, one, two), A.snapshot_diff(old, new))


def test_versions_logged_one_after_the_other_are_played_back(spark, tmp_path):
    path, audit = str(tmp_path / "layer"), str(tmp_path / "audit")
    states = [rows_of(30), rows_of(30, x1="p", x2=None), rows_of(30, x1="q"), rows_of(29, x1="q", x5="r")]
    frames = [version(spark, s).drop("m") for s in states]
    days = [f"2024-01-0{i} 00:00:00" for i in range(1, 5)]
    logged = [M.log_ranged_version(df, path, audit, at=F.lit(d).cast("timestamp")) for df, d in zip(frames, days)]
    assert logged == [0, 2, 2, 1]
    history, now = read_history(spark, audit), M.read_ranged(spark, path).rows(spark)
    for i, day in enumerate(days):
        got = {tuple(r) for r in R.state_at(now, history, day).collect()}
        assert got == {tuple(r) for r in frames[i].collect() if r.global_id < 29}
    assert {tuple(r) for r in R.state_at(now, history, days[0], fields=["b"]).collect()} == {tuple(r) for r in now.collect()}
    spans = [(r.value, str(r.since)[:10], str(r.until)[:10]) for r in R.periods(history, now, "a").where("global_id = 1").collect()]
    assert sorted(spans) == [("p", "2024-01-02", "2024-01-03"), ("q", "2024-01-03", "None"), ("v1", "None", "2024-01-02")]


def test_values_come_back_in_their_types(spark):
    old = spark.createDataFrame([(1, 1.1, True, None), (2, float("nan"), None, "x")], "global_id int, d double, f boolean, t string")
    new = spark.createDataFrame([(1, 2.5e300, None, ""), (2, 0.1, False, None)], old.schema)
    history = A.snapshot_diff(old, new)
    assert sorted(map(str, R.state_at(new, history, "1999-01-01").collect())) == sorted(map(str, old.collect()))
    with pytest.raises(ValueError, match="l"):
        R.state_at(new.withColumn("l", F.array()), history, "1999-01-01")
