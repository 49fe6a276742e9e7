from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from probity.operators import quality as Q
from probity.sources.layers import read_history

SCHEMA = "dni string, nombres string"


def test_each_reason(spark):
    rows = [
        ("12345678", "Ana"),
        ("123", "Ana"),
        ("12345678", ""),
        ("12345678", None),
        (None, None),
        ("00000000", "Ana"),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    reasons = [r.motivo_rechazo for r in Q.classify(df).collect()]
    assert reasons == [None, Q.BAD_ID, Q.BAD_NAME, Q.BAD_NAME, Q.BAD_ID_AND_NAME, None]
    strict = Q.classify(df, Q.silver_reason(reject_zero_id=True)).collect()
    assert strict[-1].motivo_rechazo == Q.BAD_ID


def test_valid_and_rejected_add_up(spark):
    df = spark.createDataFrame([("12345678", "a"), ("x", "b"), (None, "c")], SCHEMA)
    classified = Q.classify(df)
    assert Q.valid_rows(classified).count() + Q.rejected_rows(classified).count() == df.count()
    assert Q.valid_rows(classified).columns == ["dni", "nombres"]
    assert tuple(Q.quality_counts(classified).first()) == (3, 2, 2 / 3)


def test_breaker_trips_above_the_limit_only_and_keeps_the_rejects(spark, tmp_path):
    def people(bad):
        rows = [("12345678", "ok")] * (10 - bad) + [("bad", "x")] * bad
        return spark.createDataFrame(rows, SCHEMA)

    path = str(tmp_path / "rejected")
    valid, report = Q.enforce_quality(people(2), path)
    assert (valid.count(), report.invalid, report.ratio) == (8, 2, 0.2)
    with pytest.raises(Q.DataQualityError):
        Q.enforce_quality(people(3), path)
    assert read_history(spark, path).count() == 5


def test_no_rows_pass_unchanged(spark, tmp_path):
    valid, report = Q.enforce_quality(spark.createDataFrame([], SCHEMA), str(tmp_path / "none"))
    assert valid.count() == 0 and report.ratio == 0


def test_quarantine_takes_rejects_of_other_columns(spark, tmp_path):
    path = str(tmp_path / "rejected")
    Q.enforce_quality(spark.createDataFrame([("bad", "x")], SCHEMA), path, max_error_ratio=1)
    wider = spark.createDataFrame([("bad", "x", 7)], SCHEMA + ", extra int")
    Q.enforce_quality(wider, path, max_error_ratio=1)
    rows = read_history(spark, path).orderBy("extra").collect()
    assert [r.extra for r in rows] == [None, 7]


def test_rules_and_references(spark):
    df = spark.createDataFrame([(1, "a"), (None, "a"), (3, "z"), (4, None)], "id int, party string")
    rules = {"id": F.col("id").isNotNull(), "party": F.col("party") == "a"}
    found = df.select(Q.first_broken_rule(rules).alias("r")).collect()
    assert [r.r for r in found] == [None, "id", "party", "party"]
    known = spark.createDataFrame([("a",), ("a",), (None,)], "p string")
    marked = Q.mark_known(df, "party", known, "p").orderBy("id").collect()
    assert [(r.id, r.is_known) for r in marked] == [(None, True), (1, True), (3, False), (4, False)]


def test_rows_are_computed_once_and_routed_side_by_side(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(value):
        seen.add(1)
        return value

    rows = [("12345678", "a"), ("bad", "b"), (None, None)] * 20
    df = spark.createDataFrame(rows, SCHEMA).withColumn("nombres", counted("nombres"))
    path = str(tmp_path / "layer")
    valid, report = Q.enforce_quality(df, str(tmp_path / "rejected"), max_error_ratio=0.7, path=path)
    assert (report.total, report.invalid) == (60, 40) and seen.value == 60
    assert valid.count() == 20 and valid.columns == df.columns
    assert {p.name for p in (tmp_path / "layer").iterdir() if p.is_dir()} == {"row_is_valid=true", "row_is_valid=false"}
    rejected = read_history(spark, str(tmp_path / "rejected")).collect()
    assert sorted({r.motivo_rechazo for r in rejected}) == sorted({Q.BAD_ID, Q.BAD_ID_AND_NAME}) and len(rejected) == 40


@pytest.mark.parametrize("rows", [[("12345678", "a")], [("bad", "x")], []])
def test_one_kind_only(spark, tmp_path, rows):
    valid, rejected, report = Q.write_routed(spark.createDataFrame(rows, SCHEMA), str(tmp_path / "layer"))
    assert valid.count() + rejected.count() == report.total == len(rows)
    assert valid.columns == ["dni", "nombres"] and rejected.columns == ["dni", "nombres", "motivo_rechazo"]
    assert valid.where("dni = 'bad'").count() == 0 and rejected.count() == report.invalid
