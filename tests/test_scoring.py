from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from probity import functions as P
from probity.functions import scoring as S


def robust(spark, value, median, mad):
    lit = lambda x: F.lit(x).cast("double")
    return spark.range(1).select(P.robust_score(lit(value), lit(median), lit(mad))).first()[0]


def test_robust_score_at_its_edges(spark):
    assert robust(spark, None, 1, 1) == 50
    assert robust(spark, 2, 1, 0) == 0
    assert robust(spark, 1, 1, 0) == 100
    assert robust(spark, 0, 1, 1) == 100
    assert robust(spark, 1 + 3 * 1.4826, 1, 1) == pytest.approx(0)
    assert robust(spark, 1 + 9 * 1.4826, 1, 1) == 0
    assert robust(spark, 1 + 1.5 * 1.4826, 1, 1) == pytest.approx(50)


def test_ratio_needs_income_or_experience(spark):
    rows = spark.createDataFrame(
        [(10.0, 0.0, 0), (10.0, 4.0, 0), (10.0, 0.0, 1), (10.0, -1.0, 0), (10.0, None, 0)],
        "a double, i double, e bigint",
    )
    assert [r[0] for r in rows.select(P.wealth_ratio("a", "i", "e")).collect()] == [None, 2.0, 10.0, None, None]


def test_step_and_volatility_scores(values, spark):
    assert values(P.legal_score, [0, 1, 2, None], "bigint") == [100.0, 50.0, 0.0, 0.0]
    rows = spark.createDataFrame([(0, 0), (1, 1), (5, 1), (None, 1)], "r bigint, e bigint")
    assert [r[0] for r in rows.select(P.stability_score("r", "e")).collect()] == [100.0, 50.0, 0.0, 0.0]


def test_index_is_weighted_and_rounded(spark):
    index = spark.range(1).select(P.risk_index(F.lit(33.333), F.lit(50.0), F.lit(66.666)))
    assert index.first()[0] == 46.67


def test_flags_keep_their_order_and_bounds(spark):
    columns = "i double, e bigint, f double, s bigint, st double, score double, ruc string"
    rows = [
        (0.0, 0, 39.99, 2, 49.99, 0.92, "20100047218"),
        (1.0, 0, 40.0, 1, 50.0, 0.95, None),
        (1.0, 0, 100.0, 0, 100.0, 0.9199, "1"),
        (None, None, None, None, None, None, None),
    ]
    flags = P.risk_flags("i", "e", "f", "s", "st", "score", "ruc")
    found = [r[0] for r in spark.createDataFrame(rows, columns).select(flags).collect()]
    assert found == [
        [
            S.FLAG_NO_FINANCIAL_DATA,
            S.FLAG_WEALTH_IMBALANCE,
            S.FLAG_MANY_SENTENCES,
            S.FLAG_PARTY_SWITCHING,
            S.FLAG_SANCTIONED_COMPANY + " (RUC: 20100047218)",
        ],
        [S.FLAG_ONE_SENTENCE, S.FLAG_SANCTIONED_COMPANY],
        [],
        [],
    ]
