from __future__ import annotations

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from probity.operators import intervals as I

FAR = date(1, 1, 1)
BASE = date(2020, 1, 1)


def brute(events, spans):
    out = []
    for key, day, name in events:
        for k, start, end, label in spans:
            if key is not None and key == k and day and (start or FAR) <= day <= (end or date.max):
                out.append((key, day, name, start, end, label))
    return sorted(out, key=str)


def met(spark, events, spans, **options):
    e = spark.createDataFrame(events, "ruc string, day date, name string")
    s = spark.createDataFrame(spans, "ruc string, desde date, hasta date, label string")
    df = I.in_force(e, s, ["ruc"], "day", "desde", "hasta", **options)
    assert df.columns == ["ruc", "day", "name", "desde", "hasta", "label"]
    return df


@pytest.mark.parametrize("hot_rows", [100_000, 7])
def test_equals_comparing_each_with_each(spark, hot_rows):
    rng = random.Random(1)
    day = lambda spread: BASE + timedelta(days=rng.randrange(-spread, spread))
    events = [(rng.choice(["1", "2", "3", None, "hot", "hot"]), rng.choice([day(400), day(400), None]), f"e{i % 90}") for i in range(300)]
    spans = [("1", None, None, "always"), ("2", BASE, BASE, "a day"), ("2", BASE, BASE - timedelta(1), "never"), (None, None, None, "no key")]
    for i in range(120):
        start, end = rng.choice([None, day(500), day(500)]), rng.choice([None, day(500), day(500)])
        spans.append((rng.choice(["1", "2", "hot", "hot"]), start, end, f"s{i % 50}"))
    spans += [("3", date(1, 1, 1), date(9999, 12, 31), "long")] * 2
    df = met(spark, events, spans, hot_rows=hot_rows)
    assert sorted(map(tuple, df.collect()), key=str) == brute(events, spans)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_pieces_cover_an_interval_once(spark):
    rng = random.Random(2)
    rows = [(a, a + rng.choice([-1, 0, 1, 2, 7, 100, 5000])) for a in (rng.randrange(0, 1 << 20) for _ in range(60))]
    df = spark.createDataFrame([*rows, (0, (1 << I.SIZES - 1) - 1)], "a int, b int")
    for r in df.select("a", "b", I.pieces(F.col("a"), F.col("b")).alias("p")).collect():
        days = sorted(d for p in r.p for d in (p._piece << p._size, (p._piece + 1 << p._size) - 1))
        assert len(r.p) <= 2 * I.SIZES
        if r.b < r.a:
            assert not days
            continue
        assert (days[0], days[-1]) == (r.a, r.b)
        assert all(x + 1 == y for x, y in zip(days[1:-1:2], days[2::2]))


def test_days_of_any_date_are_counted(spark):
    days = [date(1, 1, 1), date(1582, 10, 4), date(9999, 12, 31)]
    events = [("1", d, str(d)) for d in days]
    assert met(spark, events, [("1", None, None, "always")]).count() == 3
    assert {r.name for r in met(spark, events, [("1", date(1600, 1, 1), None, "x")]).collect()} == {"9999-12-31"}


def test_of_nothing_and_clashing_columns(spark):
    some = [("1", BASE, "e")]
    assert met(spark, some, []).count() == 0 and met(spark, [], [("1", None, None, "x")]).count() == 0
    events = spark.createDataFrame(some, "ruc string, day date, label string")
    spans = spark.createDataFrame([("1", None, None, "x")], "ruc string, desde date, hasta date, label string")
    with pytest.raises(ValueError, match="label"):
        I.in_force(events, spans, ["ruc"], "day", "desde", "hasta")


def test_dates_as_text(spark):
    spans = spark.createDataFrame([("a", "2020-01-01", "2020-02-01"), ("b", "junk", None), ("c", "2020-01-03", "n/d")], "k string, s string, e string")
    on = lambda day: {r.k for r in I.in_force_on(spans, day, "s", "e").collect()}
    assert on("2020-01-02") == {"a", "b"} and on("2021-01-01") == {"b", "c"} and on("not a day") == set()


@pytest.mark.parametrize("few", [0, 1, 3, 100])
def test_keys_of_few_intervals_are_compared_directly(spark, few):
    rng = random.Random(4)
    day = lambda: BASE + timedelta(days=rng.randrange(60))
    events = [(rng.choice("aaab" "cd"), day(), f"e{i % 40}") for i in range(150)] + [("none", BASE, "e")]
    spans = [(k, *rng.choice([(day(), day()), (None, day()), (day(), None), (None, None)]), f"s{i}") for k, n in zip("abcd", (1, 2, 4, 9)) for i in range(n)]
    df = met(spark, events, spans * 2, hot_rows=7, few_intervals=few)
    assert sorted(map(tuple, df.collect()), key=str) == brute(events, spans * 2)


def test_few_intervals_do_not_multiply_events(spark):
    df = met(spark, [("1", BASE, "e")], [("1", None, None, "x"), ("1", BASE, BASE, "y")])
    assert df.count() == 2 and "_piece" not in df._jdf.queryExecution().toString()
