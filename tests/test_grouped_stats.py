from __future__ import annotations

import math
import random
import statistics

import pytest

from probity.operators import grouped_stats as G
from probity.operators.stats import median_and_mad


def brute(rows):
    groups: dict = {}
    for key, x in rows:
        if x is not None and not math.isnan(x):
            groups.setdefault(key, []).append(x)
    out = {}
    for key, xs in groups.items():
        xs.sort()
        a, b = xs[(len(xs) - 1) // 2], xs[len(xs) // 2]
        m = a if a == b else (a + b) / 2
        away = sorted(d for d in (abs(x - m) for x in xs) if not math.isnan(d))
        c = [away[(len(away) - 1) // 2], away[len(away) // 2]] if away else None
        out[key] = (len(xs), m, None if c is None else c[0] if c[0] == c[1] else sum(c) / 2)
    return out


def found(spark, rows, **options):
    df = spark.createDataFrame(rows, "party string, x double")
    return {r.party: (r.n, r.median, r.mad) for r in G.grouped_median_and_mad(df, ["party"], "x", **options).collect()}


@pytest.mark.parametrize("few_rows", [1, 20, 10_000])
def test_one_hot_group_and_many_tiny_ones(spark, few_rows):
    rng = random.Random(6)
    inf = math.inf
    rows = [("hot", rng.choice([rng.gauss(0, 1), rng.lognormvariate(0, 40), 0.0, -5.5])) for _ in range(3000)]
    rows += [(f"t{rng.randrange(700)}", float(rng.randrange(-9, 9))) for _ in range(3000)]
    rows += [("same", 7.25)] * 500 + [("two", 1.0), ("two", 2.0)] + [(None, 3.0), (None, 4.0), (None, 9.0)]
    rows += [("none", None), ("nan", math.nan), ("ends", inf), ("ends", inf), ("ends", -inf), ("far", -1.7e308), ("far", 1.7e308)]
    rows += [("wide", s * 1.7e308 * rng.random()) for s in (-1, 1) for _ in range(100)]
    rng.shuffle(rows)
    assert found(spark, rows, few_rows=few_rows) == brute(rows)


def test_equals_the_median_of_a_whole_table(spark):
    rng = random.Random(7)
    rows = [("a", rng.expovariate(0.1)) for _ in range(501)]
    df = spark.createDataFrame(rows, "party string, x double")
    assert found(spark, rows, few_rows=50)["a"][1:] == median_and_mad(df, "x")


def test_several_keys_and_nothing(spark):
    df = spark.createDataFrame([(1, "a", 2.0), (1, None, 4.0), (1, None, 6.0)], "k int, l string, x double")
    got = sorted((tuple(r) for r in G.grouped_medians(df, ["k", "l"], "x").collect()), key=str)
    assert got == [(1, "a", 1, 2.0), (1, None, 2, 5.0)]
    assert G.grouped_median_and_mad(df.limit(0), ["k"], "x").count() == 0


def test_rows_of_small_groups_are_written_once(spark, monkeypatch):
    """Median and spread of a small group come from one list: only large groups are read again for the spread."""
    rows = [(f"t{i % 50}", float(i)) for i in range(500)] + [("hot", float(i * i)) for i in range(100)]
    seen, real = [], G.stage
    monkeypatch.setattr(G, "stage", lambda df, name: seen.append((name, out := real(df, name), out.count())) or out)
    assert found(spark, rows, few_rows=20) == brute(rows)
    assert [n for name, _, n in seen if name == "grouped-values"] == [600, 100]
