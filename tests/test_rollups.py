from __future__ import annotations

import random

from probity.operators import rollups as R

SCHEMA = "region string, party string, who long"


def rows():
    rng = random.Random(3)
    out = [(rng.choice(["n", "s", None]), rng.choice(["p", "q", None, "r"]), rng.randrange(3000)) for _ in range(20_000)]
    return out + [("n", "p", None)] * 50


def brute(rows):
    out: dict = {}
    for region, party, who in rows:
        for level, key in ((0, (region, party)), (1, (region, None)), (3, (None, None))):
            n, held = out.setdefault((level, key), [0, set()])
            out[level, key][0] = n + 1
            held |= {who} - {None}
    return {k: (n, len(held)) for k, (n, held) in out.items()}


def found(df):
    got = {(r.level, (r.region, r.party)): (r.entities, r.distinct_values) for r in df.collect()}
    assert len(got) == df.count()
    return got


def test_exact_counts_on_all_levels(spark):
    data = rows()
    df = spark.createDataFrame(data, SCHEMA)
    assert found(R.rolled_up(df, ["region", "party"], "who")) == brute(data)
    assert R.rolled_up(df, ["region"]).columns == ["region", "level", "entities"]


def test_sketches_are_close_and_merged_ones_as_close_as_one_pass(spark, tmp_path):
    data = rows()
    df = spark.createDataFrame(data, SCHEMA)
    by = ["region", "party"]
    days = [df.where(f"who % 3 = {i}" + (" OR who IS NULL" if not i else "")) for i in range(3)]
    for i, day in enumerate(days):
        R.sketch_layer(day, by, "who").write.parquet(str(tmp_path / str(i)))
    layer = R.merged([spark.read.parquet(str(tmp_path / str(i))) for i in range(3)], by)
    once = found(R.rolled_up_layer(R.sketch_layer(df, by, "who"), by))
    union = found(R.rolled_up_layer(layer, by))  # of unions another estimate is known than of single sketches
    exact = brute(data)
    assert once.keys() == union.keys() == exact.keys()
    for guess in (once, union):
        for key, (entities, distinct) in guess.items():
            assert entities == exact[key][0] and abs(distinct - exact[key][1]) <= 0.02 * exact[key][1]


def test_of_nothing(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert [tuple(r) for r in R.rolled_up(none, ["region", "party"], "who").collect()] == [(None, None, 3, 0, 0)]
    assert R.rolled_up_layer(R.sketch_layer(none, ["region"], "who"), ["region"]).count() == 0
