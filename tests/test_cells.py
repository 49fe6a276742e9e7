from __future__ import annotations

import numpy as np
import pytest

from probity.operators import cells as C
from probity.operators import search as V
from probity.sources.layers import matches


def frame(spark, vectors, key="bigint", name="global_id"):
    rows = [(i if key == "bigint" else f"id{i}", [float(x) for x in v]) for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, f"{name} {key}, embedding array<float>")


def same(found, other):
    def rows(df):  # sums of products depend in their last bit on how many rows are multiplied at once
        return sorted(((r.query_id, r["rank"], r.global_id, round(r.score, 9)) for r in df.collect()), key=str)

    return rows(found) == rows(other)


def clustered(rng, count, groups=12, width=8):
    middles = rng.normal(size=(groups, width)) * 3
    return middles[rng.integers(0, groups, count)] + rng.normal(size=(count, width)) * 0.05


@pytest.mark.parametrize("key", ["bigint", "string"])
def test_equals_a_full_scan(spark, tmp_path, key):
    rng = np.random.default_rng(1)
    vectors = rng.integers(-2, 3, size=(900, 3))  # many equal scores
    corpus, asked = frame(spark, vectors, key), frame(spark, rng.integers(-2, 3, size=(40, 3)), name="query_id")
    layer = C.write_cells(corpus, str(tmp_path / "v"), cells=16)
    found, _ = C.search_cells(spark, layer, asked, k=9, part_rows=70)
    assert same(found, V.top_k_batch(corpus, asked, k=9))


def test_most_cells_are_skipped_where_vectors_lie_in_groups(spark, tmp_path):
    rng = np.random.default_rng(2)
    vectors = clustered(rng, 3000)
    corpus, asked = frame(spark, vectors), frame(spark, vectors[:50], name="query_id")
    layer = C.write_cells(corpus, str(tmp_path / "v"), cells=24)
    found, visits = C.search_cells(spark, layer, asked, k=5)
    assert same(found, V.top_k_batch(corpus, asked, k=5))
    assert C.share_skipped(layer, 50, visits) > 0.6


def test_one_cell_that_holds_a_third_is_met_in_parts(spark, tmp_path):
    rng = np.random.default_rng(3)
    vectors = np.concatenate([np.ones((1000, 4)) + rng.normal(size=(1000, 4)) * 1e-3, rng.normal(size=(2000, 4)) * 5])
    corpus, asked = frame(spark, vectors), frame(spark, rng.normal(size=(30, 4)), name="query_id")
    layer = C.write_cells(corpus, str(tmp_path / "v"), cells=10)
    assert layer.rows.sum() == 3000
    found, _ = C.search_cells(spark, layer, asked, k=4, part_rows=100)
    assert same(found, V.top_k_batch(corpus, asked, k=4))


def test_hard_vectors(spark, tmp_path):
    nan = float("nan")
    schema = "global_id string, embedding array<float>"
    rows = [("a", [1.0, 0.0]), ("b", [nan, 1.0]), ("c", None), ("d", [1.0]), (None, [0.5, 0.0]), ("z", [0.0, 0.0]), ("a", [1.0, 0.0])]
    corpus = spark.createDataFrame(rows, schema)
    asked = spark.createDataFrame(
        [(1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, [nan, 0.0]), (4, None), (5, [1.0, 2.0, 3.0]), (None, [0.0, 1.0])], "query_id int, embedding array<float>"
    )
    layer = C.write_cells(corpus, str(tmp_path / "v"), cells=4)
    found, _ = C.search_cells(spark, layer, asked, k=3)
    want = V.top_k_batch(corpus, asked, k=3)
    assert same(found, want) and found.count() == 9


def test_no_vectors_no_queries_and_fewer_than_k(spark, tmp_path):
    corpus = frame(spark, [[1.0, 2.0], [3.0, 4.0]])
    none = corpus.limit(0)
    asked = frame(spark, [[1.0, 1.0]], name="query_id")
    empty = C.write_cells(none, str(tmp_path / "none"))
    assert C.search_cells(spark, empty, asked)[0].count() == 0
    layer = C.write_cells(corpus, str(tmp_path / "v"))
    assert C.search_cells(spark, layer, asked.limit(0))[0].count() == 0
    assert [r.global_id for r in C.search_cells(spark, layer, asked, k=5)[0].orderBy("rank").collect()] == [1, 0]


def test_a_layer_is_replaced_and_only_visited_cells_are_opened(spark, tmp_path):
    rng = np.random.default_rng(4)
    path = str(tmp_path / "v")
    C.write_cells(frame(spark, rng.normal(size=(10, 3))), path)
    vectors = clustered(rng, 800, groups=6, width=3)
    layer = C.write_cells(frame(spark, vectors), path, cells=6)
    assert layer.rows.sum() == 800 and len(matches(spark, f"{path}/vectors/cell=*")) == len(layer.rows)
    assert not matches(spark, f"{path}.*")
    read = spark.read.parquet(f"{path}/vectors").where("cell IN (0, 1)")
    assert "PartitionFilters: [cell" in read._jdf.queryExecution().executedPlan().toString()


def test_one_long_query_does_not_empty_the_result(spark):
    corpus = frame(spark, [[1.0, 2.0], [3.0, 4.0]])
    asked = spark.createDataFrame([(1, [1.0, 1.0]), (2, [1.0, 1.0, 1.0])], "query_id int, embedding array<float>")
    for block in (100, 1):
        assert {r.query_id for r in V.top_k_batch(corpus, asked, block=block).collect()} == {1}
    assert V.top_k_batch(corpus, asked, width=3).count() == 0
