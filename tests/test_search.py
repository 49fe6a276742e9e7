from __future__ import annotations

import math
import tracemalloc

import numpy as np
import pytest

from pyspark.sql import functions as F

from probity.operators import search as V
from probity.sources.layers import spread

TEXTS = [
    ("k1", "puentes nuevos sobre el río, caminos para los pueblos altos"),
    ("k2", "escuelas abiertas por la tarde y maestros bien pagados"),
    ("k3", "parques, árboles y aire limpio en cada barrio"),
    ("k4", "trenes puntuales, menos ruido y más pasajeros"),
    ("k5", "  \n "),
    ("k6", None),
]


@pytest.fixture
def texts(spark):
    return spark.createDataFrame(TEXTS, "global_id string, search_context string")


def test_corpus_has_text(texts):
    assert V.corpus(texts).count() == 4


def test_search_finds_the_text_of_the_same_words(texts):
    plans = V.corpus(texts)
    encoder = V.HashedTermEncoder.fit(plans, "search_context")
    vectors = encoder.encode(plans, "search_context")
    assert vectors.columns == ["global_id", "search_context", "embedding"]
    lengths = [math.hypot(*r.embedding) for r in vectors.collect()]
    assert lengths == pytest.approx([1] * 4, abs=1e-6)
    found = V.search(encoder, vectors, "Arboles y AIRE", k=2).collect()
    assert found[0].global_id == "k3" and len(found) == 2
    assert V.search(encoder, vectors, "aire", k=50).count() == 4


def test_any_model_can_encode(spark, texts):
    def load():
        return lambda batch: np.array([[len(t), 1.0, 0.0] for t in batch])

    encoder = V.PandasEncoder(load)
    vectors = encoder.encode(V.corpus(texts), "search_context").collect()
    assert all(math.hypot(*r.embedding) == pytest.approx(1, abs=1e-6) for r in vectors)


def test_zero_vectors_stay(spark):
    df = spark.createDataFrame([([0.0, 0.0],), ([3.0, 4.0],)], "v array<double>")
    assert [r[0] for r in df.select(V.unit_vector("v")).collect()] == [[0.0, 0.0], [0.6, 0.8]]


@pytest.mark.parametrize("key", ["bigint", "string"])
@pytest.mark.parametrize("block", [100, 4])
def test_batch_equals_one_by_one(spark, key, block):
    rng = np.random.default_rng(5)
    stored = rng.integers(-2, 3, size=(300, 4))  # few values, so many scores are equal
    asked = rng.integers(-2, 3, size=(11, 4))
    name = (lambda i: f"id{i}") if key == "string" else int
    corpus = spark.createDataFrame(
        [(name(i), [float(x) for x in v]) for i, v in enumerate(stored)], f"global_id {key}, embedding array<float>"
    ).repartition(6)
    corpus = corpus.unionAll(spark.createDataFrame([(name(999), None)], corpus.schema))
    queries = spark.createDataFrame(
        [(i, [float(x) for x in v]) for i, v in enumerate(asked)], "query_id int, embedding array<float>"
    )
    batch = V.top_k_batch(corpus, queries, k=7, block=block, group=50).collect()
    found = {(r.query_id, r["rank"]): (r.global_id, r.score) for r in batch}
    for q, vector in enumerate(asked):
        scores = [(-float(vector @ v), name(i)) for i, v in enumerate(stored)]
        expected = [(k, -s) for s, k in sorted(scores)[:7]]
        assert [found[q, rank] for rank in range(1, 8)] == expected
        one = V.top_k(corpus, list(vector), k=7).collect()
        assert [(r.global_id, r.score) for r in one] == expected


def test_fewer_rows_than_asked(spark):
    corpus = spark.createDataFrame([(1, [1.0])], "global_id int, embedding array<float>")
    queries = spark.createDataFrame([(7, [2.0])], "query_id int, embedding array<float>")
    assert [tuple(r) for r in V.top_k_batch(corpus, queries).collect()] == [(7, 1, 2.0, 1)]
    assert V.top_k_batch(corpus.limit(0), queries).count() == 0
    assert V.top_k_batch(corpus, queries.limit(0)).count() == 0


@pytest.mark.parametrize("block", [100, 1])
def test_vectors_that_cannot_be_compared_are_left_out(spark, block):
    nan = float("nan")
    rows = [("a", [1.0, 0.0]), ("b", [nan, 1.0]), ("c", None), ("d", [1.0]), ("e", [1.0, None]), (None, [0.5, 0.0]), ("f", [])]
    corpus = spark.createDataFrame(rows, "global_id string, embedding array<float>").repartition(3)
    queries = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [nan, 0.0]), (4, None)], "query_id int, embedding array<float>")
    want = [(1, "a", 1.0, 1), (1, None, 0.5, 2), (2, None, 0.0, 1), (2, "a", 0.0, 2)]
    found = V.top_k_batch(corpus, queries, k=5, block=block, group=2).collect()
    assert sorted(map(tuple, found), key=str) == sorted(want, key=str)
    assert [tuple(r) for r in V.top_k(corpus, [1.0, 0.0], k=5).collect()] == [("a", 1.0), (None, 0.5)]


def test_memory_is_bounded_whatever_meets():
    """Thousands of queries against a whole group of rows, ties included, without a matrix of all their scores."""
    rng = np.random.default_rng(0)
    queries, stored = rng.integers(-2, 3, (3000, 4)).astype(float), rng.integers(-2, 3, (5000, 4)).astype(float)
    keys = rng.permutation(5000)
    tracemalloc.start()
    found, scores = V._best_of(queries, stored, keys, 5)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 64 << 20
    for i in range(0, 3000, 101):
        product = stored @ queries[i]
        want = sorted(range(5000), key=lambda j: (-product[j], keys[j]))[:5]
        got = sorted(zip(-scores[i], found[i]))
        assert got == [(-product[j], keys[j]) for j in want]


def test_fit_encode_splits_each_text_once(spark):
    rows = [(1, "Árbol  y ñandú, 2 niños"), (2, "plain TEXT; text"), (3, ""), (4, " \u00a0\n"), (None, "árbol plain"), (6, None)]
    df = spark.createDataFrame(rows, "k long, text string")
    encoder, found = V.HashedTermEncoder.fit_encode(df, "text", "k", slots=64)
    want = V.HashedTermEncoder.fit(df, "text", slots=64).encode(df, "text").select("k", "embedding")
    assert sorted(map(str, found.collect())) == sorted(map(str, want.collect()))
    assert encoder.width == 64 and "split" not in found._jdf.queryExecution().toString()
    assert sorted(r.k or 0 for r in V.corpus(df, "text").collect()) == [0, 1, 2]


def test_a_row_group_in_many_pieces_is_spread(spark, tmp_path):
    """A file cut into pieces, of which one holds all rows, is work for more than one task."""
    spark.range(40_000).selectExpr("id", "sha2(string(id), 512) text").coalesce(1).write.parquet(str(tmp_path / "t"))
    size = sum(f.stat().st_size for f in (tmp_path / "t").glob("*.parquet"))
    before = {c: spark.conf.get(c) for c in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for c in before:
            spark.conf.set(c, str(size // 10))
        df = spark.read.parquet(str(tmp_path / "t"))
        assert df.rdd.getNumPartitions() >= 8
        held = spread(df).select("id", F.spark_partition_id().alias("p"))
        assert held.select("p").distinct().count() == 8 and held.select("id").distinct().count() == 40_000
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)
