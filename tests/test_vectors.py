from __future__ import annotations

import numpy as np
import pytest

from probity.operators import search as V
from probity.operators import vectors as W

SCHEMA = "global_id string, search_context string"


@pytest.fixture
def counting(spark):
    """An encoder, and how many texts it was given."""
    seen = spark.sparkContext.accumulator(0)

    def load():
        def encode(texts):
            seen.add(len(texts))
            return np.array([[len(t), t.count("a"), 1.0] for t in texts])

        return encode

    return V.PandasEncoder(load), seen


def held(df):
    return sorted(((r.global_id, r.text_hash, tuple(r.embedding)) for r in df.collect()), key=str)


def test_only_what_is_new_is_encoded(spark, tmp_path, counting):
    encoder, seen = counting
    path = str(tmp_path / "layer")
    old = [("a", "alpha"), ("b", "beta"), ("c", "gamma"), ("d", "alpha"), ("e", None), ("f", "  ")]
    run = W.refresh_vectors(spark.createDataFrame(old, SCHEMA), path, encoder, "v1")
    assert (run.rows, run.encoded, run.gone, seen.value) == (4, 3, 0, 3)

    # b changed, c gone, g new with a known text, h and i new with one text, a as it was
    new = [("a", "alpha"), ("b", "beta 2"), ("d", "alpha"), ("g", "gamma"), ("h", "delta"), ("i", "delta"), (None, "beta 2")]
    df = spark.createDataFrame(new, SCHEMA)
    run = W.refresh_vectors(df, path, encoder, "v1")
    assert (run.rows, run.encoded, run.gone, seen.value) == (7, 2, 1, 5)
    whole = W.refresh_vectors(df, str(tmp_path / "other"), encoder, "v1")
    assert held(run.vectors) == held(whole.vectors)

    assert W.refresh_vectors(df, path, encoder, "v1").encoded == 0
    assert W.refresh_vectors(df, path, encoder, "v2").encoded == 4


def test_no_texts_at_all(spark, tmp_path, counting):
    path = str(tmp_path / "layer")
    none = spark.createDataFrame([], SCHEMA)
    assert W.refresh_vectors(none, path, counting[0], "v").rows == 0
    some = spark.createDataFrame([("a", "x"), ("a", "x")], SCHEMA)
    assert W.refresh_vectors(some, path, counting[0], "v").rows == 2
    assert W.refresh_vectors(none, path, counting[0], "v").gone == 2
    assert W.read_vectors(spark, path).columns == ["global_id", "text_hash", "embedding"]


def test_a_run_that_breaks_off_changes_nothing(spark, tmp_path, counting):
    path = str(tmp_path / "layer")
    some = spark.createDataFrame([("a", "x")], SCHEMA)
    W.refresh_vectors(some, path, counting[0], "v")

    def load():
        raise RuntimeError("no model")

    more = spark.createDataFrame([("b", "y")], SCHEMA)
    with pytest.raises(Exception, match="no model"):
        W.refresh_vectors(more, path, V.PandasEncoder(load), "v")
    assert [r.global_id for r in W.read_vectors(spark, path).collect()] == ["a"]
    assert [p.name for p in tmp_path.iterdir()] == ["layer"]


def test_the_default_encoder_and_a_search_over_the_layer(spark, tmp_path):
    rows = [("k1", "puentes y caminos"), ("k2", "escuelas y maestros"), ("k3", "árboles y aire limpio")]
    df = spark.createDataFrame(rows, SCHEMA)
    encoder = V.HashedTermEncoder.fit(df, "search_context")
    run = W.refresh_vectors(df, str(tmp_path / "layer"), encoder, "terms-1")
    assert V.search(encoder, run.vectors, "aire", k=1).first().global_id == "k3"
