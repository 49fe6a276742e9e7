from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from probity.operators import cells as C
from probity.operators import search as V
from probity.operators import vectors as W
from probity.sources.layers import spread, work_path

from .registered import Tables, query

# Query vectors: the mean vector of each label, and of all rows.
CENTROIDS = """
    SELECT label, list(m ORDER BY i) AS q FROM (
        SELECT label, i, avg(CAST(embedding[i] AS DOUBLE)) AS m
        FROM embeddings, (SELECT unnest(generate_series(1, 64)) AS i) g GROUP BY label, i) c GROUP BY label"""


def centroids(t: Tables) -> DataFrame:
    parts = t.embeddings.select("label", F.posexplode("embedding").alias("i", "x"))
    means = parts.groupBy("label", "i").agg(F.avg(F.col("x").cast("double")).alias("m"))
    # 64 numbers per label, whatever the number of rows
    ordered = F.sort_array(F.collect_list(F.struct("i", "m")))
    return means.groupBy("label").agg(F.transform(ordered, lambda p: p["m"]).alias("embedding"))


def _rounded(score: str = "score"):
    return F.round(F.col(score), 6).alias("score")


@query(
    f"""SELECT vec_id, round(score, 6) AS score FROM (
        SELECT vec_id, list_inner_product(CAST(embedding AS DOUBLE[]), q) AS score
        FROM embeddings, (SELECT list(m ORDER BY i) AS q FROM (
            SELECT i, avg(CAST(embedding[i] AS DOUBLE)) AS m
            FROM embeddings, (SELECT unnest(generate_series(1, 64)) AS i) g GROUP BY i) c) x) s
    ORDER BY s.score DESC, vec_id LIMIT 5"""
)
def vector_top_k(t: Tables) -> DataFrame:
    mean = t.embeddings.agg(
        F.array(*[F.avg(F.get("embedding", F.lit(i)).cast("double")) for i in range(64)]).alias("q")
    ).first()["q"]
    return V.top_k(t.embeddings, mean, key="vec_id").select("vec_id", _rounded())


BATCH_SQL = f"""SELECT label, vec_id, round(score, 6) AS score, rank FROM (
        SELECT c.label, vec_id, list_inner_product(CAST(embedding AS DOUBLE[]), q) AS score,
            row_number() OVER (PARTITION BY c.label
                ORDER BY list_inner_product(CAST(embedding AS DOUBLE[]), q) DESC, vec_id) AS rank
        FROM embeddings, ({CENTROIDS}) c) s WHERE rank <= 5"""


@query(BATCH_SQL)
def vector_top_k_batch(t: Tables) -> DataFrame:
    found = V.top_k_batch(t.embeddings, centroids(t), key="vec_id", query_key="label")
    return found.select("label", "vec_id", _rounded(), "rank")


@query(BATCH_SQL)
def vector_top_k_grid(t: Tables) -> DataFrame:
    """The same with more queries than one block holds."""
    found = V.top_k_batch(t.embeddings, centroids(t), key="vec_id", query_key="label", block=3, group=500)
    return found.select("label", "vec_id", _rounded(), "rank")


DIRTY_SQL = BATCH_SQL.replace("FROM embeddings, (", "FROM (SELECT * FROM embeddings WHERE vec_id % 11 > 2) e, (", 1)


@query(f"SELECT label, vec_id, score, rank, way FROM ({DIRTY_SQL}) d, (VALUES ('block'), ('grid')) w(way)")
def vector_top_k_dirty(t: Tables) -> DataFrame:
    """Vectors that are null, too short, or hold a NaN are left out, with few queries and with many."""
    number = F.col("vec_id") % 11
    broken = (
        F.when(number == 1, F.transform("embedding", lambda x: x * float("nan")))
        .when(number == 2, F.slice("embedding", 1, 63))
        .when(number > 2, F.col("embedding"))
    )
    rows = t.embeddings.withColumn("embedding", broken.cast("array<float>"))
    asked = centroids(t)
    ways = {"block": 100, "grid": 3}
    found = [
        V.top_k_batch(rows, asked, key="vec_id", query_key="label", block=block, group=500)
        .select("label", "vec_id", _rounded(), "rank", F.lit(way).alias("way"))
        for way, block in ways.items()
    ]
    return found[0].unionAll(found[1])


@query(
    """SELECT vec_id, round(sqrt(list_inner_product(e, e)), 6) AS length, round(e[1] / sqrt(list_inner_product(e, e)), 6)
        AS first FROM (SELECT vec_id, list_transform(CAST(embedding AS DOUBLE[]), lambda x: x * (label + 1)) AS e
        FROM embeddings) s"""
)
def unit_vectors(t: Tables) -> DataFrame:
    scaled = F.transform("embedding", lambda x: x.cast("double") * (F.col("label") + 1))
    rows = t.embeddings.select("vec_id", scaled.alias("e"))
    return rows.select(
        "vec_id",
        F.round(F.sqrt(V.inner_product(F.col("e"), F.col("e"))), 6).alias("length"),
        F.round(F.get(V.unit_vector("e"), F.lit(0)), 6).alias("first"),
    )


@query(
    """SELECT doc_id FROM documents WHERE text IS NOT NULL AND lang <> 'de'
    AND length(regexp_replace(text, '[\\s\\x{A0}]+', '', 'g')) > 0"""
)
def search_corpus(t: Tables) -> DataFrame:
    text = F.when(F.col("lang") == "de", F.lit(" \n ")).otherwise(F.col("text"))
    return V.corpus(t.documents.withColumn("search_context", text)).select("doc_id")


@query()
def text_search(t: Tables) -> DataFrame:
    """Documents closest to the text of a benchmark item."""
    plans = V.corpus(spread(t.documents).withColumnRenamed("text", "search_context"))
    encoder, vectors = V.HashedTermEncoder.fit_encode(plans, "search_context", "doc_id")
    asked = t.benchmark.agg(F.min("text")).first()[0]
    return V.search(encoder, vectors, asked, key="doc_id").select("doc_id", _rounded())


@query()
def text_search_batch(t: Tables) -> DataFrame:
    """Documents closest to each benchmark item."""
    plans = V.corpus(spread(t.documents).withColumnRenamed("text", "search_context"))
    encoder, vectors = V.HashedTermEncoder.fit_encode(plans, "search_context", "doc_id")
    asked = encoder.encode(t.benchmark, "text").select("item_id", "embedding")
    found = V.top_k_batch(vectors, asked, key="doc_id", query_key="item_id", width=encoder.width)
    return found.select("item_id", "doc_id", _rounded(), "rank")


# A stand-in for a text model that the oracle can follow: how often each vowel occurs.
VOWELS = "aeiou"
VOWEL_COUNTS = "[" + ", ".join(f"length(text) - length(replace(text, '{v}', ''))" for v in VOWELS) + "]"


def sql_vowel_vector(table: str, key: str) -> str:
    return f"""SELECT {key}, list_transform(c, lambda x: CAST(CAST(CASE WHEN list_sum(c) > 0
        THEN x / sqrt(list_sum(list_transform(c, lambda y: y * y))) ELSE 0 END AS FLOAT) AS DOUBLE)) AS v
    FROM (SELECT {key}, {VOWEL_COUNTS} AS c FROM {table}) n"""


def _vowel_encoder() -> V.PandasEncoder:
    def load():
        return lambda texts: np.array([[text.count(v) for v in "aeiou"] for text in texts])

    return V.PandasEncoder(load)


@query(
    "SELECT doc_id, " + ", ".join(f"v[{i + 1}] AS {v}" for i, v in enumerate(VOWELS))
    + f" FROM ({sql_vowel_vector('documents', 'doc_id')}) d"
)
def model_vectors(t: Tables) -> DataFrame:
    """Vectors of a model that runs in Python workers."""
    vectors = _vowel_encoder().encode(spread(t.documents.select("doc_id", "text")), "text")
    parts = [F.get("embedding", F.lit(i)).cast("double").alias(v) for i, v in enumerate(VOWELS)]
    return vectors.select("doc_id", *parts)


@query(
    f"""SELECT doc_id, round(list_inner_product(d.v, q.v), 6) AS score
    FROM ({sql_vowel_vector('documents', 'doc_id')}) d,
        ({sql_vowel_vector('(SELECT 0 AS one, min(text) AS text FROM benchmark)', 'one')}) q
    ORDER BY list_inner_product(d.v, q.v) DESC, doc_id LIMIT 5"""
)
def model_search(t: Tables) -> DataFrame:
    encoder = _vowel_encoder()
    vectors = encoder.encode(spread(t.documents.select("doc_id", "text")), "text")
    asked = t.benchmark.agg(F.min("text")).first()[0]
    return V.search(encoder, vectors, asked, key="doc_id").select("doc_id", _rounded())


# ---- stored layers ----

ASKED = "SELECT vec_id AS query_id, embedding FROM {embeddings} WHERE vec_id % 20 = 0"
#: Every twentieth vector against all: scores are rounded before they are ranked, so that ties are ties.
ALL_SQL = """
    SELECT query_id, vec_id, round(score, 6) AS score, rank FROM (
        SELECT q.query_id, e.vec_id, list_inner_product(CAST(e.embedding AS DOUBLE[]), CAST(q.embedding AS DOUBLE[])) AS score,
            row_number() OVER (PARTITION BY q.query_id ORDER BY
                list_inner_product(CAST(e.embedding AS DOUBLE[]), CAST(q.embedding AS DOUBLE[])) DESC, e.vec_id) AS rank
        FROM embeddings e, asked q) s WHERE rank <= 10"""


@query(ALL_SQL, asked=ASKED)
def vector_top_k_all(t: Tables) -> DataFrame:
    """The ten nearest of every twentieth vector among all, by a full scan."""
    found = V.top_k_batch(t.embeddings, t.sql(ASKED), k=10, key="vec_id")
    return found.select("query_id", "vec_id", _rounded(), "rank")


@query(ALL_SQL, asked=ASKED)
def vector_top_k_streamed(t: Tables) -> DataFrame:
    """The same with the queries streaming past the corpus, which is dealt out once."""
    found = V.top_k_batch(t.embeddings, t.sql(ASKED), k=10, key="vec_id", block=0, group=300)
    return found.select("query_id", "vec_id", _rounded(), "rank")


@query(ALL_SQL, asked=ASKED)
def vector_cells(t: Tables) -> DataFrame:
    """The same from a layer in cells, of which most are ruled out by their bounds."""
    layer = C.scratch_cells(t.embeddings, "vec_id")
    found, _ = C.search_cells(t.spark, layer, t.sql(ASKED), k=10, key="vec_id")
    return found.select("query_id", "vec_id", _rounded(), "rank")


# Two states of the corpus: some texts come later, some are changed, some go.
BEFORE = """
    SELECT doc_id, CASE WHEN doc_id % 7 = 2 THEN 'older ' || text ELSE text END AS text FROM {documents}
    WHERE doc_id % 10 <> 3"""
NOW = "SELECT doc_id, text FROM {documents} WHERE doc_id % 11 <> 5"
HAS_TEXT = "text IS NOT NULL AND length(regexp_replace(text, '[\\s\\x{A0}]+', '', 'g')) > 0"


def _refreshed(t: Tables) -> tuple[str, W.VectorRun]:
    path = work_path(t.spark, "vectors")
    W.refresh_vectors(spread(t.sql(BEFORE)), path, _vowel_encoder(), "vowels", key="doc_id", text="text")
    return path, W.refresh_vectors(spread(t.sql(NOW)), path, _vowel_encoder(), "vowels", key="doc_id", text="text")


@query(
    "SELECT doc_id, " + ", ".join(f"v[{i + 1}] AS {v}" for i, v in enumerate(VOWELS))
    + f" FROM ({sql_vowel_vector(f'(SELECT * FROM now WHERE {HAS_TEXT})', 'doc_id')}) d",
    now=NOW,
)
def vectors_refreshed(t: Tables) -> DataFrame:
    """A layer of vectors after a second run holds what a run over the new state alone gives."""
    run = _refreshed(t)[1]
    parts = [F.get("embedding", F.lit(i)).cast("double").alias(v) for i, v in enumerate(VOWELS)]
    return run.vectors.select("doc_id", *parts)


@query(
    f"""SELECT sha256(text) AS text_hash, length(text) AS characters FROM (
        SELECT DISTINCT text FROM now WHERE {HAS_TEXT} AND text NOT IN (
            SELECT text FROM before_now WHERE {HAS_TEXT})) d""",
    before_now=BEFORE,
    now=NOW,
)
def vectors_to_encode(t: Tables) -> DataFrame:
    """The different texts of the new state that the layer of the old one has no vector for."""
    path = work_path(t.spark, "vectors")
    W.refresh_vectors(spread(t.sql(BEFORE)), path, _vowel_encoder(), "vowels", key="doc_id", text="text")
    fresh = W.unencoded(t.sql(NOW), W.read_vectors(t.spark, path), "text")
    return fresh.select("text_hash", F.length("text").cast("bigint").alias("characters"))
