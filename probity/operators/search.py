"""Semantic search: text encoders and exact inner-product top-k."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Protocol

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.feature import IDF, HashingTF, IDFModel, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window, functions as F

from probity import functions as P
from probity._shipping import ship_by_value
from probity.sources.layers import stage

ship_by_value(__name__)

DEFAULT_TOP_K = 5
QUERIES_PER_BLOCK = 2_048
CORPUS_ROWS_PER_GROUP = 20_000
SCORES_AT_ONCE = 1 << 20  # a bound on a task's memory, whatever the number of queries and rows
NO_KEY = "\x01\x00null"  # stands for a null text key inside a task


def corpus(df: DataFrame, text: str = "search_context") -> DataFrame:
    """Rows whose text is more than white space."""
    return df.where(F.col(text).rlike(r"(?U)\S"))


# ---------------------------------------------------------------- encoders


class Encoder(Protocol):
    def encode(self, df: DataFrame, text: str, output: str = "embedding") -> DataFrame:
        """Adds unit-length vectors of a text column."""


class HashedTermEncoder:
    """Term frequencies in hashed slots, weighted by rarity, of length 1; runs in the JVM.

    ``fit`` makes one pass over the corpus; its state is one number per slot.
    """

    def __init__(self, weights: IDFModel, slots: int):
        self._weights, self.width = weights, slots
        self._terms = HashingTF(inputCol="_words", outputCol="_terms", numFeatures=slots)
        self._unit = Normalizer(inputCol="_weighted", outputCol="_unit", p=2.0)

    @classmethod
    def fit(cls, df: DataFrame, text: str, slots: int = 512) -> HashedTermEncoder:
        terms = HashingTF(inputCol="_words", outputCol="_terms", numFeatures=slots)
        counted = terms.transform(df.select(_words(text).alias("_words")))
        return cls(IDF(inputCol="_terms", outputCol="_weighted").fit(counted), slots)

    @classmethod
    def fit_encode(
        cls, df: DataFrame, text: str, key: str, slots: int = 512, output: str = "embedding"
    ) -> tuple[HashedTermEncoder, DataFrame]:
        """The fitted encoder, and ``key, output`` of the rows it learned from; each text is split once."""
        terms = HashingTF(inputCol="_words", outputCol="_terms", numFeatures=slots)
        counted = stage(terms.transform(df.select(key, _words(text).alias("_words"))).drop("_words"), "terms")
        encoder = cls(IDF(inputCol="_terms", outputCol="_weighted").fit(counted), slots)
        return encoder, encoder._weighed(counted, output)

    def encode(self, df: DataFrame, text: str, output: str = "embedding") -> DataFrame:
        return self._weighed(self._terms.transform(df.withColumn("_words", _words(text))), output)

    def _weighed(self, counted: DataFrame, output: str) -> DataFrame:
        unit = self._unit.transform(self._weights.transform(counted))
        return unit.withColumn(output, vector_to_array("_unit", "float32")).drop(
            "_words", "_terms", "_weighted", "_unit"
        )


class PandasEncoder:
    """Any model: ``load`` runs once per task and returns texts -> matrix of vectors."""

    def __init__(self, load: Callable[[], Callable[[list[str]], np.ndarray]]):
        self._load = load

    def encode(self, df: DataFrame, text: str, output: str = "embedding") -> DataFrame:
        load = self._load

        @F.pandas_udf("array<float>")
        def embed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            model = load()
            for texts in batches:
                vectors = np.asarray(model(texts.fillna("").tolist()), dtype=np.float64)
                length = np.linalg.norm(vectors, axis=1, keepdims=True)
                unit = vectors / np.where(length > 0, length, 1)
                yield pd.Series(list(unit.astype(np.float32)))

        return df.withColumn(output, embed(F.col(text)))


def _words(text: str) -> Column:
    # texts of ASCII only, which are cheap to tell, have no accents to fold
    plain = F.length(text) == F.octet_length(text)
    folded = F.lower(F.when(plain, F.col(text)).otherwise(P.fold_accents(F.coalesce(F.col(text), F.lit("")))))
    return F.array_remove(F.split(folded, r"[^\p{L}\p{N}]+"), "")


# ---------------------------------------------------------------- vectors


def inner_product(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, p: total + p)


def unit_vector(vector: str | Column) -> Column:
    """The vector divided by its length; a vector of zeros stays one."""
    vector = F.col(vector) if isinstance(vector, str) else vector
    length = F.sqrt(inner_product(vector, vector))
    return F.when(length > 0, F.transform(vector, lambda x: x / length)).otherwise(vector)


def usable(vector: Column, width: int | None = None) -> Column:
    """Whether a vector can be compared: not null, all parts numbers, and of the width asked for."""
    numbers = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x))
    fits = numbers & (F.size(vector) == width) if width is not None else numbers
    return F.coalesce(fits, F.lit(False))


def top_k(
    vectors: DataFrame,
    query: list[float],
    k: int = DEFAULT_TOP_K,
    key: str = "global_id",
    embedding: str = "embedding",
) -> DataFrame:
    """The k rows of highest inner product with one vector; of equal scores the smaller key.

    Every task multiplies its Arrow batches with the vector and keeps k rows only. Rows
    without a vector, with one of another width, or with a part that is no number, have no
    score and are left out.
    """
    stored = vectors.select(key, embedding).where(usable(F.col(embedding), len(query)))
    asked = pa.table({"_query": [0], embedding: [[float(x) for x in query]]})
    output = f"_query long, `{key}` {stored.schema[key].dataType.simpleString()}, score double"
    found = stored.mapInArrow(_best_per_task(asked, key, "_query", embedding, k), output)
    return found.select(key, "score").orderBy(F.col("score").desc(), F.col(key)).limit(k)


def search(
    encoder: Encoder,
    vectors: DataFrame,
    text: str,
    k: int = DEFAULT_TOP_K,
    key: str = "global_id",
    embedding: str = "embedding",
) -> DataFrame:
    """The k rows closest to a text."""
    asked = vectors.sparkSession.createDataFrame([(text,)], "text string")
    query = encoder.encode(asked, "text", embedding).first()[embedding]
    return top_k(vectors, query, k, key, embedding)


def top_k_batch(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = DEFAULT_TOP_K,
    key: str = "global_id",
    query_key: str = "query_id",
    embedding: str = "embedding",
    block: int = QUERIES_PER_BLOCK,
    group: int = CORPUS_ROWS_PER_GROUP,
    width: int | None = None,
) -> DataFrame:
    """``query_key, key, score, rank`` of the k best rows for each of many query vectors.

    Up to ``block`` queries (counted first) travel to the tasks, which multiply them with
    each Arrow batch of the corpus and keep k rows per query: a row pair never is a row.
    More queries are sent to groups of the corpus, which is dealt out once: a task holds one
    group and lets the queries stream past it. Vectors that are null or hold a part that is no
    number are left out, and so are those of another ``width`` than the corpus has; it is the
    most frequent one there, unless it is named.
    """
    width = corpus_width(vectors, embedding) if width is None else width
    asked = queries.select(query_key, embedding).where(usable(F.col(embedding), width))
    stored = vectors.select(key, embedding).where(usable(F.col(embedding), width))
    types = {f.name: f.dataType.simpleString() for f in (*asked.schema.fields, *stored.schema.fields)}
    output = f"`{query_key}` {types[query_key]}, `{key}` {types[key]}, score double"
    if asked.count() <= block:
        found = stored.mapInArrow(_best_per_task(asked.toArrow(), key, query_key, embedding, k), output)
    else:
        groups = max(1, -(-stored.count() // group))
        place = F.pmod(F.xxhash64(key), F.lit(groups)).cast("int")
        everywhere = F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))
        found = met_in_groups(
            stored.select(key, embedding, place.alias("_cell"), F.lit(0).alias("_part")),
            asked.select(query_key, embedding, everywhere.alias("_cell"), F.lit(0).alias("_part")),
            k, key, query_key, embedding, groups,
        )
    return best_per_query(found, k, key, query_key)


def corpus_width(vectors: DataFrame, embedding: str = "embedding") -> int:
    """The most frequent width of the usable vectors, 0 if there is none; of equal ones the smaller."""
    sizes = vectors.where(usable(F.col(embedding))).groupBy(F.size(embedding).alias("width")).agg(F.count("*").alias("n"))
    found = sizes.orderBy(F.col("n").desc(), "width").first()
    return found["width"] if found else 0


def best_per_query(found: DataFrame, k: int, key: str, query_key: str) -> DataFrame:
    """The k best of what the tasks found, with their ``rank``; of equal scores the smaller key."""
    order = Window.partitionBy(query_key).orderBy(F.col("score").desc(), F.col(key))
    return found.withColumn("rank", F.row_number().over(order).cast("bigint")).where(F.col("rank") <= k)


def met_in_groups(
    stored: DataFrame, asked: DataFrame, k: int, key: str, query_key: str, embedding: str, groups: int
) -> DataFrame:
    """``query_key, key, score``: per query and group of the corpus the k best rows of that group.

    Both sides name their groups by ``_cell`` and ``_part``. Each corpus row moves once, whatever
    the number of queries. Within a task a group's rows come first and are held; the queries
    that follow are multiplied batch by batch, so no list of queries is ever held whole.
    """
    spark = stored.sparkSession
    kinds = {f.name: f.dataType for f in (*asked.schema.fields, *stored.schema.fields)}
    single = all(df.schema[embedding].dataType.simpleString() == "array<float>" for df in (stored, asked))
    vector = F.col(embedding).cast("array<float>" if single else "array<double>")
    none_of = lambda name: F.lit(None).cast(kinds[name])
    rows = stored.select(
        "_cell", "_part", F.lit(0).alias("_kind"), F.col(key).alias("_key"), none_of(query_key).alias("_query"), vector.alias("_v")
    ).unionAll(
        asked.select(
            "_cell", "_part", F.lit(1).alias("_kind"), none_of(key).alias("_key"), F.col(query_key).alias("_query"), vector.alias("_v")
        )
    )
    tasks = max(1, min(groups, 4 * max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))))
    rows = rows.repartition(tasks, "_cell", "_part").sortWithinPartitions("_cell", "_part", "_kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, keys, vectors, held = None, None, [], None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            place = np.stack([table[c].to_numpy() for c in ("_cell", "_part", "_kind")])
            cuts = np.flatnonzero(np.any(place[:, 1:] != place[:, :-1], axis=0)) + 1
            for i, j in zip([0, *cuts], [*cuts, batch.num_rows]):
                part = table.slice(i, j - i)
                group = tuple(place[:2, i])
                if group != here:
                    here, keys, vectors, held = group, [], [], None
                if place[2, i] == 0:
                    keys.append(part["_key"])
                    vectors.append(_matrix(part["_v"]))
                    continue
                if not vectors:
                    continue
                if held is None:
                    chunks = [c for column in keys for c in column.chunks]
                    held = _keys(pa.chunked_array(chunks)), np.concatenate(vectors), chunks[0].type
                found = _best_of(_matrix(part["_v"]), held[1], held[0], k)
                out = _as_table(part, "_query", "_key", held[2], found).rename_columns([query_key, key, "score"])
                yield from out.combine_chunks().to_batches()

    output = f"`{query_key}` {kinds[query_key].simpleString()}, `{key}` {kinds[key].simpleString()}, score double"
    return rows.mapInArrow(run, output)


def _best_per_task(asked: pa.Table, key: str, query_key: str, embedding: str, k: int):
    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = _matrix(asked[embedding])
        found = None
        for batch in batches:
            if batch.num_rows and len(queries):
                rows = pa.Table.from_batches([batch])
                found = _merge(found, _best_of(queries, _matrix(rows[embedding]), _keys(rows[key]), k), k)
        if found is not None:
            yield from _as_table(asked, query_key, key, batch.schema.field(key).type, found).to_batches()

    return best


def _best_of(
    queries: np.ndarray, stored: np.ndarray, keys: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray]:
    """Keys and scores of the k best rows per query, as matrices; ties go to the smaller key."""
    k = min(k, len(stored))
    if not k or not len(queries):
        return np.empty((len(queries), 0), keys.dtype), np.empty((len(queries), 0))
    by_key = keys.argsort(kind="stable")
    ordered, few = stored[by_key].T, max(1, SCORES_AT_ONCE // len(stored))
    parts = [_best_columns(queries[i : i + few] @ ordered, k) for i in range(0, len(queries), few)]
    columns, scores = (np.concatenate(part) for part in zip(*parts))
    return keys[by_key][columns], scores


def _best_columns(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and values of the k largest scores per row; of equal ones the first."""
    last = np.partition(scores, -k, axis=1)[:, -k, None]
    above, level = scores > last, scores == last
    places_left = k - above.sum(axis=1, keepdims=True)
    kept = above | (level & (np.cumsum(level, axis=1, dtype=np.int32) <= places_left))
    columns = np.nonzero(kept)[1].reshape(len(scores), k)
    return columns, np.take_along_axis(scores, columns, axis=1)


def _merge(found, more, k: int):
    if found is None:
        return more
    keys = np.concatenate([found[0], more[0]], axis=1)
    scores = np.concatenate([found[1], more[1]], axis=1)
    order = np.lexsort((keys, -scores))[:, :k]
    return np.take_along_axis(keys, order, axis=1), np.take_along_axis(scores, order, axis=1)


def _as_table(queries: pa.Table, query_key: str, key: str, key_type: pa.DataType, found) -> pa.Table:
    keys, scores = found
    rows = np.repeat(np.arange(scores.shape[0]), scores.shape[1])
    return pa.table(
        {
            query_key: queries[query_key].take(pa.array(rows)),
            key: pa.array([None if v == NO_KEY else v for v in keys.ravel().tolist()], key_type),
            "score": pa.array(scores.ravel(), pa.float64()),
        }
    )


def _keys(column: pa.ChunkedArray) -> np.ndarray:
    """Keys as numbers or texts; a null key sorts first and stays null (see ``_as_table``)."""
    values = column.combine_chunks()
    if not pa.types.is_string(values.type):
        return values.to_numpy(zero_copy_only=False)
    return np.array([NO_KEY if v is None else v for v in values.to_pylist()], dtype=str)


def _matrix(vectors: pa.ChunkedArray) -> np.ndarray:
    lists = vectors.combine_chunks()
    values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(lists), -1) if len(lists) else values.reshape(0, 0)
