"""A stored layer of text vectors that a refresh brings up to date by encoding only what is new.

Vectors are keyed by the content of their text. A refresh compares content hashes: texts that the
layer has keep their vector, whatever row holds them now; new and changed ones are encoded, once
per different text; rows that are gone leave the layer.
"""

from __future__ import annotations

from dataclasses import dataclass
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, functions as F

from probity.sources.layers import delete, path_exists, replace_layer, stage, write_layer

from .search import Encoder, corpus

HASH = "text_hash"


@dataclass(frozen=True)
class VectorRun:
    """The layer, its rows, the texts that had to be encoded, and the rows that left it."""

    vectors: DataFrame
    rows: int
    encoded: int
    gone: int


def read_vectors(spark: SparkSession, path: str) -> DataFrame:
    """Key, ``text_hash`` and vector of every row of the layer."""
    return spark.read.parquet(f"{path.rstrip('/')}/rows")


def encoder_version(spark: SparkSession, path: str) -> str | None:
    """Which encoder has made the layer, None where there is no layer."""
    path = f"{path.rstrip('/')}/encoder"
    return spark.read.parquet(path).first()["version"] if path_exists(spark, f"{path}/_SUCCESS") else None


def unencoded(texts: DataFrame, stored: DataFrame | None, text: str = "search_context") -> DataFrame:
    """``text_hash`` and text of every different text that has no stored vector."""
    fresh = corpus(texts, text).select(F.sha2(text, 256).alias(HASH), text)
    if stored is not None:
        fresh = fresh.join(stored.select(HASH).distinct(), HASH, "left_anti")
    # equal hashes are equal texts, so any of them will do; the least is the same in every run
    return fresh.groupBy(HASH).agg(F.min(text).alias(text))


def refresh_vectors(
    texts: DataFrame,
    path: str,
    encoder: Encoder,
    version: str,
    key: str = "global_id",
    text: str = "search_context",
    embedding: str = "embedding",
) -> VectorRun:
    """Brings the layer at ``path`` to the state of ``texts`` (a key and a text per row).

    ``version`` names the encoder with all that its vectors depend on; a layer of another version
    is encoded anew. Rows whose text is null or blank are not in the layer. Keys may repeat and may
    be null: rows are rows. The new version is written beside the old one and takes its place at
    the end, so a run that breaks off changes nothing and can be repeated.
    """
    spark, path = texts.sparkSession, path.rstrip("/")
    same = encoder_version(spark, path) == version
    stored = read_vectors(spark, path) if same else None
    rows = corpus(texts, text).select(key, F.sha2(text, 256).alias(HASH))
    fresh = stage(unencoded(texts, stored, text), "unencoded")
    made = stage(encoder.encode(fresh, text, embedding).select(HASH, embedding), "encoded")
    known = made
    if stored is not None:
        known = stored.groupBy(HASH).agg(F.first(embedding).alias(embedding)).unionByName(made)
    new = f"{path}.new-{uuid4().hex}"
    try:
        write_layer(rows.join(known, HASH).select(key, HASH, embedding), f"{new}/rows")
        write_layer(spark.createDataFrame([(version,)], "version string").coalesce(1), f"{new}/encoder")
        now = spark.read.parquet(f"{new}/rows")
        gone = 0
        if stored is not None:
            before = stored.groupBy(key).agg(F.count("*").alias("before"))
            after = now.groupBy(key).agg(F.count("*").alias("after"))
            left = before.join(after, before[key].eqNullSafe(after[key]), "left")
            lost = F.greatest(F.col("before") - F.coalesce("after", F.lit(0)), F.lit(0))
            gone = left.agg(F.coalesce(F.sum(lost), F.lit(0))).first()[0]
        count, encoded = now.count(), made.count()
        replace_layer(spark, new, path)
    finally:
        delete(spark, new)
    return VectorRun(read_vectors(spark, path), count, encoded, gone)
