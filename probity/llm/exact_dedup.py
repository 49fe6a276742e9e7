"""Exact duplicates by recipes of content-defined chunks.

A text is cut at line ends, so equal passages give equal chunks wherever they stand. Chunks
are deduplicated to identifiers, the identifiers are verified against each other, and texts
are compared by their ordered identifier lists: a long text is read once and only its recipe
is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from probity.sources.layers import stage

from .common import lower_ascii, whole

#: A chunk ends at the first line end from its ``LEAST``-th character on, or after ``MOST``.
LEAST, MOST = 512, 4096


def chunks(text: Column, least: int = LEAST, most: int = MOST) -> Column:
    """The text in pieces that end where its content says, none longer than ``most``."""
    rule = rf"(?s).{{{least},{most}}}?(?:\n|\z)|.{{1,{most}}}"
    return F.regexp_extract_all(text, F.lit(rule), F.lit(0))


def recipes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, digest of the normalised text, and its chunks as (hash, bytes, digest)."""
    return docs.select(
        F.col(id_col).alias("id"), lower_ascii(whole(F.col(text_col))).alias("norm")
    ).select(
        "id",
        F.sha2("norm", 256).alias("text_sha256"),
        F.transform(
            chunks(F.col("norm")),
            lambda c: F.struct(
                F.xxhash64(c).alias("hash"),
                F.octet_length(c).alias("bytes"),
                F.unhex(F.sha2(c, 256)).alias("digest"),
            ),
        ).alias("recipe"),
    )


def verified(table: DataFrame) -> DataFrame:
    """Adds ``ids``, the list of verified chunk identifiers.

    (hash, bytes) names a chunk as long as all chunks of that name have one digest. Texts
    that hold a chunk whose name is shared by different chunks carry the digests instead.
    """
    pieces = table.select("text_sha256", F.inline("recipe"))
    dictionary = pieces.groupBy("hash", "bytes").agg(
        F.min("digest").alias("least"), F.max("digest").alias("most")
    )
    # written first: it is next to nothing, so the pieces need not be shuffled to meet it
    shared = stage(dictionary.where("least <> most").select("hash", "bytes"), "shared-names")
    touched = pieces.join(shared, ["hash", "bytes"]).select("text_sha256").distinct()
    return (
        table.join(touched.withColumn("clash", F.lit(True)), "text_sha256", "left")
        .withColumn(
            "ids",
            F.transform(
                "recipe",
                lambda c: F.struct(c["hash"], c["bytes"], F.when(F.col("clash"), c["digest"]).alias("digest")),
            ),
        )
        .select("id", "text_sha256", "ids")
    )


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: its id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Texts are equal when identical after lower-casing A-Z; null is the empty text, and all
    empty texts are one group. The row with the largest id stays; rows that repeat that id
    with the same text are all marked as kept. A group whose ids are all null keeps null.
    An empty table gives an empty result; other columns are ignored.
    """
    table = verified(stage(recipes(docs, id_col, text_col), "recipes"))
    groups = table.groupBy("ids").agg(F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    return table.join(groups, "ids").select(
        F.col("id").alias(id_col),
        "keep_id",
        "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
    )
