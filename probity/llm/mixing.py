"""Mixes sources to target weights by hash thresholds, without sorting rows.

Sizes are summed by source and hash bucket. Per source the buckets below a budget are taken
whole, and only the bucket at the budget's edge is split further, level by level. The choice
is a threshold on a hash of the id, so a run can be repeated, and a smaller budget takes a
subset of what a larger one takes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from probity.sources.layers import stage

from .common import BLANK_WORD, lookup, whole

#: Each level splits a bucket into 4096; four levels use 48 bits of the hash.
LEVEL_DIGITS, LEVELS = 3, 4


def word_count(text: Column) -> Column:
    return F.regexp_count(whole(text), F.lit(BLANK_WORD)).cast("long")


def bucket_hash(key: Column) -> Column:
    """Twelve hex digits that order the rows of a source at random."""
    return F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("null"))), 1, LEVEL_DIGITS * LEVELS)


def targets(sizes: DataFrame, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """Target size per source: by weight, at most ``most`` times its size, the excess reshared.

    ``sizes`` has one row per source (source, source_size). Sources in code-point order, null
    last, take the weights in turn. With the sources sorted by size over weight, the capped
    ones come first; the others share by weight what these leave. This runs on the summed
    table of sources, so its windows hold one row per source.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.array(*(F.lit(float(w)) for w in weights))
    ranked = sizes.withColumn("weight", F.element_at(turn, (F.row_number().over(order) - 1) % len(weights) + 1))
    everything = Window.partitionBy(F.lit(0))
    filling = Window.partitionBy(F.lit(0)).orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    level = (
        ranked.withColumn("cap", most * F.col("source_size"))
        .withColumn("budget", share * F.sum("source_size").over(everything))
        .withColumn("left", F.col("budget") - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        .withColumn(
            "open_weight", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
        )
        .withColumn("rate", F.col("left") / F.col("open_weight"))
        .withColumn("open", F.col("rate") * F.col("weight") < F.col("cap"))
    )
    first_open = F.min(F.when(F.col("open"), F.struct(F.col("cap") / F.col("weight"), F.col("rate")))).over(everything)
    rate = first_open["rate"]
    return level.withColumn("target", F.least("cap", F.coalesce(rate * F.col("weight"), F.col("cap")))).select(
        "source", "source_size", "target"
    )


def thresholds(sized: DataFrame, budgets: DataFrame) -> DataFrame:
    """Per source the hash below which rows are taken: ``edge``, exclusive, null for none.

    ``sized`` has (source, hash, size), ``budgets`` (source, budget). Every level sums the
    buckets of the edge bucket found before; a row of that sum stands for a bucket, never for
    a document. The last edge bucket is taken if that comes closer to the budget.
    """
    found = budgets.select("source", F.col("budget").cast("double").alias("left"), F.lit("").alias("prefix"))
    for depth in range(1, LEVELS + 1):
        digits = depth * LEVEL_DIGITS
        inside = sized if depth == 1 else sized.join(
            found.select("source", "prefix").withColumnRenamed("source", "edge_source"),
            F.col("source").eqNullSafe(F.col("edge_source"))
            & (F.substring("hash", 1, digits - LEVEL_DIGITS) == F.col("prefix")),
        )
        histogram = inside.groupBy("source", F.substring("hash", 1, digits).alias("bucket")).agg(
            F.sum("size").cast("double").alias("words")
        )
        run = Window.partitionBy("source").orderBy("bucket")
        edge = (
            histogram.withColumn("through", F.sum("words").over(run))
            .join(found.select(F.col("source").alias("its"), "left"), F.col("source").eqNullSafe(F.col("its")))
            .where(F.col("through") > F.col("left"))
            .groupBy("source")
            .agg(F.min(F.struct("bucket", "words", "through", "left")).alias("e"))
        )
        found = stage(
            edge.select(
                "source",
                (F.col("e.left") - (F.col("e.through") - F.col("e.words"))).alias("left"),
                F.col("e.bucket").alias("prefix"),
                F.col("e.words").alias("words"),
            ),
            "edges",
        )
    closer = F.col("words") - F.col("left") < F.col("left")
    return found.select("source", F.when(closer, F.concat("prefix", F.lit("~"))).otherwise(F.col("prefix")).alias("edge"))


def mix_plan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[float, ...] = (3, 1, 2),
    share: float = 1.5,
    most: int = 2,
) -> DataFrame:
    """Per source: ``source_size``, ``target``, how often it is taken whole (``times``), and
    the hash below which rows are taken once more (``edge``)."""
    sized = stage(
        docs.select(
            F.col(source_col).alias("source"),
            word_count(F.col(text_col)).alias("size"),
            bucket_hash(F.col(id_col)).alias("hash"),
        ),
        "sizes",
    )
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    whole_times = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    budgets = (
        stage(targets(sizes, weights, share, most), "targets")
        .withColumn("times", whole_times)
        .withColumn("budget", F.col("target") - F.col("times") * F.col("source_size"))
    )
    edges = thresholds(sized, budgets).withColumnRenamed("source", "its")
    return stage(
        budgets.join(edges, F.col("source").eqNullSafe(F.col("its")), "left").drop("its", "budget"), "mix-plan"
    )


def with_copies(rows: DataFrame, plan: DataFrame, id_col: str, source_col: str) -> DataFrame:
    """Adds a struct ``_mix`` of what the plan says of a row's source, and ``_copies``.

    The plan has a row per source; it is counted, and sent to all tasks only if small.
    """
    plan = plan.select(F.struct(*plan.columns).alias("_mix"))
    plan = lookup(plan, plan.count(), 100)
    once_more = F.coalesce((bucket_hash(F.col(id_col)) < F.col("_mix.edge")).cast("int"), F.lit(0))
    return rows.join(plan, F.col(source_col).eqNullSafe(F.col("_mix.source"))).withColumn(
        "_copies", (F.col("_mix.times") + once_more).cast("int")
    )


def mix(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options
) -> DataFrame:
    """Per row: id, ``size``, ``source_size``, ``target``, ``taken``, ``copies``.

    A source above its target is thinned by hash; one below it is taken whole as often as
    the target holds it, and the rest again by hash. Null text has size 0; rows of size 0
    follow the threshold of their source but take nothing. Null is a source of its own, the
    last one. Rows that repeat an id are taken together. A source of size 0 has target 0 and
    is not taken. An empty table gives an empty result; other columns are ignored.
    """
    plan = mix_plan(docs, id_col, text_col, source_col, **options)
    rows = docs.select(
        F.col(id_col).alias("_id"), F.col(source_col).alias("_source"), word_count(F.col(text_col)).alias("size")
    )
    return with_copies(rows, plan, "_id", "_source").select(
        F.col("_id").alias(id_col),
        "size",
        "_mix.source_size",
        "_mix.target",
        (F.col("_copies") * F.col("size")).cast("long").alias("taken"),
        F.col("_copies").alias("copies"),
    )


def mixed(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options
) -> DataFrame:
    """The documents as the mix takes them: dropped, kept, or repeated; columns unchanged."""
    plan = mix_plan(docs, id_col, text_col, source_col, **options)
    rows = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("_id"), F.col(source_col).alias("_source"))
    return (
        with_copies(rows, plan, "_id", "_source")
        .where("_copies > 0")
        .withColumn("_turn", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
        .select("row.*")
    )
