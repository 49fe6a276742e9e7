"""One identity for people whose records got different ids: exact and similar names, linked through.

Evidence becomes links between ids, and ids that links connect, however long the chain, are one
identity. A value that many records share gives one link per id, to the least of them; names are
compared once per spelling and never record by record.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from probity import functions as P
from probity.sources.layers import delete, own_work, read_layer, stage, work_path, write_layer

from .fuzzy import similar_pairs

THRESHOLD = 0.92


def connected(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` of every node that a link names; the component is its least node.

    Nodes can be of any type that has an order. Links to itself and links with a null on a side
    connect nothing, but the side that is not null is a node. Each round hangs every node's larger
    neighbours on its least one, then does the same with the smaller ones, which makes each tree a
    star in the end. A round aggregates least nodes, which tasks combine before they shuffle, and
    joins them back to the links; no node's links are ever gathered. Larger nodes with one link left
    belong where that goes, whatever becomes of it, and leave the rounds with it, so that a round
    costs what is still open and not all links. Rounds grow with the logarithm of the longest
    chain, and each is written before the next; all are deleted at the end.
    """
    spark = links.sparkSession
    pair = links.select(F.col(a).alias("u"), F.col(b).alias("v"))
    nodes = pair.select(F.col("u").alias("node")).union(pair.select("v")).where("node IS NOT NULL").distinct()
    with own_work(spark) as keep:
        points = keep(_pointed(pair.where("u <> v")), "identity-links")
    return nodes.join(points, "node", "left").select("node", F.coalesce("component", "node").alias("component"))


def _pointed(pair: DataFrame) -> DataFrame:
    """``node, component`` of every node that is not the least of its component."""
    spark = pair.sparkSession
    edges = _written(pair.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    rounds = []
    while True:
        marked = _written(_marked(edges[0]))[0]
        delete(spark, edges[1])
        rounds.append(marked.where("leaf").select("u", "v"))
        rest = marked.where("NOT leaf").select("u", "v")
        if not rest.limit(1).count():
            break
        edges = _written(_hung(rest))
    # the last to leave hang on components; those before them on one of these or on a component
    points = rounds[-1].toDF("node", "component")
    for left in reversed(rounds[:-1]):
        known = left.withColumnRenamed("u", "of").join(points, F.col("v") == F.col("node"), "left")
        found = stage(known.select(F.col("of").alias("node"), F.coalesce("component", "v").alias("component")), "components")
        points = points.unionAll(found)
    return points


def _marked(edges: DataFrame) -> DataFrame:
    """Links (u, v) with u > v, and whether ``leaf`` u has no other one."""
    once = edges.select("u").unionAll(edges.select("v")).groupBy("u").agg(F.count("*").alias("n")).where("n = 1")
    return edges.join(once, "u", "left").select("u", "v", F.col("n").isNotNull().alias("leaf"))


def _written(df: DataFrame) -> tuple[DataFrame, str]:
    path = work_path(df.sparkSession, "identity-links")
    write_layer(df, path)
    return read_layer(df.sparkSession, path, df.schema), path


def _hung(links: DataFrame) -> DataFrame:
    """Both steps of a round over links (u, v) with u > v."""
    both = links.unionAll(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    large = both.where("v > u").join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    low = large.groupBy("u").agg(F.min("v").alias("m"))
    small = large.join(low, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return small.unionAll(low.select("u", F.col("m").alias("v"))).distinct()


def _same(records: DataFrame, key: str, evidence: Sequence[str]) -> DataFrame:
    """Links of the ids that share the values of some columns: each to the least of them."""
    known = reduce(Column.__and__, [_has_value(records, c) for c in evidence])
    held = records.where(known & F.col(key).isNotNull()).select(F.col(key).alias("a"), *evidence).distinct()
    first = held.groupBy(*evidence).agg(F.min("a").alias("b"), F.count("*").alias("n")).where("n > 1")
    return held.join(first.drop("n"), list(evidence)).select("a", "b").where("a <> b")


def _has_value(records: DataFrame, column: str) -> Column:
    if records.schema[column].dataType.typeName() == "string":
        return F.coalesce(P.strip_spaces(column) != "", F.lit(False))
    return F.col(column).isNotNull()


def _similar(records: DataFrame, key: str, name: Column, within: Sequence[str], threshold: float) -> DataFrame:
    """Links of the ids whose names are equal or similar and that agree in the columns ``within``.

    Spellings are made distinct before they are compared, and every spelling stands for its ids
    by the least of them.
    """
    known = reduce(Column.__and__, [_has_value(records, c) for c in within], F.col(key).isNotNull())
    named = records.where(known).select(F.col(key).alias("a"), *within, name.alias("name")).where("name IS NOT NULL AND name <> ''")
    named = stage(named.distinct(), "named-ids")
    spelled = stage(named.groupBy(*within, "name").agg(F.min("a").alias("b")), "spellings")
    equal = named.join(spelled, [*within, "name"]).select("a", "b").where("a <> b")
    pairs = similar_pairs(spelled.select("name"), threshold).select("name", "match")
    # the pairs meet the spellings twice; agreement in ``within`` is part of the second join
    one = pairs.join(spelled.withColumnRenamed("b", "a"), "name").drop("name")
    two = spelled.withColumnRenamed("name", "match")
    close = one.join(two, ["match", *within]).select("a", "b").where("a <> b")
    return equal.unionAll(close)


def identity_links(
    records: DataFrame,
    key: str = "global_id",
    exact: Sequence[Sequence[str]] = (),
    name: Column | str | None = None,
    within: Sequence[str] = (),
    threshold: float = THRESHOLD,
) -> DataFrame:
    """The links (a, b) between ids that evidence gives."""
    found = [_same(records, key, columns) for columns in exact]
    if name is not None:
        name = F.col(name) if isinstance(name, str) else name
        found.append(_similar(records, key, name, within, threshold))
    if not found:
        raise ValueError("no evidence is named")
    return reduce(DataFrame.unionAll, found)


def resolve_identities(
    records: DataFrame,
    key: str = "global_id",
    exact: Sequence[Sequence[str]] = (),
    name: Column | str | None = None,
    within: Sequence[str] = (),
    threshold: float = THRESHOLD,
) -> DataFrame:
    """``key, identity_id``: for every id the least id among all that evidence connects with it.

    ``exact`` are groups of columns whose equal values make one person, such as ``[["dni"]]``;
    ``name`` is a name in its compared spelling, and ids with equal names, or names of a
    Jaro-Winkler similarity of ``threshold`` on, are one person if the columns ``within`` (say, the
    birth date) agree. Null and blank values are no evidence. Ids that nothing connects are their
    own identity; records without an id are left out, and of no records comes no row.
    """
    links = stage(identity_links(records, key, exact, name, within, threshold).distinct(), "identity-evidence")
    ids = records.where(F.col(key).isNotNull()).select(key).distinct()
    of = connected(links).select(F.col("node").alias(key), "component")
    return ids.join(of, key, "left").select(key, F.coalesce("component", key).alias("identity_id"))


def with_identity(records: DataFrame, identities: DataFrame, key: str = "global_id") -> DataFrame:
    """The records with ``identity_id``; reports on variants can then go by it instead of the id."""
    return records.join(identities, key, "left")
