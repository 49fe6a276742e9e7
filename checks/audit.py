from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from probity.operators import audit as A
from probity.sources.layers import read_history, work_path, write_layer

from .registered import Tables, query

OLD = """
    SELECT c_custkey AS global_id, c_name, c_nationkey, c_acctbal, c_mktsegment, 'x' AS only_old, 'a' AS search_context
    FROM {customer} WHERE c_mktsegment <> 'BUILDING'"""
NEW = """
    SELECT c_custkey AS global_id, CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_name END AS c_name,
        CASE WHEN c_custkey % 7 = 0 THEN c_nationkey + 1 ELSE c_nationkey END AS c_nationkey,
        CASE WHEN c_custkey % 11 = 0 THEN -c_acctbal ELSE c_acctbal END AS c_acctbal,
        CASE WHEN c_custkey % 13 = 0 THEN lower(c_mktsegment) ELSE c_mktsegment END AS c_mktsegment,
        'b' AS search_context, 'y' AS only_new
    FROM {customer} WHERE c_mktsegment <> 'MACHINERY'"""
FIELDS = ("c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
CHANGES = " UNION ALL ".join(
    f"""SELECT global_id, '{f}' AS field_changed, CAST(o.{f} AS VARCHAR) AS old_value, CAST(n.{f} AS VARCHAR) AS new_value
    FROM old_version o JOIN new_version n USING (global_id) WHERE o.{f} IS DISTINCT FROM n.{f}"""
    for f in FIELDS
)


@query(CHANGES, old_version=OLD, new_version=NEW)
def snapshot_diff(t: Tables) -> DataFrame:
    return A.snapshot_diff(t.sql(OLD), t.sql(NEW)).drop("timestamp")


OLD_COPIES = "SELECT c_nationkey AS global_id, c_custkey AS v FROM {customer}"
NEW_COPIES = """
    SELECT c_nationkey AS global_id, CASE WHEN c_custkey % 7 = 0 THEN c_custkey + 1000000 ELSE c_custkey END AS v
    FROM {customer} WHERE c_custkey % 97 <> 5"""


@query(
    """SELECT global_id, 'v' AS field_changed, CAST(was AS VARCHAR) AS old_value, CAST(now AS VARCHAR) AS new_value
    FROM (SELECT global_id, last_value(o.v IGNORE NULLS) OVER w AS was, last_value(n.v IGNORE NULLS) OVER w AS now
        FROM (SELECT *, row_number() OVER (PARTITION BY global_id ORDER BY v) AS turn
            FROM (FROM old_copies EXCEPT ALL FROM new_copies) a) o
        FULL JOIN (SELECT *, row_number() OVER (PARTITION BY global_id ORDER BY v) AS turn
            FROM (FROM new_copies EXCEPT ALL FROM old_copies) b) n USING (global_id, turn)
        WINDOW w AS (PARTITION BY global_id ORDER BY turn)) p
    WHERE was IS NOT NULL AND now IS NOT NULL
    UNION ALL SELECT global_id, '(copies)', CAST(o.n AS VARCHAR), CAST(c.n AS VARCHAR)
    FROM (SELECT global_id, count(*) AS n FROM old_copies GROUP BY 1) o
    JOIN (SELECT global_id, count(*) AS n FROM new_copies GROUP BY 1) c USING (global_id) WHERE o.n <> c.n""",
    old_copies=OLD_COPIES,
    new_copies=NEW_COPIES,
)
def snapshot_diff_repeated_keys(t: Tables) -> DataFrame:
    """A key that many rows share: changed, lost and unchanged copies under it."""
    return A.snapshot_diff(t.sql(OLD_COPIES), t.sql(NEW_COPIES)).drop("timestamp")


@query(
    f"SELECT field_changed, count(*) AS changes FROM ({CHANGES}) c GROUP BY 1",
    old_version=OLD,
    new_version=NEW,
)
def changes_per_field(t: Tables) -> DataFrame:
    return A.changes_per_field(A.snapshot_diff(t.sql(OLD), t.sql(NEW)))


@query(
    f"""SELECT c.*, runs.run FROM ({CHANGES}) c, (VALUES ('forth'), ('back')) runs(run) WHERE run = 'forth'
    UNION ALL SELECT global_id, field_changed, new_value, old_value, 'back' FROM ({CHANGES}) d""",
    old_version=OLD,
    new_version=NEW,
)
def audit_history(t: Tables) -> DataFrame:
    """Two runs appended to one history: the changes, and the way back."""
    path = work_path(t.spark, "audit")
    old, new = t.sql(OLD), t.sql(NEW)
    forth = A.log_changes(old, new, path)
    A.log_changes(new, old, path)
    history = read_history(t.spark, path)
    assert forth == history.count() / 2
    first = history.agg(F.min("timestamp")).first()[0]
    run = F.when(F.col("timestamp") == F.lit(first), F.lit("forth")).otherwise(F.lit("back"))
    return history.select("global_id", "field_changed", "old_value", "new_value", run.alias("run"))


@query(
    """SELECT 'orders' AS layer, 'ok' AS status, count(*) AS row_count, 'degraded' AS overall FROM orders
    UNION ALL SELECT 'lineitem', 'ok', count(*), 'degraded' FROM lineitem
    UNION ALL SELECT 'written', 'ok', count(*), 'degraded' FROM customer
    UNION ALL SELECT 'absent', 'missing', 0, 'degraded'"""
)
def layer_status(t: Tables) -> DataFrame:
    path = work_path(t.spark, "layer")
    write_layer(t.customer, path)
    layers = {"orders": t.orders, "lineitem": t.lineitem, "written": path, "absent": f"{path}-none"}
    return A.layer_status(t.spark, layers).drop("hash_xor", "hash_sum")


@query(
    """SELECT 'reordered' AS version, NOT EXISTS (SELECT * FROM orders EXCEPT ALL SELECT * FROM orders) AS same_rows
    UNION ALL SELECT 'changed', NOT EXISTS (SELECT o_orderkey, o_totalprice FROM orders
        EXCEPT ALL SELECT o_orderkey, o_totalprice + CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END FROM orders)
    UNION ALL SELECT 'doubled', FALSE"""
)
def version_check(t: Tables) -> DataFrame:
    orders = t.orders
    one_more = F.when(F.col("o_orderstatus") == "P", F.lit(1)).otherwise(F.lit(0))
    versions = {
        "reordered": orders.orderBy("o_totalprice").select(*reversed(orders.columns)),
        "changed": orders.withColumn("o_totalprice", F.col("o_totalprice") + one_more),
        "doubled": orders.unionAll(orders).unionAll(orders),
    }
    mark = A.fingerprint(orders)
    checks = [
        mark.join(A.fingerprint(version.select(*orders.columns)), mark.columns, "left_semi")
        .agg((F.count("*") > 0).alias("same_rows"))
        .select(F.lit(name).alias("version"), "same_rows")
        for name, version in versions.items()
    ]
    return checks[0].unionByName(checks[1]).unionByName(checks[2])


@query("SELECT * FROM (VALUES ('same', TRUE), ('moved', FALSE), ('list', FALSE), ('inner', FALSE), ('map', FALSE)) v(version, same_rows)")
def version_check_nulls(t: Tables) -> DataFrame:
    """A value next to a null changes places; an empty list for null; null in a struct, a list, a map."""
    some = F.col("o_orderstatus") == "P"
    base = t.orders.select(
        "o_orderkey",
        F.when(some, F.col("o_orderpriority")).alias("a"),
        F.lit(None).cast("string").alias("b"),
        F.when(~some, F.array("o_orderstatus", F.lit(None))).alias("l"),
        F.struct("o_orderpriority", F.lit(None).cast("string").alias("y")).alias("s"),
        F.create_map(F.lit("k"), F.lit(None).cast("string")).alias("m"),
    )
    versions = {
        "same": base.orderBy("o_orderkey"),
        "moved": base.withColumns({"a": F.col("b"), "b": F.col("a")}),
        "list": base.withColumn("l", F.coalesce("l", F.array().cast("array<string>"))),
        "inner": base.withColumn("s", F.struct(F.col("s.y").alias("o_orderpriority"), F.col("s.o_orderpriority").alias("y"))),
        "map": base.withColumn("m", F.create_map(F.lit("k"), F.lit(""))),
    }
    mark = A.fingerprint(base)
    found = [
        A.fingerprint(df)
        .join(mark, mark.columns, "left_semi")
        .agg((F.count("*") > 0).alias("same_rows"))
        .select(F.lit(name).alias("version"), "same_rows")
        for name, df in versions.items()
    ]
    return reduce(DataFrame.unionByName, found)


@query()
def fingerprint(t: Tables) -> DataFrame:
    return A.fingerprint(t.lineitem)
