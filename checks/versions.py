from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from probity.operators import audit as A
from probity.operators import intervals as I
from probity.operators import manifests as M
from probity.operators import replay as R
from probity.sources.layers import append_history, read_history, work_path

from .audit import CHANGES, NEW, OLD
from .registered import Tables, query


@query(CHANGES, old_version=OLD, new_version=NEW)
def ranged_diff(t: Tables) -> DataFrame:
    """The same changes as of the whole versions, from key ranges whose manifests differ."""
    columns = ["global_id", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment", "search_context"]
    old = M.write_ranged(t.sql(OLD).select(columns), work_path(t.spark, "old-ranges"), ranges=40)
    new = M.write_ranged(t.sql(NEW).select(columns), work_path(t.spark, "new-ranges"), like=old)
    return M.ranged_diff(t.spark, old, new).drop("timestamp")


# A version in which only the last tenth of the keys has changed.
LATER = """
    SELECT o_orderkey AS global_id, o_orderstatus, CASE WHEN o_orderkey % 10 = 3 AND o_orderkey > top * 0.9
        THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice
    FROM {orders}, (SELECT max(o_orderkey) AS top FROM {orders}) m"""
EARLIER = "SELECT o_orderkey AS global_id, o_orderstatus, o_totalprice FROM {orders}"


@query(
    """SELECT e.global_id, 'o_totalprice' AS field_changed, e.o_totalprice AS old_value, l.o_totalprice AS new_value,
        TRUE AS most_ranges_left_out
    FROM earlier e JOIN later l USING (global_id) WHERE e.o_totalprice IS DISTINCT FROM l.o_totalprice""",
    earlier=EARLIER,
    later=LATER,
)
def ranged_diff_of_few_ranges(t: Tables) -> DataFrame:
    """Changes that lie together leave most ranges of a version as they were, and unread."""
    old = M.write_ranged(t.sql(EARLIER), work_path(t.spark, "old-ranges"), ranges=32)
    new = M.write_ranged(t.sql(LATER), work_path(t.spark, "new-ranges"), like=old)
    changed = M.changed_ranges(t.spark, old, new)
    found = M.ranged_diff(t.spark, old, new)
    values = [F.col(c).cast("double").alias(c) for c in ("old_value", "new_value")]
    return found.select("global_id", "field_changed", *values, F.lit(len(changed) < 16).alias("most_ranges_left_out"))


# Three versions of the orders: the status changes first, then the price, some of both twice.
FIRST = EARLIER
SECOND = """
    SELECT o_orderkey AS global_id, CASE WHEN o_orderkey % 3 = 0 THEN NULL WHEN o_orderkey % 7 = 2 THEN lower(o_orderstatus)
        ELSE o_orderstatus END AS o_orderstatus,
        CASE WHEN o_orderkey % 10 = 3 THEN -o_totalprice ELSE o_totalprice END AS o_totalprice
    FROM {orders} WHERE o_orderkey % 101 <> 5"""
THIRD = """
    SELECT o_orderkey AS global_id, CASE WHEN o_orderkey % 7 = 2 THEN 'Z' ELSE o_orderstatus END AS o_orderstatus,
        CASE WHEN o_orderkey % 20 = 13 THEN NULL ELSE o_totalprice END AS o_totalprice
    FROM {orders} WHERE o_orderkey % 103 <> 7"""
MOMENTS = ("2024-01-01", "2024-01-15", "2024-02-15")
THEN = """
    SELECT '{day}' AS day, global_id, {status} AS o_orderstatus, {price} AS o_totalprice
    FROM third t LEFT JOIN second s USING (global_id) LEFT JOIN first f USING (global_id)"""


@query(
    " UNION ALL ".join(
        [
            # a key that the second version lacks has no changes on record
            THEN.format(day=MOMENTS[0], **{n: f"CASE WHEN s.global_id IS NULL THEN t.{c} ELSE f.{c} END" for n, c in
                                           (("status", "o_orderstatus"), ("price", "o_totalprice"))}),
            THEN.format(day=MOMENTS[1], **{n: f"CASE WHEN s.global_id IS NULL THEN t.{c} ELSE s.{c} END" for n, c in
                                           (("status", "o_orderstatus"), ("price", "o_totalprice"))}),
            THEN.format(day=MOMENTS[2], status="t.o_orderstatus", price="t.o_totalprice"),
        ]
    ),
    first=FIRST,
    second=SECOND,
    third=THIRD,
)
def state_as_of(t: Tables) -> DataFrame:
    """The last version set back to three moments by the audit of two runs."""
    path = work_path(t.spark, "audit")
    first, second, third = t.sql(FIRST), t.sql(SECOND), t.sql(THIRD)
    for old, new, day in ((first, second, "2024-01-10"), (second, third, "2024-02-10")):
        append_history(A.snapshot_diff(old, new, at=F.lit(day).cast("timestamp")), path)
    history = read_history(t.spark, path)
    states = [R.state_at(third, history, day).select(F.lit(day).alias("day"), "*") for day in MOMENTS]
    return states[0].unionAll(states[1]).unionAll(states[2])


# Suppliers are companies with two sanctions each, some of them open at an end; a third of all
# deliveries is one company's.
DELIVERIES = """
    SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'A' THEN 1 ELSE l_suppkey END AS ruc,
        CASE WHEN l_quantity < 50 THEN CAST(l_shipdate AS DATE) END AS dia FROM {lineitem}"""
IN_FORCE = """
    SELECT s_suppkey AS ruc, 'MULTA' AS tipo,
        CASE WHEN s_suppkey % 4 <> 1 THEN CAST('1995-01-01' AS DATE) + CAST(s_suppkey * 37 % 2000 AS INT) END AS fecha_inicio,
        CASE WHEN s_suppkey % 5 <> 2 THEN CAST('1996-01-01' AS DATE) + CAST(s_suppkey * 53 % 2500 AS INT) END AS fecha_fin
    FROM {supplier}
    UNION ALL SELECT s_suppkey, 'INHABILITACION', CAST('1998-06-01' AS DATE) + CAST(s_suppkey % 30 AS INT),
        CAST('1998-06-20' AS DATE) + CAST(s_suppkey % 90 AS INT) FROM {supplier}"""


@query(
    """SELECT l_orderkey, l_linenumber, d.ruc, tipo FROM deliveries d JOIN in_force i ON d.ruc = i.ruc
        AND dia >= coalesce(fecha_inicio, DATE '0001-01-01') AND dia <= coalesce(fecha_fin, DATE '9999-12-31')""",
    deliveries=DELIVERIES,
    in_force=IN_FORCE,
)
def sanctions_in_force(t: Tables) -> DataFrame:
    """Deliveries of a company on a day on which a sanction against it was in force."""
    found = I.in_force(
        t.sql(DELIVERIES), t.sql(IN_FORCE), ["ruc"], "dia", "fecha_inicio", "fecha_fin", hot_rows=5_000
    )
    return found.select("l_orderkey", "l_linenumber", "ruc", "tipo")


@query(
    """SELECT ruc, tipo FROM in_force WHERE DATE '1998-06-25' >= coalesce(fecha_inicio, DATE '0001-01-01')
        AND DATE '1998-06-25' <= coalesce(fecha_fin, DATE '9999-12-31')""",
    in_force=IN_FORCE,
)
def sanctions_on_a_day(t: Tables) -> DataFrame:
    return I.in_force_on(t.sql(IN_FORCE), "1998-06-25", "fecha_inicio", "fecha_fin").select("ruc", "tipo")
