from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from probity.operators import reports as R

from .registered import Tables, query

SPARSE = """
    SELECT c_mktsegment AS source_category, CASE WHEN c_acctbal > 0 THEN c_acctbal END AS c_acctbal,
        CASE WHEN c_nationkey <> 3 THEN c_name END AS c_name, c_custkey
    FROM {customer}"""


@query(
    " UNION ALL ".join(
        f"""SELECT source_category, '{c}' AS field, round(count({c}) * 100.0 / count(*), 6) AS percent_present
        FROM sparse GROUP BY 1"""
        for c in ("c_acctbal", "c_name", "c_custkey")
    ),
    sparse=SPARSE,
)
def completeness(t: Tables) -> DataFrame:
    report = R.completeness(t.sql(SPARSE))
    return report.withColumn("percent_present", F.round("percent_present", 6))


@query(
    """SELECT r_name, n_name, count(*) AS entities FROM customer JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2"""
)
def distribution(t: Tables) -> DataFrame:
    people = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    placed = people.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    return R.distribution(placed, "r_name", "n_name")


DATED = """
    SELECT o_orderpriority AS source, CASE WHEN o_orderstatus = 'P' THEN 'sin fecha'
        ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END AS cut_off FROM {orders}"""


@query(
    """SELECT source, CAST(max(try_cast(cut_off AS DATE)) AS VARCHAR) AS latest, count(try_cast(cut_off AS DATE)) AS dated_rows
    FROM dated GROUP BY 1""",
    dated=DATED,
)
def freshness(t: Tables) -> DataFrame:
    report = R.freshness(t.sql(DATED), "source", "cut_off")
    return report.withColumn("latest", F.col("latest").cast("string"))


PAIRS = """
    SELECT upper(p_name) AS a,
        CASE p_partkey % 4 WHEN 0 THEN upper(p_name) WHEN 1 THEN replace(upper(p_name), 'L', 'LL')
            WHEN 2 THEN replace(upper(p_name), 'R', '') ELSE upper(p_type) || ' ' || upper(p_name) END AS b,
        p_partkey % 4 < 2 AS is_same
    FROM {part}"""
THRESHOLDS = [0.85, 0.88, 0.9, 0.92, 0.95, 0.98]


@query(
    f"""SELECT CAST(t AS DOUBLE) AS threshold, count(*) FILTER (score >= t) AS found,
        count(*) FILTER (score >= t AND is_same) AS correct,
        count(*) FILTER (score >= t AND is_same) / nullif(count(*) FILTER (score >= t), 0) AS precision,
        count(*) FILTER (score >= t AND is_same) / nullif(count(*) FILTER (is_same), 0) AS recall
    FROM (SELECT is_same, round(jaro_winkler_similarity(a, b), 12) AS score FROM pairs) s,
        (SELECT unnest({THRESHOLDS}) AS t) x GROUP BY t""",
    pairs=PAIRS,
)
def threshold_evaluation(t: Tables) -> DataFrame:
    return R.evaluate_thresholds(t.sql(PAIRS), THRESHOLDS, "a", "b", "is_same")


@query("SELECT l_suppkey, l_returnflag, l_linestatus, count(*) AS occurrences FROM lineitem GROUP BY 1, 2, 3")
def identity_variants(t: Tables) -> DataFrame:
    return R.identity_variants(t.lineitem, ["l_returnflag", "l_linestatus"], "l_suppkey")


@query(
    """SELECT l_suppkey, l_returnflag, l_linestatus, variants, occurrences FROM (
        SELECT l_suppkey, l_returnflag, l_linestatus, count(*) OVER w AS variants,
            CAST(sum(n) OVER w AS BIGINT) AS occurrences, row_number() OVER (PARTITION BY l_suppkey
                ORDER BY n DESC, l_returnflag, l_linestatus) AS k
        FROM (SELECT l_suppkey, l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY 1, 2, 3) v
        WINDOW w AS (PARTITION BY l_suppkey)) x WHERE k = 1"""
)
def canonical_identities(t: Tables) -> DataFrame:
    return R.canonical_identities(t.lineitem, ["l_returnflag", "l_linestatus"], "l_suppkey")


GAPS = """
    SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN ' ' WHEN c_custkey % 4 = 1 THEN NULL ELSE c_name END AS c_name,
        CASE WHEN c_nationkey <> 5 THEN c_acctbal END AS c_acctbal FROM {customer}"""
DETAIL = "SELECT c_custkey, 'detalle ' || c_name AS c_name, c_acctbal + 1 AS c_acctbal FROM {customer}"


@query(
    """SELECT c_custkey, coalesce(CASE WHEN trim(g.c_name) <> '' THEN g.c_name END, d.c_name) AS c_name,
        coalesce(g.c_acctbal, d.c_acctbal) AS c_acctbal
    FROM gaps g LEFT JOIN detail d USING (c_custkey)""",
    gaps=GAPS,
    detail=DETAIL,
)
def backfill(t: Tables) -> DataFrame:
    return R.backfill(t.sql(GAPS), t.sql(DETAIL), "c_custkey", ["c_name", "c_acctbal"])


@query(
    """SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'first' WHEN c_custkey % 5 <> 0 THEN 'detail' END AS nivel,
        CAST(CASE WHEN c_custkey % 3 = 0 THEN 1 WHEN c_custkey % 5 <> 0 THEN 2 ELSE 0 END AS BIGINT) AS n
    FROM customer"""
)
def backfill_maps(t: Tables) -> DataFrame:
    """Free sections are maps: empty and null ones are filled from the second source, copies of it count once."""
    key = F.col("c_custkey")
    empty = F.create_map().cast("map<string,string>")
    first = t.customer.select(
        "c_custkey",
        F.when(key % 3 == 0, F.create_map(F.lit("nivel"), F.lit("first"))).when(key % 2 == 0, empty).alias("oEduBasica"),
    )
    more = F.create_map(F.lit("nivel"), F.lit("detail"), F.lit("a"), key.cast("string"))
    detail = t.customer.where("c_custkey % 5 <> 0").select("c_custkey", more.alias("oEduBasica"))
    filled = R.backfill(first, detail.unionAll(detail), "c_custkey", ["oEduBasica"])
    section = F.col("oEduBasica")
    return filled.select(
        "c_custkey", section["nivel"].alias("nivel"), F.coalesce(F.size(section), F.lit(0)).cast("bigint").alias("n")
    )
