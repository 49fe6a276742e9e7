from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from probity import functions as P
from probity.operators import grouped_stats as G
from probity.operators import rollups as R
from probity.sources.layers import work_path, write_layer

from .registered import Tables, query
from .risk import sql_rounded

# Prices by part, of which there are many with few lines each, and by a status that a third of all share.
PRICES = """
    SELECT 'part' AS kind, CAST(l_partkey AS STRING) AS party, l_extendedprice AS price FROM {lineitem}
    UNION ALL SELECT 'status', CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END,
        CASE WHEN o_orderkey % 7 <> 3 THEN o_totalprice END FROM {orders}"""


@query(
    f"""SELECT kind, party, count(price) AS n, {sql_rounded('any_value(m)')} AS median, {sql_rounded('median(abs(price - m))')} AS mad
    FROM (SELECT *, median(price) OVER (PARTITION BY kind, party) AS m FROM prices) p
    GROUP BY kind, party HAVING count(price) > 0""",
    prices=PRICES,
)
def grouped_median_and_spread(t: Tables) -> DataFrame:
    """Exact medians and spreads of many small groups and some that no task could sort."""
    found = G.grouped_median_and_mad(t.sql(PRICES), ["kind", "party"], "price", few_rows=500)
    rounded = [P.round_half_up(F.col(c), 6).alias(c) for c in ("median", "mad")]
    return found.select("kind", "party", "n", *rounded)


HIERARCHY = """
    SELECT r_name AS region, CASE WHEN n_nationkey % 6 <> 4 THEN n_name END AS nation, c_mktsegment AS segment,
        o_custkey AS who
    FROM {orders} JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey
    JOIN {region} ON n_regionkey = r_regionkey"""


@query(
    """SELECT region, nation, segment, CAST(GROUPING(region, nation, segment) AS BIGINT) AS level, count(*) AS entities,
        count(DISTINCT who) AS distinct_values
    FROM hierarchy GROUP BY ROLLUP (region, nation, segment)""",
    hierarchy=HIERARCHY,
)
def distribution_rollup(t: Tables) -> DataFrame:
    return R.rolled_up(t.sql(HIERARCHY), ["region", "nation", "segment"], "who")


@query(
    """SELECT region, nation, segment, CAST(GROUPING(region, nation, segment) AS BIGINT) AS level, count(*) AS entities,
        TRUE AS within_three_percent
    FROM hierarchy GROUP BY ROLLUP (region, nation, segment)""",
    hierarchy=HIERARCHY,
)
def distribution_sketches(t: Tables) -> DataFrame:
    """The same levels from two written layers of sketches, next to exact distinct counts."""
    by, rows = ["region", "nation", "segment"], t.sql(HIERARCHY)
    paths = [work_path(t.spark, "sketches") for _ in range(2)]
    for part, path in enumerate(paths):
        write_layer(R.sketch_layer(rows.where(F.col("who") % 2 == part), by, "who"), path)
    layer = R.merged([t.spark.read.parquet(p) for p in paths], by)
    guess = R.rolled_up_layer(layer, by).withColumnRenamed("distinct_values", "guess")
    exact = R.rolled_up(rows, by, "who").drop("entities")
    same = [guess[c].eqNullSafe(exact[c]) for c in (*by, "level")]
    off = F.abs(F.col("guess") - F.col("distinct_values"))
    return guess.join(exact, same[0] & same[1] & same[2] & same[3]).select(
        *[guess[c] for c in (*by, "level")], "entities", (off <= 0.03 * F.col("distinct_values")).alias("within_three_percent")
    )
