from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from probity import functions as P
from probity.functions import scoring as S
from probity.operators import risk as R
from probity.operators.stats import exact_median, median_and_mad
from probity.plans.gold import to_gold

from .cleaning import PLAN_ROWS, sql_uuid5
from .linking import COMPANY_LINKS, EXACT_LINKS, PEOPLE, SANCTIONS, registry
from .registered import Tables, query
from .sources import pad

# One Silver-like row per customer. Sums are of whole cents, so that both engines agree
# whatever the order of the rows.
FIGURES = f"""
    SELECT c_custkey, {pad('c_custkey', 8)} AS dni, c_name AS nombres, c_mktsegment AS partido,
        CAST(c_nationkey AS STRING) AS id_organizacion_politica,
        CASE WHEN c_acctbal > 0 THEN c_acctbal ELSE 0 END AS ingresos_totales,
        coalesce(cents, 0) / 100 AS valor_total_bienes,
        coalesce(late, 0) AS conteo_sentencias,
        CAST(c_nationkey AS BIGINT) AS experiencia_publica_anios,
        coalesce(urgent, 0) AS cantidad_renuncias
    FROM {{customer}} LEFT JOIN (
        SELECT o_custkey, sum(CAST(floor(o_totalprice * 100 + 0.5) AS BIGINT)) AS cents,
            count(CASE WHEN o_orderstatus = 'P' THEN 1 END) AS late,
            count(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 END) AS urgent
        FROM {{orders}} GROUP BY o_custkey) o ON c_custkey = o_custkey"""

SCORED = f"""
    SELECT *,
        CASE WHEN ratio IS NULL THEN 50.0
            WHEN mad = 0 THEN CASE WHEN ratio > med THEN 0.0 ELSE 100.0 END
            ELSE 100.0 - greatest(least((ratio - med) / (mad * {S.MAD_TO_SIGMA}), 3.0), 0.0) * (100.0 / 3.0)
        END AS score_financiero,
        CASE conteo_sentencias WHEN 0 THEN 1e2 WHEN 1 THEN 5e1 ELSE 0e0 END AS score_legal,
        greatest(100.0 - cantidad_renuncias / (experiencia_publica_anios + 1.0) * 100.0, 0.0) AS score_estabilidad
    FROM (SELECT f.*, med, mad,
            CASE WHEN NOT (ingresos_totales = 0 AND experiencia_publica_anios = 0)
                THEN valor_total_bienes / (ingresos_totales + 1.0) END AS ratio
        FROM figures f, (SELECT median(ratio) AS med, median(abs(ratio - m)) AS mad FROM ratios, (
            SELECT median(ratio) AS m FROM ratios) z) s) x"""
RATIOS = """
    SELECT CASE WHEN NOT (ingresos_totales = 0 AND experiencia_publica_anios = 0)
        THEN valor_total_bienes / (ingresos_totales + 1.0) END AS ratio FROM figures"""


def sql_rounded(value: str, digits: int = 6) -> str:
    return f"floor({value} * 1e{digits} + 0.5) / 1e{digits}"


def figures(t: Tables) -> DataFrame:
    return t.sql(FIGURES).withColumn("global_id", P.global_id("dni", F.lit("")))


ENDLESS = """
    SELECT CASE WHEN o_orderstatus = 'F' THEN o_totalprice WHEN o_orderkey % 3 = 0 THEN -CAST('Infinity' AS DOUBLE)
        WHEN o_orderkey % 17 = 0 THEN CAST('NaN' AS DOUBLE) WHEN o_orderkey % 19 = 0 THEN NULL
        ELSE CAST('Infinity' AS DOUBLE) END AS x FROM {orders}"""


@query(
    """SELECT median(x) AS middle, (SELECT median(x) FROM endless WHERE x > 1e300) AS above,
        (SELECT median(x) FROM endless WHERE x < 1e300) AS below FROM endless WHERE x <> CAST('NaN' AS DOUBLE)""",
    endless=ENDLESS,
)
def median_with_infinities(t: Tables) -> DataFrame:
    """Infinite values have a rank; NaN and null are no values."""
    rows = t.sql(ENDLESS)
    parts = {"middle": rows, "above": rows.where("x > 1e300"), "below": rows.where("x < 1e300")}
    found = [F.lit(exact_median(part, "x", few_rows=100)).cast("double").alias(n) for n, part in parts.items()]
    return t.spark.range(1).select(*found)


@query(
    f"""SELECT 'orders' AS source, {sql_rounded('median(o_totalprice)')} AS median,
        {sql_rounded('median(abs(o_totalprice - m))')} AS mad
    FROM orders, (SELECT median(o_totalprice) AS m FROM orders) x
    UNION ALL SELECT 'lineitem', {sql_rounded('median(l_extendedprice)')},
        {sql_rounded('median(abs(l_extendedprice - m))')}
    FROM lineitem, (SELECT median(l_extendedprice) AS m FROM lineitem) x"""
)
def median_and_spread(t: Tables) -> DataFrame:
    rows = []
    for source, column in (("orders", "o_totalprice"), ("lineitem", "l_extendedprice")):
        median, mad = median_and_mad(getattr(t, source), column)
        rows.append(
            t.spark.range(1).select(
                F.lit(source).alias("source"),
                P.round_half_up(F.lit(median), 6).alias("median"),
                P.round_half_up(F.lit(mad), 6).alias("mad"),
            )
        )
    return rows[0].unionByName(rows[1])


@query(
    f"""SELECT c_custkey, {sql_rounded('score_financiero')} AS score_financiero,
        ratio IS NULL AS cold_start FROM scored""",
    figures=FIGURES,
    ratios=RATIOS,
    scored=SCORED,
)
def robust_z_score(t: Tables) -> DataFrame:
    return R.financial_score(figures(t)).select(
        "c_custkey",
        P.round_half_up(F.col("score_financiero"), 6).alias("score_financiero"),
        P.is_cold_start("ingresos_totales", "experiencia_publica_anios").alias("cold_start"),
    )


@query(
    f"""SELECT c_custkey, score_legal, {sql_rounded('score_estabilidad')} AS score_estabilidad FROM scored""",
    figures=FIGURES,
    ratios=RATIOS,
    scored=SCORED,
)
def step_and_volatility(t: Tables) -> DataFrame:
    return (
        figures(t)
        .transform(R.legal_score)
        .transform(R.stability_score)
        .select(
            "c_custkey",
            "score_legal",
            P.round_half_up(F.col("score_estabilidad"), 6).alias("score_estabilidad"),
        )
    )


SQL_INDEX = (
    f"floor((score_financiero * {S.WEIGHT_FINANCIAL} + score_legal * {S.WEIGHT_LEGAL}"
    f" + score_estabilidad * {S.WEIGHT_STABILITY}) * 100 + 0.5) / 100"
)
SQL_FLAGS = f"""concat_ws(';',
        CASE WHEN ratio IS NULL THEN '{S.FLAG_NO_FINANCIAL_DATA}' END,
        CASE WHEN score_financiero < 40 THEN '{S.FLAG_WEALTH_IMBALANCE}' END,
        CASE WHEN conteo_sentencias = 1 THEN '{S.FLAG_ONE_SENTENCE}' END,
        CASE WHEN conteo_sentencias > 1 THEN '{S.FLAG_MANY_SENTENCES}' END,
        CASE WHEN score_estabilidad < 50 THEN '{S.FLAG_PARTY_SWITCHING}' END,
        CASE WHEN osce_match_score >= 0.92 THEN '{S.FLAG_SANCTIONED_COMPANY}' ||
            CASE WHEN ruc_sancionado IS NOT NULL THEN ' (RUC: ' || ruc_sancionado || ')' ELSE '' END END)"""

LINKED = f"""
    SELECT s.*, {sql_uuid5('dni')} AS global_id, osce_match_score, ruc_sancionado, fup_url, osce_match_method,
        osce_sancionada_match
    FROM scored s LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY global_id
        ORDER BY osce_match_score DESC, ruc_sancionado, osce_sancionada_match) AS k FROM exact_links) b
        ON b.global_id = {sql_uuid5('s.dni')} AND k = 1"""
INPUTS = dict(
    figures=FIGURES,
    ratios=RATIOS,
    scored=SCORED,
    people=PEOPLE,
    company_links=COMPANY_LINKS,
    sanctions=SANCTIONS,
    exact_links=EXACT_LINKS,
    linked=LINKED,
)


@query(
    f"""SELECT c_custkey, {SQL_INDEX} AS score_itr, {SQL_FLAGS} AS risk_flags
    FROM (SELECT *, CASE WHEN c_custkey % 3 = 0 THEN 0.95 WHEN c_custkey % 3 = 1 THEN 0.9 END AS osce_match_score,
        CASE WHEN c_custkey % 2 = 0 THEN dni END AS ruc_sancionado FROM scored) s""",
    figures=FIGURES,
    ratios=RATIOS,
    scored=SCORED,
)
def risk_index_and_flags(t: Tables) -> DataFrame:
    key = F.col("c_custkey")
    linked = figures(t).withColumns(
        {
            "osce_match_score": F.when(key % 3 == 0, F.lit(0.95)).when(key % 3 == 1, F.lit(0.9)),
            "ruc_sancionado": F.when(key % 2 == 0, F.col("dni")),
        }
    )
    scored = (
        linked.transform(R.financial_score)
        .transform(R.legal_score)
        .transform(R.stability_score)
        .transform(R.risk_index)
        .transform(R.risk_flags)
    )
    return scored.select("c_custkey", "score_itr", F.array_join("risk_flags", ";").alias("risk_flags"))


@query(
    f"""SELECT global_id, dni, nombres, CAST(NULL AS VARCHAR) AS apellido_paterno,
        CAST(NULL AS VARCHAR) AS apellido_materno, partido, CAST(NULL AS VARCHAR) AS cargo,
        'customer' AS source_category, ingresos_totales, valor_total_bienes, conteo_sentencias,
        experiencia_publica_anios, cantidad_renuncias, {sql_rounded('score_financiero')} AS score_financiero,
        score_legal, {sql_rounded('score_estabilidad')} AS score_estabilidad, {SQL_INDEX} AS score_itr,
        {SQL_FLAGS} AS risk_flags, search_context, osce_match_score, ruc_sancionado, fup_url, osce_match_method,
        osce_sancionada_match
    FROM linked LEFT JOIN (
        SELECT CAST(id_organizacion_politica AS VARCHAR) AS org, min(coalesce(dimension_social, '') || ' ' || chr(10)
            || ' ' || coalesce(dimension_economica, '') || ' ' || chr(10) || ' ' || coalesce(dimension_ambiental, '')
            || ' ' || chr(10) || ' ' || coalesce(dimension_institucional, '')) AS search_context
        FROM plan_rows GROUP BY 1) p ON id_organizacion_politica = org""",
    **INPUTS,
    plan_rows=PLAN_ROWS,
)
def gold_table(t: Tables) -> DataFrame:
    """Silver to Gold in one go: scores, links, index, flags, plan texts, 24 columns."""
    silver = figures(t).withColumn("source_category", F.lit("customer"))
    gold = to_gold(silver, t.sql(COMPANY_LINKS), registry(t, SANCTIONS), t.sql(PLAN_ROWS))
    return gold.withColumns(
        {
            "score_financiero": P.round_half_up(F.col("score_financiero"), 6),
            "score_estabilidad": P.round_half_up(F.col("score_estabilidad"), 6),
            "risk_flags": F.array_join("risk_flags", ";"),
        }
    )


@query(
    f"""SELECT c_custkey, {sql_uuid5('dni')} AS global_id, {SQL_INDEX} AS score_itr, {SQL_FLAGS} AS risk_flags
    FROM (SELECT *, CAST(NULL AS DOUBLE) AS osce_match_score, CAST(NULL AS VARCHAR) AS ruc_sancionado FROM scored) s
    ORDER BY score_itr, c_custkey LIMIT 100""",
    figures=FIGURES,
    ratios=RATIOS,
    scored=SCORED,
)
def riskiest_people(t: Tables) -> DataFrame:
    """Clean, identify, score, flag and rank: the hundred entities of highest risk."""
    scored = (
        figures(t)
        .withColumns(
            {
                "osce_match_score": F.lit(None).cast("double"),
                "ruc_sancionado": F.lit(None).cast("string"),
            }
        )
        .transform(R.financial_score)
        .transform(R.legal_score)
        .transform(R.stability_score)
        .transform(R.risk_index)
        .transform(R.risk_flags)
    )
    flags = F.array_join("risk_flags", ";").alias("risk_flags")
    return scored.orderBy("score_itr", "c_custkey").limit(100).select(
        "c_custkey", "global_id", "score_itr", flags
    )
