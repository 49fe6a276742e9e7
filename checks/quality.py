from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from probity.operators import quality as Q
from probity.sources.layers import append_history, read_history, work_path

from .registered import Tables, query

DAMAGED = """
    SELECT c_custkey,
        CASE WHEN c_custkey % 13 = 3 THEN 'A' || CAST(c_custkey AS STRING)
            WHEN c_custkey % 17 = 5 THEN NULL
            ELSE lpad(CAST(c_custkey AS STRING), 8, '0') END AS dni,
        CASE WHEN c_custkey % 19 = 3 THEN '' WHEN c_custkey % 23 = 5 THEN NULL ELSE c_name END AS nombres
    FROM {customer}"""

CLASSIFIED = f"""
    SELECT *, CASE
        WHEN NOT good_id AND NOT good_name THEN '{Q.BAD_ID_AND_NAME}'
        WHEN NOT good_id THEN '{Q.BAD_ID}'
        WHEN NOT good_name THEN '{Q.BAD_NAME}' END AS motivo_rechazo
    FROM (SELECT *, coalesce(regexp_full_match(dni, '[0-9]{{8}}'), FALSE) AS good_id,
        coalesce(length(nombres) > 0, FALSE) AS good_name FROM damaged) d"""


@query(
    "SELECT c_custkey, dni, nombres FROM classified WHERE motivo_rechazo IS NULL",
    damaged=DAMAGED,
    classified=CLASSIFIED,
)
def quality_valid(t: Tables) -> DataFrame:
    return Q.valid_rows(Q.classify(t.sql(DAMAGED)))


@query(
    "SELECT c_custkey, dni, nombres, motivo_rechazo FROM classified WHERE motivo_rechazo IS NOT NULL",
    damaged=DAMAGED,
    classified=CLASSIFIED,
)
def quality_rejected(t: Tables) -> DataFrame:
    return Q.rejected_rows(Q.classify(t.sql(DAMAGED)))


@query(
    """SELECT count(*) AS total, count(motivo_rechazo) AS invalid, count(motivo_rechazo) / count(*) AS error_ratio
    FROM classified""",
    damaged=DAMAGED,
    classified=CLASSIFIED,
)
def quality_ratio(t: Tables) -> DataFrame:
    return Q.quality_counts(Q.classify(t.sql(DAMAGED)))


@query(
    "SELECT c_custkey, dni, nombres FROM classified WHERE motivo_rechazo IS NULL",
    damaged=DAMAGED,
    classified=CLASSIFIED,
)
def quality_enforced(t: Tables) -> DataFrame:
    """Quarantine, breaker and pass-through in one."""
    valid, _ = Q.enforce_quality(t.sql(DAMAGED), work_path(t.spark, "rejected"), max_error_ratio=0.5)
    return valid


@query(
    """SELECT c_custkey, dni, nombres, motivo_rechazo, CAST(NULL AS VARCHAR) AS c_name
    FROM classified WHERE motivo_rechazo IS NOT NULL
    UNION ALL SELECT c_custkey, NULL, NULL, 'saldo negativo', c_name FROM customer WHERE c_acctbal < 0""",
    damaged=DAMAGED,
    classified=CLASSIFIED,
)
def quarantine_history(t: Tables) -> DataFrame:
    """Two runs whose rejects differ in columns, read back as one history."""
    path = work_path(t.spark, "quarantine")
    append_history(Q.rejected_rows(Q.classify(t.sql(DAMAGED))), path)
    in_debt = t.customer.where("c_acctbal < 0").select(
        "c_custkey", "c_name", F.lit("saldo negativo").alias("motivo_rechazo")
    )
    append_history(in_debt, path)
    return read_history(t.spark, path).select("c_custkey", "dni", "nombres", "motivo_rechazo", "c_name")


@query(
    """SELECT o_orderkey, CASE
        WHEN o_custkey IS NULL THEN 'id ausente'
        WHEN NOT coalesce(o_orderdate <= TIMESTAMP '2000-01-01', FALSE) THEN 'fecha futura'
        WHEN NOT coalesce(o_orderstatus IN ('F', 'O'), FALSE) THEN 'partido desconocido' END AS broken_rule
    FROM orders"""
)
def quality_contract(t: Tables) -> DataFrame:
    rules = {
        "id ausente": F.col("o_custkey").isNotNull(),
        "fecha futura": F.col("o_orderdate") <= F.lit("2000-01-01").cast("timestamp_ntz"),
        "partido desconocido": F.col("o_orderstatus").isin("F", "O"),
    }
    return t.orders.select("o_orderkey", Q.first_broken_rule(rules).alias("broken_rule"))


@query(
    """SELECT doc_id, lang, doc_id IN (SELECT doc_id FROM labels) AS labelled FROM documents"""
)
def known_references(t: Tables) -> DataFrame:
    return Q.mark_known(t.documents.select("doc_id", "lang"), "doc_id", t.labels, "doc_id", "labelled")

