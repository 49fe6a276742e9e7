from __future__ import annotations

from uuid import UUID, uuid5

from pyspark.sql import DataFrame, functions as F

from probity import functions as P
from probity.functions.identifiers import IDENTITY_NAMESPACE
from probity.operators import dossier as D
from probity.operators import paging as G

from probity.sources.layers import read_layer, work_path, write_layer

from .cleaning import sql_uuid5
from .registered import Tables, query
from .sources import pad

SANCTIONS = f"""
    SELECT {pad('s_suppkey')} AS ruc, s_name AS nombre_empresa,
        CASE s_suppkey % 3 WHEN 0 THEN 'INHABILITACION' WHEN 1 THEN 'MULTA' ELSE 'INHABILITACION_JUDICIAL' END
        AS tipo_sancion, '2023' AS fecha_inicio, CAST(NULL AS STRING) AS fecha_fin, 'm' AS motivo,
        s_acctbal AS monto, 'RES-1' AS numero_resolucion
    FROM {{supplier}} WHERE s_acctbal < 4000
    UNION ALL SELECT {pad('s_suppkey')}, 'Z ' || s_name, 'MULTA', '2024', NULL, 'm', s_acctbal, 'RES-2'
    FROM {{supplier}} WHERE s_acctbal < 1000"""
PENALTIES = f"""
    SELECT {pad('l_suppkey')} AS ruc, CAST(NULL AS STRING) AS nombre_empresa
    FROM {{lineitem}} WHERE l_returnflag = 'R'"""
CONSORTIA = f"""
    SELECT l_linenumber AS anio, {pad('l_partkey')} AS ruc_consorcio, 'c' AS consorcio,
        {pad('l_suppkey')} AS ruc_miembro, 'm' AS miembro
    FROM {{lineitem}}"""
LINKS = f"SELECT {pad('s_suppkey')} AS ruc, 'enlace ' || s_name AS nombre_empresa FROM {{supplier}}"
DOSSIERS = """
    SELECT ruc, 'https://apps.osce.gob.pe/perfilprov-ui/ficha/' || ruc AS fup_url,
        coalesce(s.name, l.name) AS nombre_empresa, coalesce(s.n, 0) AS total_sanciones,
        coalesce(p.n, 0) > 0 AS en_penalidades, coalesce(p.n, 0) AS total_penalidades,
        coalesce(c.n, 0) > 0 AS en_consorcios, coalesce(c.n, 0) AS total_consorcios
    FROM (SELECT ruc, count(*) AS n, min(nombre_empresa) AS name FROM sanctions GROUP BY 1) s
    FULL JOIN (SELECT ruc, count(*) AS n FROM penalties GROUP BY 1) p USING (ruc)
    FULL JOIN (SELECT ruc, count(*) AS n FROM (SELECT ruc_consorcio AS ruc FROM consortia
        UNION ALL SELECT ruc_miembro FROM consortia WHERE ruc_miembro <> ruc_consorcio) e GROUP BY 1) c USING (ruc)
    LEFT JOIN (SELECT ruc, min(nombre_empresa) AS name FROM links GROUP BY 1) l USING (ruc)"""
FEEDS = dict(sanctions=SANCTIONS, penalties=PENALTIES, consortia=CONSORTIA, links=LINKS)


def _dossiers(t: Tables) -> DataFrame:
    return D.company_dossiers(t.sql(SANCTIONS), t.sql(PENALTIES), t.sql(CONSORTIA), t.sql(LINKS))


@query(DOSSIERS, **FEEDS)
def company_dossiers(t: Tables) -> DataFrame:
    return _dossiers(t)


@query("SELECT * FROM sanctions", sanctions=SANCTIONS)
def dossier_sanctions(t: Tables) -> DataFrame:
    return D.dossier_sanctions(t.sql(SANCTIONS))


REQUESTS = """
    SELECT CASE c_custkey % 3 WHEN 0 THEN chr(9) || lpad(CAST(c_custkey AS STRING), 11, '0') || ' '
        WHEN 1 THEN lpad(CAST(c_custkey AS STRING), 11, '0') ELSE CAST(c_custkey AS STRING) END AS ruc
    FROM {customer}"""


@query(
    """SELECT trim(r.ruc, ' ' || chr(9)) AS ruc, fup_url, nombre_empresa, total_sanciones, en_penalidades, total_penalidades,
        en_consorcios, total_consorcios, CASE WHEN length(trim(r.ruc, ' ' || chr(9))) <> 11 THEN 'invalid'
            WHEN d.ruc IS NOT NULL THEN 'found' ELSE 'not_found' END AS status
    FROM requests r LEFT JOIN dossiers d ON d.ruc = trim(r.ruc, ' ' || chr(9))""",
    **FEEDS,
    dossiers=DOSSIERS,
    requests=REQUESTS,
)
def dossier_requests(t: Tables) -> DataFrame:
    return D.requested_dossiers(t.sql(REQUESTS), _dossiers(t))


@query(
    """SELECT ruc_consorcio AS ruc, * FROM consortia
    UNION ALL SELECT ruc_miembro, * FROM consortia WHERE ruc_miembro <> ruc_consorcio""",
    consortia=CONSORTIA,
)
def consortium_roles(t: Tables) -> DataFrame:
    return D.consortium_roles(t.sql(CONSORTIA))


@query("SELECT * FROM dossiers WHERE ruc = lpad('7', 11, '0')", **FEEDS, dossiers=DOSSIERS)
def one_dossier(t: Tables) -> DataFrame:
    frames = [t.sql(text) for text in (SANCTIONS, PENALTIES, CONSORTIA, LINKS)]
    return D.company_dossier("00000000007", *frames)[0]


RANKED = f"""
    SELECT c_custkey, {pad('c_custkey', 8)} AS dni, c_name, c_acctbal FROM {{customer}}"""


def _ranked(t: Tables) -> DataFrame:
    return t.sql(RANKED).withColumn("global_id", P.global_id("dni", F.lit("")))


@query(f"SELECT *, {sql_uuid5('dni')} AS global_id FROM ranked ORDER BY global_id LIMIT 20 OFFSET 40", ranked=RANKED)
def page(t: Tables) -> DataFrame:
    return G.page(_ranked(t), "global_id", offset=40)


@query(
    f"""SELECT *, {sql_uuid5('dni')} AS global_id, 'page' AS kind FROM (SELECT * FROM ranked ORDER BY {sql_uuid5('dni')}
        LIMIT 20 OFFSET 40) p
    UNION ALL SELECT *, {sql_uuid5('dni')}, 'row' FROM ranked WHERE c_custkey = 42""",
    ranked=RANKED,
)
def page_layer(t: Tables) -> DataFrame:
    """A page and a row of a layer written in ranges of the key, as Gold is."""
    path = work_path(t.spark, "served")
    write_layer(_ranked(t), path, sort_by="global_id")
    layer = read_layer(t.spark, path)
    row = G.lookup(layer, "global_id", str(uuid5(UUID(IDENTITY_NAMESPACE), "00000042")))
    return G.page(layer, "global_id", offset=40).withColumn("kind", F.lit("page")).unionAll(
        row.withColumn("kind", F.lit("row"))
    )


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey DESC LIMIT 100 OFFSET 1100")
def deep_page(t: Tables) -> DataFrame:
    """A page far down, found by counting key ranges instead of holding all rows before it."""
    orders = t.orders.select("o_orderkey", "o_totalprice")
    return G.page(orders, "o_orderkey", limit=100, offset=1100, descending=True, shallow=200)


@query(
    """SELECT b.branch, p.k FROM (VALUES ('shallow'), ('deep')) b(branch),
        (SELECT k FROM keyed ORDER BY k DESC NULLS LAST LIMIT 60
         OFFSET (SELECT greatest(count(k) - 30, 0) FROM keyed)) p""",
    keyed="SELECT CASE WHEN o_orderkey % 3 <> 0 THEN o_orderkey END AS k FROM {orders}",
)
def page_null_keys(t: Tables) -> DataFrame:
    """The page where the keys end and the rows without one begin, found in both ways."""
    keyed = t.orders.select(F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderkey")).alias("k"))
    offset = max(keyed.where("k IS NOT NULL").count() - 30, 0)
    pages = {
        branch: G.page(keyed, "k", limit=60, offset=offset, descending=True, shallow=shallow)
        for branch, shallow in (("shallow", G.SHALLOW * 1000), ("deep", 200))
    }
    shallow, deep = (rows.select(F.lit(branch).alias("branch"), "k") for branch, rows in pages.items())
    return shallow.unionAll(deep)


@query(
    f"""SELECT *, {sql_uuid5('dni')} AS global_id FROM ranked WHERE {sql_uuid5('dni')} > '8'
    ORDER BY global_id LIMIT 50""",
    ranked=RANKED,
)
def page_after_key(t: Tables) -> DataFrame:
    return G.page_after(_ranked(t), "global_id", "8", limit=50)


@query(
    """SELECT count(*) AS total, CAST(100 AS BIGINT) AS "limit", CAST(900 AS BIGINT) AS "offset", 900 + 100 < count(*) AS has_next FROM customer"""
)
def page_envelope(t: Tables) -> DataFrame:
    return G.page_info(t.customer, limit=100, offset=900)


@query(f"SELECT *, {sql_uuid5('dni')} AS global_id FROM ranked WHERE {sql_uuid5('dni')} = {sql_uuid5("'00000042'")}",
       ranked=RANKED)
def lookup_by_id(t: Tables) -> DataFrame:
    wanted = str(uuid5(UUID(IDENTITY_NAMESPACE), "00000042"))
    return G.lookup(_ranked(t), "global_id", wanted)


@query(
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN '' WHEN o_orderstatus = 'O' THEN o_orderpriority
        ELSE o_orderpriority || ';' || o_orderstatus END AS risk_flags FROM orders"""
)
def response_rows(t: Tables) -> DataFrame:
    nested = F.array(
        F.array(F.col("o_orderpriority"), F.lit(None)),
        F.when(F.col("o_orderstatus") == "P", F.array("o_orderstatus")),
    )
    rows = t.orders.select("o_orderkey", F.when(F.col("o_orderstatus") != "F", nested).alias("risk_flags"))
    shaped = G.response_rows(rows, nested=True)
    return shaped.withColumn("risk_flags", F.array_join("risk_flags", ";"))
