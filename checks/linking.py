from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from probity import functions as P
from probity.operators import linking as L
from probity.operators.fuzzy import best_matches

from .cleaning import sql_company, sql_upper, sql_uuid5
from .registered import Tables, query
from .sources import pad

# Roles: a customer is a person, a supplier a company, a purchase the link between them.
PEOPLE = f"SELECT {pad('c_custkey', 8)} AS dni, c_custkey, c_name, c_nationkey FROM {{customer}}"
COMPANY_LINKS = f"""
    SELECT DISTINCT {pad('o_custkey', 8)} AS numero_documento, {pad('l_suppkey')} AS ruc,
        'proveedor ' || CAST(l_suppkey AS STRING) AS nombre_empresa
    FROM {{orders}} JOIN {{lineitem}} ON o_orderkey = l_orderkey"""
SANCTIONS = f"""
    SELECT {pad('s_suppkey')} AS ruc, s_name AS nombre_empresa,
        CASE s_suppkey % 3 WHEN 0 THEN 'INHABILITACION' WHEN 1 THEN 'MULTA' ELSE 'INHABILITACION_JUDICIAL' END
        AS tipo_sancion
    FROM {{supplier}} WHERE s_acctbal < 2000
    UNION ALL SELECT {pad('s_suppkey')}, s_name || ' bis', 'MULTA' FROM {{supplier}} WHERE s_acctbal < 0"""

# Companies named after parts: clean in the registry, misspelt in the claims.
PART_SANCTIONS = f"""
    SELECT {pad('p_partkey')} AS ruc, p_name || ' S.R.L.' AS nombre_empresa,
        CASE p_partkey % 2 WHEN 0 THEN 'MULTA' ELSE 'INHABILITACION' END AS tipo_sancion FROM {{part}}"""
CLAIMS = """
    SELECT CAST(p_partkey AS STRING) AS global_id,
        CASE p_partkey % 6
            WHEN 0 THEN p_name
            WHEN 1 THEN replace(p_name, 'l', 'll') || ' S.A.C.'
            WHEN 2 THEN substr(p_name, 2)
            WHEN 3 THEN replace(p_name, 'o', 'u')
            WHEN 4 THEN p_name || ' ' || p_type
        END AS empresa_candidato
    FROM {part}"""

# Every line links some document to its supplier; parts often taken back in bulk are people,
# the other documents are nobody's, so that people are left for the fuzzy phase.
PURCHASES = f"""
    SELECT {pad("l_partkey + CASE WHEN l_returnflag = 'A' AND l_quantity > 45 THEN 0 ELSE 10000000 END", 8)}
        AS numero_documento, {pad('l_suppkey')} AS ruc, 'proveedor ' || l_linestatus AS nombre_empresa
    FROM {{lineitem}}"""

FUZZY_FOUND = f"""
    SELECT name, match, score FROM (
        SELECT c.name, r.name AS match, round(jaro_winkler_similarity(c.name, r.name), 12) AS score,
            row_number() OVER (PARTITION BY c.name
                ORDER BY round(jaro_winkler_similarity(c.name, r.name), 12) DESC, r.name) AS k
        FROM (SELECT DISTINCT {sql_company('empresa_candidato')} AS name FROM claims
            WHERE empresa_candidato IS NOT NULL) c,
            (SELECT DISTINCT {sql_company('nombre_empresa')} AS name FROM sanctions) r
        WHERE length(c.name) >= 3 AND round(jaro_winkler_similarity(c.name, r.name), 12) >= 0.92) s
    WHERE k = 1"""
FUZZY_LINKS = f"""
    SELECT DISTINCT global_id, empresa_candidato, r.nombre_empresa AS osce_sancionada_match,
        score AS osce_match_score, r.ruc AS ruc_sancionado, r.tipo_sancion, 'FUZZY' AS osce_match_method,
        'https://apps.osce.gob.pe/perfilprov-ui/ficha/' || r.ruc AS fup_url
    FROM claims JOIN fuzzy_found f ON f.name = {sql_company('empresa_candidato')}
    JOIN (SELECT *, row_number() OVER (PARTITION BY norm ORDER BY ruc, nombre_empresa, tipo_sancion) AS k
        FROM (SELECT *, {sql_company('nombre_empresa')} AS norm FROM sanctions) n) r ON r.norm = f.match AND r.k = 1"""
EXACT_LINKS = f"""
    SELECT DISTINCT {sql_uuid5('p.dni')} AS global_id, b.nombre_empresa AS empresa_candidato,
        s.nombre_empresa AS osce_sancionada_match, 1e0 AS osce_match_score, s.ruc AS ruc_sancionado, s.tipo_sancion,
        'DETERMINISTIC' AS osce_match_method, 'https://apps.osce.gob.pe/perfilprov-ui/ficha/' || s.ruc AS fup_url
    FROM people p JOIN company_links b ON p.dni = b.numero_documento
    JOIN sanctions s ON s.ruc = b.ruc AND s.ruc <> lpad('0', 11, '0')"""


def people(t: Tables) -> DataFrame:
    return t.sql(PEOPLE).withColumn("global_id", P.global_id("dni", F.lit("")))


def registry(t: Tables, text: str) -> DataFrame:
    return t.sql(text).withColumn("nombre_empresa_norm", P.normalize_company("nombre_empresa"))


@query("SELECT * FROM exact_links", people=PEOPLE, company_links=COMPANY_LINKS, sanctions=SANCTIONS,
       exact_links=EXACT_LINKS)
def deterministic_links(t: Tables) -> DataFrame:
    return L.deterministic_links(people(t), t.sql(COMPANY_LINKS), registry(t, SANCTIONS))


@query("SELECT * FROM fuzzy_links", claims=CLAIMS, sanctions=PART_SANCTIONS, fuzzy_found=FUZZY_FOUND,
       fuzzy_links=FUZZY_LINKS)
def fuzzy_links(t: Tables) -> DataFrame:
    return L.fuzzy_links(t.sql(CLAIMS), registry(t, PART_SANCTIONS))


@query(
    """SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS global_id, 'e' || CAST(o_custkey % 5 AS VARCHAR) AS empresa_candidato,
        s_name AS osce_sancionada_match, lpad(CAST(s_suppkey AS VARCHAR), 11, '0') AS ruc_sancionado
    FROM orders JOIN supplier ON o_custkey % 50 + 1 = s_suppkey WHERE s_suppkey % 4 <> 0"""
)
def links_of_damaged_ids(t: Tables) -> DataFrame:
    """Link files that lost leading zeros and hold junk tax ids find all true links and no other."""
    orders = t.orders
    owners = orders.select(
        F.col("o_custkey").cast("string").alias("global_id"), F.lpad(F.col("o_custkey").cast("string"), 8, "0").alias("dni")
    )
    company = F.col("o_custkey") % 50 + 1
    links = orders.select(
        F.concat(F.lit("\t"), F.col("o_custkey").cast("string"), F.lit(" ")).alias("numero_documento"),
        P.normalize_tax_id(F.when(company % 4 == 0, "S/N").otherwise(company.cast("string"))).alias("ruc"),
        F.concat(F.lit("e"), (F.col("o_custkey") % 5).cast("string")).alias("nombre_empresa"),
    )
    number = F.col("s_suppkey")
    sanctions = t.supplier.select(
        P.normalize_tax_id(F.when(number % 4 == 0, "-").otherwise(number.cast("string"))).alias("ruc"),
        F.col("s_name").alias("nombre_empresa"),
        F.lit("MULTA").alias("tipo_sancion"),
    )
    found = L.deterministic_links(owners, links, sanctions)
    return found.select("global_id", "empresa_candidato", "osce_sancionada_match", "ruc_sancionado")


def _words(t: Tables, table: str) -> DataFrame:
    words = F.explode(F.split(F.upper("text"), "[^A-Z]+"))
    return getattr(t, table).select(words.alias("name"))


def _vocabulary(threshold: str) -> str:
    return f"""SELECT name, match, score FROM (
        SELECT q.name, r.name AS match, round(jaro_winkler_similarity(q.name, r.name), 12) AS score,
            row_number() OVER (PARTITION BY q.name
                ORDER BY round(jaro_winkler_similarity(q.name, r.name), 12) DESC, r.name) AS k
        FROM (SELECT DISTINCT unnest(regexp_split_to_array({sql_upper('text')}, '[^A-Z]+')) AS name
                FROM conversations) q,
            (SELECT DISTINCT unnest(regexp_split_to_array({sql_upper('text')}, '[^A-Z]+')) AS name
                FROM benchmark) r
        WHERE length(q.name) >= 3 AND length(r.name) > 0
            AND round(jaro_winkler_similarity(q.name, r.name), 12) >= {threshold}) s
    WHERE k = 1"""


@query(_vocabulary("0.92"))
def fuzzy_vocabulary(t: Tables) -> DataFrame:
    """Every word of the conversations against every word of the benchmark texts."""
    return best_matches(_words(t, "conversations"), _words(t, "benchmark"))


@query(_vocabulary("0.92"))
def fuzzy_vocabulary_keyed(t: Tables) -> DataFrame:
    """The same as for a registry too large to send to all tasks, in small cells."""
    return best_matches(_words(t, "conversations"), _words(t, "benchmark"), broadcast_names=0, cell_rows=500)


@query(_vocabulary("0.8"))
def fuzzy_vocabulary_low(t: Tables) -> DataFrame:
    return best_matches(_words(t, "conversations"), _words(t, "benchmark"), threshold=0.8)


@query(
    """SELECT * FROM exact_links UNION ALL SELECT * FROM fuzzy_links""",
    company_links=f"""
        SELECT numero_documento, ruc, min(nombre_empresa) AS nombre_empresa FROM ({PURCHASES}) x GROUP BY 1, 2""",
    sanctions=f"""{SANCTIONS} UNION ALL {PART_SANCTIONS}""",
    all_claims=f"SELECT global_id, lpad(global_id, 8, '0') AS dni, empresa_candidato FROM ({CLAIMS}) c",
    exact_links=EXACT_LINKS.replace(sql_uuid5("p.dni"), "p.global_id").replace("FROM people p", "FROM all_claims p"),
    claims="SELECT * FROM all_claims WHERE global_id NOT IN (SELECT global_id FROM exact_links)",
    fuzzy_found=FUZZY_FOUND,
    fuzzy_links=FUZZY_LINKS,
)
def two_phase_links(t: Tables) -> DataFrame:
    return L.company_matches(_claimants(t), _purchases(t), registry(t, f"{SANCTIONS} UNION ALL {PART_SANCTIONS}"))


def _claimants(t: Tables) -> DataFrame:
    return t.sql(CLAIMS).withColumn("dni", F.lpad("global_id", 8, "0"))


def _purchases(t: Tables) -> DataFrame:
    return t.sql(
        f"""SELECT numero_documento, ruc, min(nombre_empresa) AS nombre_empresa FROM ({PURCHASES}) x GROUP BY 1, 2"""
    )


@query(
    f"""SELECT c_custkey, {sql_uuid5('p.dni')} AS global_id, osce_match_score, ruc_sancionado, fup_url,
        osce_match_method, osce_sancionada_match
    FROM people p LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY global_id ORDER BY osce_match_score DESC,
        osce_match_method, ruc_sancionado, osce_sancionada_match) AS k FROM exact_links) b
        ON b.global_id = {sql_uuid5('p.dni')} AND k = 1""",
    people=PEOPLE,
    company_links=COMPANY_LINKS,
    sanctions=SANCTIONS,
    exact_links=EXACT_LINKS,
)
def best_link_per_person(t: Tables) -> DataFrame:
    linked = L.link_companies(people(t), t.sql(COMPANY_LINKS), registry(t, SANCTIONS))
    return linked.select("c_custkey", "global_id", *L.LINK_COLUMNS)


@query(
    """SELECT CAST(o_orderkey AS VARCHAR) AS global_id, unnest([o_orderstatus || ' SAC', o_orderpriority]) AS empresa_candidato
    FROM orders WHERE o_orderstatus <> 'F'
    UNION ALL SELECT CAST(o_orderkey AS VARCHAR), NULL FROM orders WHERE o_orderstatus = 'F'"""
)
def company_claims(t: Tables) -> DataFrame:
    """Lists of claimed companies unfolded; people without one keep a row."""
    claims = F.array(
        F.struct(F.concat("o_orderstatus", F.lit(" SAC")).alias("empresa")),
        F.struct(F.col("o_orderpriority").alias("empresa")),
    )
    owners = t.orders.select(
        F.col("o_orderkey").cast("string").alias("global_id"),
        F.when(F.col("o_orderstatus") != "F", claims).alias("titularidad"),
    )
    return L.company_claims(owners)
