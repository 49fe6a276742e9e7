from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from probity import functions as P
from probity.functions.text import ACCENTED_VOWELS, LEGAL_FORMS, PLAIN_VOWELS
from probity.operators.conform import first_per_key, rename_fields, stack
from probity.operators.risk import add_plan_context
from probity.sources.layers import spread

from .registered import Tables, query

# White space as Unicode has it, for an engine whose \s is ASCII only.
SPACE = (
    r"[\t-\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
)


def sql_standard(text: str) -> str:
    folded = f"translate(coalesce({text}, ''), '{ACCENTED_VOWELS}', '{PLAIN_VOWELS}')"
    return f"trim(regexp_replace({folded}, '{SPACE}+', ' ', 'g'), ' ')"


def sql_upper(text: str) -> str:
    """Upper case with the full mapping of ß, which is SS."""
    return f"upper(replace({text}, 'ß', 'SS'))"


def sql_title(text: str) -> str:
    parts = rf"regexp_extract_all({text}, '[\p{{L}}\p{{N}}]+|[^\p{{L}}\p{{N}}]+')"
    return (
        f"coalesce(list_aggregate(list_transform({parts}, "
        f"lambda w: {sql_upper('w[1]')} || lower(w[2:])), 'string_agg', ''), '')"
    )


def sql_company(name: str) -> str:
    forms = "|".join(LEGAL_FORMS)
    plain = f"regexp_replace(upper({name}), '[.,;]', '', 'g')"
    bare = rf"regexp_replace({plain}, '\b({forms})\b', '', 'g')"
    return rf"trim(regexp_replace({bare}, '\s+', ' ', 'g'), ' ')"


def sql_uuid5(seed: str) -> str:
    digest = f"sha1(from_hex('ff87d41420d151d78722661d1863e10e') || encode({seed}))"
    return (
        f"substr({digest}, 1, 8) || '-' || substr({digest}, 9, 4) || '-5' || substr({digest}, 14, 3)"
        f" || '-' || translate(substr({digest}, 17, 1), '0123456789abcdef', '89ab89ab89ab89ab')"
        f" || substr({digest}, 18, 3) || '-' || substr({digest}, 21, 12)"
    )


CENTS = "CAST(floor(o_totalprice * 100 + 0.5) AS BIGINT)"
MONEY = f"""
    SELECT o_orderkey, cents,
        CASE o_orderkey % 5
            WHEN 0 THEN 'S/ ' || grouped_c || '.' || pence
            WHEN 1 THEN grouped_d || ',' || pence
            WHEN 2 THEN '$' || CAST(whole AS STRING)
            WHEN 3 THEN 'sin dato ' || o_orderpriority
        END AS amount
    FROM (
        SELECT o_orderkey, o_orderpriority, cents, whole,
            lpad(CAST(cents % 100 AS STRING), 2, '0') AS pence,
            CASE WHEN whole < 1000 THEN CAST(whole AS STRING)
                ELSE CAST(CAST(floor(whole / 1000) AS BIGINT) AS STRING) || ',' || lpad(CAST(whole % 1000 AS STRING), 3, '0')
            END AS grouped_c,
            CASE WHEN whole < 1000 THEN CAST(whole AS STRING)
                ELSE CAST(CAST(floor(whole / 1000) AS BIGINT) AS STRING) || '.' || lpad(CAST(whole % 1000 AS STRING), 3, '0')
            END AS grouped_d
        FROM (
            SELECT o_orderkey, o_orderpriority, {CENTS} AS cents,
                CAST(floor(CAST(floor(o_totalprice * 100 + 0.5) AS BIGINT) / 100) AS BIGINT) AS whole
            FROM {{orders}}
        ) a
    ) b"""


@query(
    r"""SELECT o_orderkey,
        coalesce(try_cast(replace(regexp_replace(regexp_replace(regexp_replace(coalesce(amount, '0'),
            '[^0-9.,]', '', 'g'), '\.([0-9]{3})(,|$)', '\1\2', 'g'), ',([0-9]{3})(\.|$)', '\1\2', 'g'),
            ',', '.') AS DOUBLE), 0.0) AS money,
        CASE o_orderkey % 5 WHEN 0 THEN cents / 100 WHEN 1 THEN cents / 100
            WHEN 2 THEN floor(cents / 100)
            WHEN 3 THEN CAST(substr(o_orderpriority_digit, 1, 1) AS DOUBLE) ELSE 0 END AS parsed
    FROM (SELECT *, regexp_extract(amount, '[0-9]') AS o_orderpriority_digit FROM money_text) m""",
    money_text=MONEY,
)
def clean_money(t: Tables) -> DataFrame:
    return t.sql(MONEY).select(
        "o_orderkey", P.clean_money("amount").alias("money"), P.parse_money("amount").alias("parsed")
    )


RAW_IDS = """
    SELECT c_custkey,
        CASE c_custkey % 4
            WHEN 0 THEN CAST(c_custkey AS STRING)
            WHEN 1 THEN CAST(c_custkey AS STRING) || '.0'
            WHEN 2 THEN '12' || lpad(CAST(c_custkey AS STRING), 8, '0')
        END AS raw_id,
        CASE c_custkey % 3
            WHEN 0 THEN ' 20-' || CAST(c_custkey AS STRING) || ' '
            WHEN 1 THEN '20' || lpad(CAST(c_custkey AS STRING), 9, '0')
        END AS raw_tax_id
    FROM {customer}"""


@query(
    r"""SELECT c_custkey, dni, ruc,
        regexp_full_match(dni, '[0-9]{8}') AS dni_ok,
        coalesce(regexp_full_match(trim(raw_tax_id), '[0-9]{11}'), FALSE) AS request_ok
    FROM (
        SELECT c_custkey, raw_tax_id,
            CASE WHEN length(d) < 8 THEN lpad(d, 8, '0') ELSE d END AS dni,
            CASE WHEN length(r) < 11 THEN lpad(r, 11, '0') ELSE r END AS ruc
        FROM (
            SELECT c_custkey, raw_tax_id, regexp_replace(coalesce(raw_id, ''), '\.0$', '') AS d,
                regexp_replace(raw_tax_id, '[^0-9]', '', 'g') AS r
            FROM raw_ids) a) b""",
    raw_ids=RAW_IDS,
)
def normalize_ids(t: Tables) -> DataFrame:
    return t.sql(RAW_IDS).select(
        "c_custkey",
        P.normalize_national_id("raw_id").alias("dni"),
        P.normalize_tax_id("raw_tax_id").alias("ruc"),
        P.is_national_id(P.normalize_national_id("raw_id")).alias("dni_ok"),
        P.is_tax_id("raw_tax_id").alias("request_ok"),
    )


@query(
    f"""SELECT doc_id, md5(standard) AS as_is, length(standard) AS n_chars,
        md5({sql_upper('standard')}) AS upper_case, md5({sql_title('standard')}) AS title_case
    FROM (SELECT doc_id, {sql_standard('text')} AS standard FROM documents) s"""
)
def standardize_text(t: Tables) -> DataFrame:
    return spread(t.documents).select(
        "doc_id",
        F.md5(P.standardize_text("text", "none")).alias("as_is"),
        F.length(P.standardize_text("text", "none")).cast("bigint").alias("n_chars"),
        F.md5(P.standardize_text("text", "upper")).alias("upper_case"),
        F.md5(P.standardize_text("text", "title")).alias("title_case"),
    )


NAMES = """
    SELECT p_partkey,
        CASE p_partkey % 3 WHEN 0 THEN 'o''' || p_name WHEN 1 THEN replace(p_name, ' ', '-') ELSE upper(p_name) END
        AS name
    FROM {part}"""


@query(f"SELECT p_partkey, {sql_title('name')} AS title FROM names", names=NAMES)
def title_case(t: Tables) -> DataFrame:
    return t.sql(NAMES).select("p_partkey", P.title_case("name").alias("title"))


COMPANIES = """
    SELECT p_partkey,
        CASE p_partkey % 6
            WHEN 0 THEN p_name || ' S.A.C.'
            WHEN 1 THEN p_name || ', SA'
            WHEN 2 THEN ' ' || p_name || '  E.I.R.L.; '
            WHEN 3 THEN p_name || ' s c r l'
            WHEN 4 THEN 'Santa ' || p_name || ' SRLTDA'
        END AS company
    FROM {part}"""


@query(f"SELECT p_partkey, {sql_company('company')} AS norm FROM companies", companies=COMPANIES)
def company_names(t: Tables) -> DataFrame:
    return t.sql(COMPANIES).select("p_partkey", P.normalize_company("company").alias("norm"))


PEOPLE_KEYS = """
    SELECT c_custkey,
        CASE WHEN c_custkey % 3 = 0 THEN lpad(CAST(c_custkey AS STRING), 8, '0') ELSE CAST(c_custkey AS STRING) END
            AS dni,
        CASE WHEN c_custkey % 5 = 0 THEN ' Ñandú  Pérez ' || c_name ELSE c_name END AS name,
        c_mktsegment
    FROM {customer}"""


@query(
    f"""SELECT c_custkey, natural_key, {sql_uuid5(
        "CASE WHEN regexp_full_match(dni, '[0-9]{8}') THEN dni ELSE natural_key END")} AS global_id
    FROM (SELECT c_custkey, dni, lower({sql_standard('name')}) || '|' || lower({sql_standard('c_mktsegment')}) || '|'
        AS natural_key FROM people_keys) k""",
    people_keys=PEOPLE_KEYS,
)
def global_ids(t: Tables) -> DataFrame:
    key = P.natural_key(P.flat_name("name"), P.flat_name("c_mktsegment"), F.lit(None).cast("string"))
    return t.sql(PEOPLE_KEYS).select(
        "c_custkey", key.alias("natural_key"), P.global_id("dni", key).alias("global_id")
    )


@query(
    """SELECT doc_id, CAST(coalesce(len(items), 0) AS BIGINT) AS n_items,
        coalesce(list_sum(list_transform(items, lambda i: coalesce(try_cast(i.amount AS DOUBLE), 0))), 0.0) AS total,
        CAST(coalesce(list_sum(list_transform(items, lambda i:
            CASE WHEN upper(i.sector) LIKE '%PUBLICO%' THEN
                CASE WHEN i.years IS NULL THEN 1 WHEN i.years = '3.7' THEN 0 ELSE CAST(i.years AS BIGINT) END
            ELSE 0 END)), 0) AS BIGINT) AS experience,
        coalesce(list_sum(list_transform(items, lambda i: coalesce(try_cast(i.amount AS DOUBLE), 0))), 0.0)
            + coalesce(CAST(n_chars AS DOUBLE), 0.0) AS across
    FROM (
        SELECT doc_id, n_chars, CASE WHEN lang <> 'de' THEN list_transform(string_split(text, chr(10)), lambda l: {
            'sector': CASE WHEN l LIKE '%th%' THEN 'Sector Publico' WHEN l LIKE '%e%' THEN 'Privado' END,
            'years': CASE length(l) % 4 WHEN 0 THEN NULL WHEN 1 THEN '3.7' ELSE CAST(length(l) % 30 AS VARCHAR) END,
            'amount': CASE length(l) % 3 WHEN 0 THEN 'n/a' ELSE CAST(length(l) AS VARCHAR) || '.5' END}) END AS items
        FROM documents) d"""
)
def list_measures(t: Tables) -> DataFrame:
    def item(line):
        size = F.length(line)
        return F.struct(
            F.when(F.contains(line, F.lit("th")), F.lit("Sector Publico"))
            .when(F.contains(line, F.lit("e")), F.lit("Privado"))
            .alias("sector"),
            F.when(size % 4 == 0, F.lit(None))
            .when(size % 4 == 1, F.lit("3.7"))
            .otherwise((size % 30).cast("string"))
            .alias("years"),
            F.when(size % 3 == 0, F.lit("n/a"))
            .otherwise(F.concat(size.cast("string"), F.lit(".5")))
            .alias("amount"),
        )

    lines = F.when(F.col("lang") != "de", F.transform(F.split("text", "\n"), item))
    total = P.list_sum("items", "amount")
    return t.documents.select("doc_id", "n_chars", lines.alias("items")).select(
        "doc_id",
        P.list_count("items").alias("n_items"),
        total.alias("total"),
        P.public_experience("items", "sector", "years").alias("experience"),
        P.sum_across(total, F.col("n_chars").cast("double")).alias("across"),
    )


@query(
    """SELECT CAST(c_custkey AS VARCHAR) AS dni, c_name AS nombres, CAST(NULL AS VARCHAR) AS cargo,
        c_acctbal AS ingresos_totales, 'customer' AS source_category FROM customer
    UNION ALL SELECT CAST(s_suppkey AS VARCHAR), s_name, NULL, s_acctbal, 'supplier' FROM supplier
    UNION ALL SELECT CAST(n_nationkey AS VARCHAR), n_name, 'nation', NULL, 'nation' FROM nation"""
)
def conform_and_stack(t: Tables) -> DataFrame:
    def conformed(df: DataFrame, key: str, name: str, balance: str, category: str) -> DataFrame:
        texts = rename_fields(df, {key: "dni", name: "nombres", "no_such_field": "cargo"})
        numbers = rename_fields(df, {balance: "ingresos_totales"}, "double")
        return df.select(*texts, *numbers, F.lit(category).alias("source_category"))

    people = stack(
        [
            conformed(t.customer, "c_custkey", "c_name", "c_acctbal", "customer"),
            conformed(t.supplier, "s_suppkey", "s_name", "s_acctbal", "supplier"),
        ]
    )
    nations = t.nation.select(
        F.col("n_nationkey").cast("string").alias("dni"),
        F.col("n_name").alias("nombres"),
        F.lit("nation").alias("cargo"),
        F.lit("nation").alias("source_category"),
    )
    return stack([people, nations], "diagonal")


@query(
    """SELECT o_custkey, o_orderpriority, o_orderkey, o_totalprice FROM (
        SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_totalprice, o_orderkey) AS k
        FROM orders) o WHERE k = 1"""
)
def first_order_per_key(t: Tables) -> DataFrame:
    orders = t.orders.select("o_custkey", "o_orderpriority", "o_orderkey", "o_totalprice")
    return first_per_key(orders, ["o_custkey", "o_orderpriority"], ["o_totalprice"])


PLAN_ROWS = """
    SELECT s_nationkey AS id_organizacion_politica, s_name AS dimension_social,
        CASE WHEN s_suppkey % 2 = 0 THEN 'economia ' || s_name END AS dimension_economica,
        CAST(NULL AS STRING) AS dimension_ambiental, 'institucional' AS dimension_institucional
    FROM {supplier}"""


@query(
    """SELECT c_custkey, search_context FROM customer LEFT JOIN (
        SELECT id_organizacion_politica, min(coalesce(dimension_social, '') || ' ' || chr(10) || ' '
            || coalesce(dimension_economica, '') || ' ' || chr(10) || ' ' || coalesce(dimension_ambiental, '')
            || ' ' || chr(10) || ' ' || coalesce(dimension_institucional, '')) AS search_context
        FROM plan_rows GROUP BY 1) p ON c_nationkey = id_organizacion_politica""",
    plan_rows=PLAN_ROWS,
)
def plan_context(t: Tables) -> DataFrame:
    people = t.customer.select("c_custkey", F.col("c_nationkey").alias("id_organizacion_politica"))
    return add_plan_context(people, t.sql(PLAN_ROWS)).select("c_custkey", "search_context")
