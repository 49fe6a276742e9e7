from __future__ import annotations

from pyspark.sql import DataFrame

from probity.operators import identities as I
from probity.operators.reports import canonical_identities

from .registered import Tables, query

# Every part is a person who is on record twice, under two ids and in two spellings; some share a
# document with a neighbour, and brand and size stand for the birth date.
RECORDS = """
    SELECT 'a' || CAST(p_partkey AS STRING) AS global_id,
        CASE WHEN p_partkey % 7 < 2 THEN CAST(floor(p_partkey / 7) AS STRING) ELSE ' ' END AS dni,
        upper(p_name) || ' ' || p_type || ' ' || p_brand AS name,
        CASE WHEN p_partkey % 11 <> 4 THEN p_brand || '-' || CAST(p_size AS STRING) END AS born
    FROM {part}
    UNION ALL
    SELECT 'b' || CAST(p_partkey AS STRING), CASE WHEN p_partkey % 3 = 0 THEN 'b' || CAST(p_partkey % 60 AS STRING) END,
        replace(upper(p_name), 'L', 'LL') || ' ' || p_type || ' ' || p_brand, p_brand || '-' || CAST(p_size AS STRING)
    FROM {part} WHERE p_partkey % 5 <> 1"""
LINKS = """
    SELECT a.global_id AS a, b.global_id AS b FROM records a JOIN records b ON a.dni = b.dni AND trim(a.dni) <> ''
    UNION SELECT a.global_id, b.global_id FROM records a JOIN records b ON a.born = b.born
        AND (a.name = b.name OR greatest(round(jaro_winkler_similarity(a.name, b.name), 12),
            round(jaro_winkler_similarity(b.name, a.name), 12)) >= 0.96)"""
# Labels go from neighbour to neighbour until every record has met the least of its component.
IDENTITIES = """
    SELECT global_id, min(label) AS identity_id FROM (
        WITH RECURSIVE met(global_id, label) AS (
            SELECT global_id, global_id FROM records
            UNION SELECT l.a, m.label FROM links l JOIN met m ON l.b = m.global_id)
        SELECT * FROM met) x GROUP BY global_id"""


def _resolved(t: Tables) -> DataFrame:
    return I.resolve_identities(t.sql(RECORDS), exact=[["dni"]], name="name", within=["born"], threshold=0.96)


@query("SELECT * FROM identities", records=RECORDS, links=LINKS, identities=IDENTITIES)
def resolved_identities(t: Tables) -> DataFrame:
    """Spellings and documents tie ids together, over any number of steps."""
    return _resolved(t)


@query(
    """SELECT identity_id, name, variants, occurrences FROM (
        SELECT identity_id, name, count(*) OVER w AS variants, CAST(sum(n) OVER w AS BIGINT) AS occurrences,
            row_number() OVER (PARTITION BY identity_id ORDER BY n DESC, name) AS k
        FROM (SELECT identity_id, name, count(*) AS n FROM records JOIN identities USING (global_id) GROUP BY 1, 2) v
        WINDOW w AS (PARTITION BY identity_id)) x WHERE k = 1""",
    records=RECORDS,
    links=LINKS,
    identities=IDENTITIES,
)
def names_of_identities(t: Tables) -> DataFrame:
    """One spelling per person, though the spellings came under different ids."""
    found = I.with_identity(t.sql(RECORDS), _resolved(t))
    return canonical_identities(found, ["name"], "identity_id")


@query(
    """SELECT node, min(label) AS component FROM (
        WITH RECURSIVE pairs AS (
            SELECT o_custkey AS a, o_custkey % 400 * 3 AS b FROM orders
            UNION SELECT l_suppkey, l_suppkey - 1 FROM lineitem WHERE l_suppkey % 13 <> 0),
        both_ways AS (SELECT a, b FROM pairs UNION SELECT b, a FROM pairs),
        met(node, label) AS (
            SELECT a, a FROM both_ways UNION SELECT w.a, m.label FROM both_ways w JOIN met m ON w.b = m.node)
        SELECT * FROM met) x GROUP BY node"""
)
def linked_components(t: Tables) -> DataFrame:
    """Components of raw links with many copies: stars around some keys, chains along others."""
    pairs = t.sql(
        """SELECT o_custkey AS a, o_custkey % 400 * 3 AS b FROM {orders}
        UNION ALL SELECT l_suppkey, l_suppkey - 1 FROM {lineitem} WHERE l_suppkey % 13 <> 0"""
    )
    return I.connected(pairs)
