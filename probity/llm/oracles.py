"""DuckDB SQL for the results of the registered queries that SQL can express."""

from __future__ import annotations

from . import licenses

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

URL_PARTS = f"""
    SELECT id, url, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
           regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
           list_sort(list_filter(string_split(regexp_extract(rest, '^[^?#]*\\?([^#]*)', 1), '&'), lambda p: p <> ''
               AND split_part(p, '=', 1) NOT IN ('utm_source', 'utm_medium', 'utm_campaign', 'utm_term',
                                                 'utm_content', 'gclid', 'fbclid', 'ref'))) AS params
    FROM (SELECT page_id AS id, url, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3)
                                     ELSE '' END AS rest FROM pages)
"""

def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def license_sql() -> str:
    wanted = licenses.grams({label: phrase for phrase, label in licenses.BASE.items()}, True)
    wanted += licenses.grams(licenses.TEMPLATES, False)
    rows = ", ".join(f"({quoted(g.label)}, {g.exact}, {g.tpos}, {g.grams}, {quoted(g.gram)})" for g in wanted)
    sizes = ", ".join(str(k) for k in sorted({g.k for g in wanted}))
    return f"""
WITH templates(label, exact, tpos, grams, gram) AS (VALUES {rows}),
docs AS (
    SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
places AS (SELECT rid, w, unnest(range(len(w))) AS pos FROM docs),
texts AS (
    SELECT rid, pos, k || ' ' || array_to_string(w[pos + 1:pos + k], ' ') AS gram
    FROM places, (SELECT unnest([{sizes}]) AS k) WHERE pos + k <= len(w)),
votes AS (
    SELECT rid, label, exact, grams, pos - tpos AS diagonal, list(tpos) AS voted, min(pos) AS start
    FROM texts JOIN templates USING (gram) GROUP BY ALL),
marked AS (
    SELECT *, CASE WHEN exact OR diagonal - lag(diagonal) OVER near > {licenses.NEIGHBOUR}
                     OR lag(diagonal) OVER near IS NULL THEN 1 ELSE 0 END AS new
    FROM votes WINDOW near AS (PARTITION BY rid, label, exact ORDER BY diagonal)),
numbered AS (
    SELECT *, sum(new) OVER (PARTITION BY rid, label, exact ORDER BY diagonal) AS span FROM marked),
spans AS (
    SELECT rid, label, exact, len(list_distinct(flatten(list(voted)))) / grams AS share, min(start) AS start
    FROM numbered GROUP BY rid, label, exact, grams, span)
SELECT any_value(doc_id) AS doc_id, CAST(any_value(len(w)) AS BIGINT) AS n_words,
       count(*) FILTER (exact) AS n_base, min(start) FILTER (exact) AS first_word, max(start) FILTER (exact) AS last_word,
       coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (exact), '') AS base_labels,
       coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (exact OR share >= {licenses.SIMILAR}), '') AS labels,
       coalesce(max(share), 0.0)::DOUBLE AS score
FROM docs LEFT JOIN spans USING (rid) GROUP BY rid
"""


SQL = {
    "op5_license_scan": license_sql(),
    "op4_url_filter": f"""
WITH parts AS ({URL_PARTS}),
named AS (
    SELECT *, CASE WHEN host <> '' THEN regexp_replace(regexp_replace(host, ':(80|443)$', ''), '^www\\.', '')
        || regexp_replace(path, '/+$', '')
        || CASE WHEN len(params) > 0 THEN '?' || array_to_string(params, '&') ELSE '' END END AS canonical
    FROM parts),
listed AS (
    SELECT DISTINCT canonical FROM named
    WHERE id IN (SELECT doc_id FROM labels WHERE toxic = 1) AND canonical IS NOT NULL),
ruled AS (
    SELECT *, canonical IN (SELECT canonical FROM listed) IS TRUE AS listed,
        host = 'org' OR ends_with(host, '.org') AS org, host = 'com' OR ends_with(host, '.com') AS com,
        host = 'example.org' OR ends_with(host, '.example.org') AS eorg
    FROM named),
chosen AS (
    SELECT *, CASE WHEN eorg AND starts_with(path, '/en/1') THEN 'example.org/en/1'
        WHEN eorg AND starts_with(path, '/es/') THEN 'example.org/es/'
        WHEN com AND starts_with(path, '/fr/') THEN 'com/fr/'
        WHEN com AND starts_with(path, '/de/') THEN 'com/de/'
        WHEN org AND starts_with(path, '/') THEN 'org/' END AS rule
    FROM ruled)
SELECT id AS page_id, host, path, rule,
       CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
            WHEN listed THEN 'block' ELSE 'allow' END AS verdict, listed
FROM chosen
""",
    "op6_exact_dedup": f"""
WITH normal AS (
    SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS norm FROM documents),
ranked AS (
    SELECT doc_id, max(doc_id) OVER (PARTITION BY norm) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
           sha256(norm) AS text_sha256 FROM normal)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, text_sha256 FROM ranked
""",
    "op8_source_mix": """
WITH sized AS (
    SELECT doc_id, source, substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 12) AS hash,
           CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size
    FROM documents),
sources AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
ranked AS (
    SELECT *, [3.0, 1.0, 2.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3) + 1]::DOUBLE AS weight,
           2.0::DOUBLE * source_size AS cap FROM sources),
levels AS (
    SELECT *, 1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER before, 0) AS leftover,
           sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS open_weight
    FROM ranked
    WINDOW before AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
rate AS (
    SELECT leftover / open_weight AS rate FROM levels
    WHERE leftover / open_weight * weight < cap ORDER BY cap / weight LIMIT 1),
budgets AS (
    SELECT source, source_size, target, times, target - times * source_size AS budget FROM (
        SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS times FROM (
            SELECT source, source_size, least(cap, coalesce((SELECT rate FROM rate) * weight, cap)) AS target
            FROM levels))),
buckets AS (
    SELECT source, hash, sum(size) AS words, sum(sum(size)) OVER (PARTITION BY source ORDER BY hash) AS through
    FROM sized GROUP BY source, hash),
edges AS (
    SELECT b.source, min(hash) AS edge, arg_min(words, hash) AS words, arg_min(budget - (through - words), hash) AS leftover
    FROM buckets b JOIN budgets t ON b.source IS NOT DISTINCT FROM t.source WHERE through > budget GROUP BY b.source),
copies AS (
    SELECT s.doc_id, s.size, t.source_size, t.target, CAST(t.times + CASE WHEN s.hash < e.edge
               OR s.hash = e.edge AND e.words - e.leftover < e.leftover THEN 1 ELSE 0 END AS INTEGER) AS copies
    FROM sized s JOIN budgets t ON s.source IS NOT DISTINCT FROM t.source
    LEFT JOIN edges e ON s.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, source_size, target, CAST(copies * size AS BIGINT) AS taken, copies FROM copies
""",
    "op9_warc_fixity": """
WITH marked AS (
    SELECT page_id, substr(md5(CAST(page_id AS VARCHAR)), 1, 2) AS mark, CAST(octet_length(encode(
        'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10)
        || 'WARC-Record-ID: <urn:page:' || page_id || '>' || chr(13) || chr(10)
        || 'WARC-Date: 1970-01-01T00:00:00Z' || chr(13) || chr(10) || 'WARC-Target-URI: '
        || regexp_replace(coalesce(url, 'about:blank'), '[\r\n]+', ' ', 'g') || chr(13) || chr(10)
        || 'WARC-Block-Digest: sha256:' || sha256(coalesce(html, '')) || chr(13) || chr(10)
        || 'Content-Type: text/html' || chr(13) || chr(10)
        || 'Content-Length: ' || octet_length(encode(coalesce(html, ''))) || chr(13) || chr(10) || chr(13) || chr(10)
        || coalesce(html, ''))) AS BIGINT) AS length
    FROM pages)
SELECT page_id, CASE mark WHEN '07' THEN 'changed' WHEN 'a7' THEN 'missing' ELSE 'extra' END AS kind, length
FROM marked WHERE mark IN ('07', 'a7', 'f3')
""",
    "op11_line_dedup": rf"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
lines AS (
    SELECT rid, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS pos
    FROM docs),
keyed AS (
    SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{UPPER}', '{LOWER}') AS key
    FROM lines),
frequent AS (SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT rid) >= 10)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines,
       count(*) FILTER (f.key IS NOT NULL) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (f.key IS NULL), '')) AS kept_sha256
FROM docs JOIN keyed USING (rid) LEFT JOIN frequent f USING (key) GROUP BY rid
""",
    "op12_collocations": rf"""
WITH docs AS (
    SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS text FROM documents),
pieces AS (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM docs),
listed AS (SELECT row_number() OVER () AS pid, lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM listed GROUP BY lang),
starts AS (SELECT lang, w, unnest(range(len(w))) AS pos FROM listed),
grams AS (
    SELECT lang, size, array_to_string(w[pos + 1:pos + size], ' ') AS phrase, count(*) AS f
    FROM starts, (SELECT unnest([1, 2, 3, 4]) AS size) WHERE pos + size <= len(w)
    GROUP BY ALL HAVING count(*) >= 30),
candidates AS (SELECT lang, phrase, size, f AS a, string_split(phrase, ' ') AS w FROM grams WHERE size > 1),
cuts AS (
    SELECT lang, phrase, a, k, array_to_string(w[1:k], ' ') AS head, array_to_string(w[k + 1:], ' ') AS rest
    FROM (SELECT *, unnest(range(1, size)) AS k FROM candidates)),
scored AS (
    SELECT c.lang, c.phrase, c.a, c.k, l.f AS l, r.f AS r, (2000000::HUGEINT * c.a) // (l.f::HUGEINT + r.f) AS score
    FROM cuts c JOIN grams l ON c.lang = l.lang AND c.head = l.phrase JOIN grams r ON c.lang = r.lang AND c.rest = r.phrase),
best AS (
    SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_ones AS (
    SELECT lang, array_to_string(w[i + 1:i + width], ' ') AS phrase, max(a) AS longer
    FROM (SELECT *, unnest(range(size - width + 1)) AS i
          FROM candidates, (SELECT unnest([2, 3]) AS width) WHERE width < size)
    GROUP BY ALL),
kept AS (
    SELECT b.* FROM best b LEFT JOIN inner_ones USING (lang, phrase)
    WHERE longer IS NULL OR 100::HUGEINT * longer < 80::HUGEINT * a),
ranked AS (
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase,
           CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, n, CAST(score AS BIGINT) AS score
    FROM kept JOIN totals USING (lang))
SELECT * FROM ranked WHERE rank <= 2000
""",
}
