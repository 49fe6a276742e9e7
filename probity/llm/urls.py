"""URL verdicts: host rules first, then a list of canonical URLs behind a blocked Bloom filter.

The filter is a table: a row per block with four 64-bit words, in each of which a URL sets
one bit. Pages probe their block; only possible hits go on to an exact join with the list,
which removes what the filter passed wrongly.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from probity.sources.layers import stage

from .common import lookup, lower_ascii

#: Bits of the filter per listed URL, and words of 64 bits per block.
BITS_PER_URL, WORDS = 16, 4
#: Query parameters that only track visits (fixed values).
TRACKING = ("utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content", "gclid", "fbclid", "ref")


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def rest(url: Column) -> Column:
    """What follows the first ``://``; empty for null and for anything without it."""
    return F.when(F.instr(url, "://") > 0, F.expr("substring(_url, instr(_url, '://') + 3)")).otherwise("")


def parts(pages: DataFrame, url_col: str) -> DataFrame:
    """Adds ``host``, ``path`` and ``canonical`` (null where there is no host) of a URL."""
    after = pages.withColumn("_url", F.col(url_col)).withColumn("_rest", rest(F.col("_url")))
    return (
        after.withColumn("host", lower_ascii(F.regexp_extract("_rest", r"^[^/?#]*", 0)))
        .withColumn("path", F.regexp_extract("_rest", r"^[^/?#]*([^?#]*)", 1))
        .withColumn("_query", F.regexp_extract("_rest", r"^[^?#]*\?([^#]*)", 1))
        .withColumn("canonical", canonical(F.col("host"), F.col("path"), F.col("_query")))
        .drop("_url", "_rest", "_query")
    )


def canonical(host: Column, path: Column, query: Column) -> Column:
    """One spelling per address: no scheme, ``www.``, default port, tracking or final slash."""
    name = F.regexp_replace(F.regexp_replace(host, r":(80|443)$", ""), r"^www\.", "")
    wanted = F.array_sort(
        F.filter(
            F.split(query, "&"), lambda p: (p != "") & ~F.substring_index(p, "=", 1).isin(*TRACKING)
        )
    )
    tail = F.when(F.size(wanted) > 0, F.concat(F.lit("?"), F.array_join(wanted, "&"))).otherwise("")
    return F.when(host != "", F.concat(name, F.regexp_replace(path, r"/+$", ""), tail))


def matching_rule(host: Column, path: Column, rules: list[Rule]) -> Column:
    """The longest rule that fits, as (rule, verdict); null if none does."""
    chosen = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: len(r.name)):
        fits = ((host == rule.host) | F.endswith(host, F.lit("." + rule.host))) & F.startswith(path, F.lit(rule.path))
        chosen = F.when(fits, F.struct(F.lit(rule.name).alias("rule"), F.lit(rule.verdict).alias("verdict"))).otherwise(
            chosen
        )
    return chosen


def bits(key: Column) -> list[Column]:
    """The bit a key sets in each word of its block."""
    return [F.expr(f"shiftleft(1L, cast(pmod(xxhash64({key}, {i}), 64) as int))") for i in range(WORDS)]


def bloom(listed: DataFrame, blocks: int) -> DataFrame:
    """The filter of a column ``canonical``: block number and its words."""
    marked = listed.select(
        F.expr(f"pmod(xxhash64(canonical), {blocks}L)").alias("block"),
        *(b.alias(f"b{i}") for i, b in enumerate(bits("canonical"))),
    )
    return marked.groupBy("block").agg(*(F.bit_or(f"b{i}").alias(f"w{i}") for i in range(WORDS)))


def judge(
    pages: DataFrame,
    listed: DataFrame,
    rules: list[Rule],
    id_col: str = "page_id",
    url_col: str = "url",
    listed_col: str = "url",
) -> DataFrame:
    """Per page: id, ``host``, ``path``, ``rule``, ``verdict``, ``listed``.

    The longest rule that fits decides; else a page is blocked if the canonical form of its
    URL is in the list. Null URLs and those without ``://`` have an empty host and path, fit
    no rule, are in no list, and are allowed. Repeated pages repeat, an empty list blocks
    nothing, an empty table gives an empty result; other columns are ignored.
    """
    wanted = stage(
        parts(listed.select(F.col(listed_col).alias("url")), "url").select("canonical").dropna().distinct(), "listed"
    )
    count = wanted.count()
    blocks = max(1, -(-count * BITS_PER_URL // (64 * WORDS)))
    table = bloom(wanted, blocks).withColumnRenamed("block", "_block")
    probing = parts(pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url")), "url").withColumn(
        "_at", F.expr(f"pmod(xxhash64(canonical), {blocks}L)")
    )
    set_in_all = F.lit(True)
    for i, bit in enumerate(bits("canonical")):
        set_in_all = set_in_all & (F.col(f"w{i}").bitwiseAND(bit) != 0)
    probed = probing.join(
        lookup(table, min(blocks, count), 8 * (WORDS + 2)), F.col("_at") == F.col("_block"), "left"
    ).withColumn("_possible", F.col("canonical").isNotNull() & F.coalesce(set_in_all, F.lit(False)))
    # pages that cannot be listed get keys of their own, so that they spread over the join
    own = F.concat(F.lit("\x00"), F.xxhash64("id", "host", "path").cast("string"))
    key = F.when(F.col("_possible"), F.col("canonical")).otherwise(own)
    exact = lookup(wanted.select(F.col("canonical").alias("_exact")), count, 120)
    return (
        probed.withColumn("_key", key)
        .join(exact, F.col("_key") == F.col("_exact"), "left")
        .withColumn("listed", F.col("_exact").isNotNull())
        .withColumn("_rule", matching_rule(F.col("host"), F.col("path"), rules))
        .select(
            F.col("id").alias(id_col),
            "host",
            "path",
            "_rule.rule",
            F.coalesce(F.col("_rule.verdict"), F.when(F.col("listed"), "block").otherwise("allow")).alias("verdict"),
            "listed",
        )
    )
