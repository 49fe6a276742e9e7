"""The registered queries of this subpackage and the SQL each must equal."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from probity.sources.layers import work_path

from . import (
    alignment,
    decontamination,
    exact_dedup,
    language,
    licenses,
    line_dedup,
    mixing,
    phrases,
    repeats,
    simhash,
    tokens,
    urls,
    warc,
)
from .oracles import SQL

RULES = [
    urls.Rule("allow", "org", "/"),
    urls.Rule("block", "example.org", "/es/"),
    urls.Rule("block", "example.org", "/en/1"),
    urls.Rule("allow", "com", "/fr/"),
    urls.Rule("block", "com", "/de/"),
]


#: The tokenizer of the token queries, by the name that the public collection knows it by.
TOKENIZER, VOCABULARY, END = "byte_bpe_50k.json", 50_257, 2
#: The other tokenizer that it is aligned with.
PIECES = "piece_bpe_32k.model"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def held_out(docs: DataFrame) -> DataFrame:
    fold = F.crc32(F.col("doc_id").cast("string")) % 4
    return docs.withColumn("held_out", F.coalesce(fold == 2, F.lit(False)))


def op1_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Learns from the documents outside the held-out fold and labels all."""
    docs = held_out(table(spark, folder, "documents").select("doc_id", "text", "lang"))
    model = language.train(docs.where("NOT held_out AND doc_id IS NOT NULL"))
    return docs.select("doc_id", "held_out", language.found(F.col("text"), model).alias("f")).select(
        "doc_id", "held_out", "f.lang_pred", "f.score", F.size("f.spans").alias("n_spans")
    )


def op2_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Every benchmark item found in a document."""
    return decontamination.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark")).drop(
        "text_key"
    )


def op3_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


def op4_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Verdicts on all pages; listed are the URLs of pages whose id is labelled toxic."""
    pages = table(spark, folder, "pages")
    toxic = table(spark, folder, "labels").where("toxic = 1").select("doc_id").distinct()
    listed = pages.join(toxic, F.col("page_id") == F.col("doc_id"), "left_semi").select("url")
    return urls.judge(pages, listed, RULES)


def op5_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(table(spark, folder, "documents"))


def op6_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, folder, "documents"))


def op7_repeated_passages(spark: SparkSession, folder: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, folder, "documents")).drop("kept")


def op8_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents"))


def damaged(records: DataFrame) -> DataFrame:
    """What became of an archive elsewhere: records changed, lost, or written twice, by page id."""
    mark = F.substring(F.md5(F.regexp_extract(F.col("name"), r"(\d+)$", 1)), 1, 2)
    text = F.col("value").cast("string")
    worse = F.when(mark == "07", F.replace(text, F.lit("WARC-Date: 1970"), F.lit("WARC-Date: 1971"))).otherwise(text)
    times = F.when(mark == "a7", 0).when(mark == "f3", 2).otherwise(1)
    return records.select("file", "seq", worse.alias("value"), F.explode(F.array_repeat(F.lit(0), times))).drop("col")


def op9_warc_fixity(spark: SparkSession, folder: str) -> DataFrame:
    """All pages as an archive, and as a replica with planted damage; what the audit finds."""
    here, there = work_path(spark, "archive"), work_path(spark, "replica")
    warc.write_archive(table(spark, folder, "pages"), here)
    warc.write_records(damaged(warc.read_archive(spark, here)), there, "seq")
    found = warc.audit(warc.read_archive(spark, here), warc.read_archive(spark, there))
    return found.select(F.regexp_extract("name", r"(\d+)$", 1).cast("long").alias("page_id"), "kind", "length")


def op10_token_ids(spark: SparkSession, folder: str) -> DataFrame:
    return tokens.encoded(table(spark, folder, "documents"), tokenizer_path(), VOCABULARY, END)


def op11_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every line that ten documents share goes, in all of them."""
    found = line_dedup.deduplicated_lines(table(spark, folder, "documents"), min_docs=10, least=1)
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op12_collocations(spark: SparkSession, folder: str) -> DataFrame:
    """The first 2,000 phrases of each language that occur 30 times or more."""
    return phrases.collocations(table(spark, folder, "documents"), min_count=30, first=2000)


def op13_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.alignments(table(spark, folder, "documents"), tokenizer_path(), tokenizer_path(PIECES))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_language_id,
        op2_decontamination,
        op3_simhash,
        op4_url_filter,
        op5_license_scan,
        op6_exact_dedup,
        op7_repeated_passages,
        op8_source_mix,
        op9_warc_fixity,
        op10_token_ids,
        op11_line_dedup,
        op12_collocations,
        op13_token_alignment,
    )
}
ORACLES: dict[str, str] = {name: sql for name, sql in SQL.items() if name in QUERIES}
