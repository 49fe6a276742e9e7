"""The registered queries next to their SQL, and the pipeline next to a plain version of it."""

from __future__ import annotations

import re

import duckdb
import pytest
from test_overlap import brute_kept
from test_python import brute_tokens

import __spark_entry__ as contract
import corpus_pipeline
from check import difference, normal, type_difference
from checks.registered import TABLES
from probity.llm import mixing, queries, tokens


@pytest.fixture(scope="module")
def db(folder):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_query(spark, folder, db, name):
    result = contract.queries()[name](spark, folder)
    sql = contract.oracle_sql()[name]
    assert difference(normal(result.toPandas()), normal(db.execute(sql).fetchdf())) is None
    assert type_difference(db, sql, result) is None


def test_all_are_registered():
    named = contract.queries()
    assert {n for n in named if re.match(r"op\d+_", n)} == set(queries.QUERIES)
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in queries.QUERIES) == list(range(1, 14))
    assert named["pipeline"] is corpus_pipeline.run


def test_pipeline_stage_by_stage(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    empty = spark.createDataFrame([(9_000_001, None, "en", "src0", 0), (9_000_002, "12 .", None, None, 4)], docs.schema)
    docs = docs.union(empty)
    items = [" ".join(re.findall(r"\w+", r.text.lower())) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    steps = dict(corpus_pipeline.STAGES)
    rows = {r.doc_id: r for r in docs.collect()}

    def keep(name, df):
        out = steps[name](spark, df, folder)
        assert name == "token_ids" or out.columns == docs.columns
        out.write.parquet(path := str(tmp_path / name))
        return spark.read.parquet(path)

    named = keep("language_id", docs)
    ids = {r.doc_id for r in named.collect()}
    assert ids == {i for i, r in rows.items() if re.search(r"[^\W\d_]", r.text or "")}

    single = keep("simhash_near_dedup", named)
    want = set(brute_kept([(i, rows[i].text) for i in sorted(ids)]))
    assert sorted(r.doc_id for r in single.collect()) == sorted(want)

    clean = keep("benchmark_decontamination", single)
    left = {r.doc_id for r in clean.collect()}
    holds = {i for i in want if any(f" {t} " in f" {' '.join(re.findall(r'\w+', rows[i].text.lower()))} " for t in items)}
    assert left <= want - holds and len(want - holds - left) <= 0.02 * len(want)

    mixture = keep("source_mixing", clean)
    copies = {r.doc_id: r.copies for r in mixing.mix(clean).collect()}
    mixed_ids = [r.doc_id for r in mixture.collect()]
    assert sorted(mixed_ids) == sorted(i for i, c in copies.items() for _ in range(c))

    packed = keep("token_ids", mixture)
    encoder = tokens.Encoder(queries.tokenizer_path())
    assert sorted(map(tuple, packed.collect()), key=lambda r: r[1]) == brute_tokens(
        encoder, [(i, rows[i].text) for i in sorted(mixed_ids)]
    )


def test_pipeline_of_nothing(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet").where("false")
    for _, step in corpus_pipeline.STAGES:
        docs = step(spark, docs, folder)
        assert docs.count() == 0
