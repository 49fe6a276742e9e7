"""Line dedup next to brute force, and the runs over batches, sessions and broken jobs."""

from __future__ import annotations

import random
import string
from collections import Counter

import pytest
from pyspark.sql import functions as F

from probity.llm import line_dedup
from probity.llm.line_dedup import LineRuns

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def key(line: str) -> str:
    return line.strip(" \t\n\v\f\r").translate(LOWER)


def brute(rows, min_docs, least=1) -> list:
    texts = [t or "" for _, t in rows]
    count = Counter(k for t in texts for k in {key(x) for x in t.split("\n")} if len(k) >= least)
    out = []
    for (i, _), t in zip(rows, texts):
        lines = t.split("\n")
        left = [x for x in lines if count[key(x)] < min_docs]
        out.append((i, len(lines), len(lines) - len(left), "\n".join(left)))
    return sorted(out, key=repr)


def found(df) -> list:
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_hard_rows_next_to_brute_force(documents):
    rng = random.Random(3)
    lines = ["Menu", " menu\t", "MENU\r", "é", "É", "", "  ", "a ", "x" * 3000, "\v\fmenu"]
    rows = [(1, None), (2, ""), (3, "\n\n"), (4, "menu"), (4, "menu"), (None, "Menu\nown"), (5, "own\n" * 20_000 + "menu")]
    rows += [(10 + i, "\n".join(rng.choice([*lines, f"line {rng.randrange(40)}"]) for _ in range(rng.randrange(9)))) for i in range(60)]
    for min_docs, least in ((3, 1), (10, 1), (2, 5), (1, 1)):
        got = line_dedup.deduplicated_lines(documents(rows, clash=True), min_docs, least)
        assert found(got) == brute(rows, min_docs, least)


def test_of_nothing(documents):
    assert line_dedup.deduplicated_lines(documents([])).count() == 0


def test_one_batch_and_many_agree(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    want = brute([(r.doc_id, r.text) for r in docs.collect()], 4)
    for batches in (1, 5):
        assert found(line_dedup.deduplicated_lines(docs, 4, batches=batches)) == want


@pytest.fixture
def keys(spark):
    def build(*docs):
        return spark.createDataFrame([(bytes([k]),) for d in docs for k in set(d)], "key binary")

    return build


def counts(runs: LineRuns) -> dict:
    return {r.key[0]: r.n for r in runs._total(runs.runs()).collect()}


def test_runs_are_levelled_and_reopened(spark, keys, tmp_path):
    path = str(tmp_path / "runs")
    for batch in range(9):
        runs = LineRuns(spark, path, min_docs=100, fanout=2, buckets=3)
        runs.add(keys(b"ab", b"a", bytes([200 + batch])), batch)
        runs.add(keys(b"ab"), batch)  # it comes again
        runs.close()
    spans = [(r.first, r.last) for r in runs.runs()]
    assert spans == [(0, 7), (8, 8)]
    assert counts(runs) == {97: 18, 98: 9} | {200 + b: 1 for b in range(9)}
    with pytest.raises(ValueError):
        runs.add(keys(b"a"), 11)


def test_a_merge_that_broke_off_counts_nothing_twice(spark, keys, tmp_path, monkeypatch):
    runs = LineRuns(spark, str(tmp_path / "runs"), min_docs=100, fanout=3, buckets=2)
    monkeypatch.setattr(LineRuns, "_forget", lambda self, run: None)
    for batch in range(3):
        runs.add(keys(b"ab"), batch)
    assert [(r.first, r.last) for r in runs.runs()] == [(0, 2)] and counts(runs) == {97: 3, 98: 3}
    (tmp_path / "runs" / "run-000003-000003-2").mkdir()  # a write that never ended
    assert len(runs.runs()) == 1
    runs.add(keys(b"b"), 3)
    assert counts(runs) == {97: 3, 98: 4}


def test_settled_keys_are_not_counted_again(spark, keys, tmp_path):
    runs = LineRuns(spark, str(tmp_path / "runs"), min_docs=2, fanout=4, buckets=2)
    runs.add(keys(b"ab", b"a"), 0)
    runs.add(keys(b"ab", b"a"), 1)
    assert {r.key[0]: r.n for r in runs.table(runs.runs()[1]).collect()} == {98: 1}
    assert sorted(r.key[0] for r in runs.frequent().collect()) == [97, 98]


def test_a_batch_meets_runs_without_shuffling_them(spark, keys, tmp_path):
    runs = LineRuns(spark, str(tmp_path / "runs"), min_docs=2, buckets=4)
    runs.add(keys(b"ab", b"a"), 0)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        batch = keys(b"a").groupBy("key").agg(F.count("*").alias("n"))
        joined = batch.join(runs.table(runs.runs()[0]).where("n >= 2").select("key"), "key", "left_anti")
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert "SortMergeJoin" in plan and plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan
