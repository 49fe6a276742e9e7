"""Exact dedup, mixing, URL filter, license scan and decontamination on hard rows."""

from __future__ import annotations

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from probity.llm import decontamination, exact_dedup, licenses, mixing, urls

HARD = [(1, None), (2, ""), (3, "Ab\nc"), (4, "aB\nC"), (5, "É x"), (6, "é x"), (7, "y " * 30_000), (7, "y " * 30_000), (None, "lost")]


def lower(text):
    return "".join(c.lower() if c < "\x80" else c for c in text or "")


@pytest.mark.parametrize("clash", [False, True])
def test_exact_duplicates(documents, clash):
    got = exact_dedup.exact_duplicates(documents(HARD, clash)).collect()
    groups: dict[str, list] = {}
    for key, text in HARD:
        groups.setdefault(lower(text), []).append(key)
    want = []
    for key, text in HARD:
        ids = groups[lower(text)]
        keep = max((i for i in ids if i is not None), default=None)
        want.append((key, keep, len(ids), key == keep, hashlib.sha256(lower(text).encode()).hexdigest()))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_exact_duplicates_of_nothing(documents):
    assert exact_dedup.exact_duplicates(documents([])).count() == 0


def test_chunks_are_the_text_and_meet_again(spark):
    rng = random.Random(5)
    lines = ["".join(rng.choice("abc é") for _ in range(rng.randint(0, 900))) + "\n" for _ in range(40)]
    first, second = "".join(lines) + "x" * 9000, "inserted\n" + "".join(lines)
    df = spark.createDataFrame([(first,), (second,)], "text string")
    a, b = (r.c for r in df.select(exact_dedup.chunks(F.col("text")).alias("c")).collect())
    assert "".join(a) == first and "".join(b) == second
    assert max(map(len, a + b)) <= exact_dedup.MOST
    assert len(set(a) & set(b)) > len(b) / 2


def test_chunks_of_one_name_are_told_apart(spark):
    part = "struct<hash:long,bytes:int,digest:binary>"
    rows = [(1, "t1", [(7, 3, b"a")]), (2, "t2", [(7, 3, b"b")]), (3, "t1", [(7, 3, b"a")]), (4, "t4", [(8, 3, b"c")])]
    table = spark.createDataFrame(rows, f"id long, text_sha256 string, recipe array<{part}>")
    ids = {r.id: r.ids for r in exact_dedup.verified(table).collect()}
    assert ids[1] == ids[3] != ids[2]
    assert ids[4][0].digest is None


def brute_mix(rows, weights=(3, 1, 2), share=1.5, most=2):
    sizes: dict = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, open_, left = {}, set(order), share * sum(sizes.values())
    while open_:
        rate = left / sum(weight[s] for s in open_)
        above = {s for s in open_ if rate * weight[s] > most * sizes[s]}
        for s in above or open_:
            target[s] = min(most * sizes[s], rate * weight[s])
        if not above:
            break
        left -= sum(target[s] for s in above)
        open_ -= above
    return sizes, target


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_mix_comes_near_its_targets(documents, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(600):
        source = rng.choice(["a", "a", "a", "b", "Z", None, "ü"])
        rows.append((i, None if i % 50 == 0 else "w " * rng.randint(0, 40), source))
    sizes, target = brute_mix(rows)
    docs = documents([(i, t, "en", s) for i, t, s in rows], clash=True)
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows)
    source_of = {i: s for i, _, s in rows}
    taken = dict.fromkeys(sizes, 0)
    for r in got:
        s = source_of[r.doc_id]
        assert r.source_size == sizes[s] and r.target == pytest.approx(target[s])
        assert r.taken in (0, r.size, 2 * r.size) and r.taken == r.copies * r.size
        taken[s] += r.taken
    assert all(abs(taken[s] - target[s]) <= 40 for s in sizes)
    assert sorted(map(tuple, mixing.mix(docs).collect())) == sorted(map(tuple, got))
    repeated = mixing.mixed(docs)
    assert repeated.columns == docs.columns
    assert repeated.count() == sum(r.copies for r in got)


def test_mix_of_nothing_and_of_blanks(documents):
    assert mixing.mix(documents([])).count() == 0
    assert mixing.mixed(documents([])).count() == 0
    rows = mixing.mix(documents([(1, None), (2, " \n"), (None, "a b"), (None, "a b")])).collect()
    # the target is 6 of 4 words; the two rows of one id go together, so 4 and 8 are as near
    assert sum(r.taken for r in rows) in (4, 8)
    assert all(r.taken <= 2 * r.size for r in rows)


RULES = [
    urls.Rule("allow", "org", "/"),
    urls.Rule("block", "example.org", "/es/"),
    urls.Rule("block", "com", "/de/"),
    urls.Rule("allow", "com", "/fr/"),
]


def test_urls(spark):
    pages = [
        (1, "HTTP://Sub.Example.ORG/es/1"),
        (2, "https://example.org/en"),
        (3, "https://notexample.org/es/1"),
        (4, None),
        (5, "no scheme"),
        (6, "https://www.Bad.net/a/?b=1&utm_source=x&a=2#f"),
        (7, "http://bad.net:80/a?a=2&b=1"),
        (8, "http://bad.net/b"),
        (9, "https://x.com/de/1"),
        (10, "https://x.com/fr/1"),
        (11, "x://y://z/p?q#r"),
        (12, "://"),
        (12, "://"),
        (13, "http://bad.net/" + "long/" * 5000),
    ]
    df = spark.createDataFrame(pages, "page_id long, url string").withColumn("canonical", F.lit(1)).withColumn("id", F.lit(2))
    listed = spark.createDataFrame([("http://BAD.net/a?b=1&a=2",), (None,), ("http://bad.net/a?a=2&b=1",)], "url string")
    got = {r.page_id: r for r in urls.judge(df, listed, RULES).collect()}
    assert [(got[i].rule, got[i].verdict) for i in range(1, 4)] == [
        ("example.org/es/", "block"),
        ("org/", "allow"),
        ("org/", "allow"),
    ]
    assert (got[4].host, got[4].path, got[4].verdict) == ("", "", "allow")
    assert (got[5].host, got[5].path, got[5].rule) == ("", "", None)
    assert [got[i].verdict for i in (6, 7, 8)] == ["block", "block", "allow"]
    assert [got[i].verdict for i in (9, 10)] == ["block", "allow"]
    assert (got[11].host, got[11].path) == ("y:", "//z/p")
    assert urls.judge(df, listed, RULES).count() == len(pages)
    assert urls.judge(df, listed.where("false"), RULES).where("listed").count() == 0
    assert urls.judge(df.where("false"), listed, RULES).count() == 0


def test_bloom_passes_all_listed_and_few_others(spark):
    names = spark.range(4000).select(F.concat(F.lit("h/"), "id").alias("canonical"))
    table = urls.bloom(names, 250)
    probe = spark.range(40_000).select(F.concat(F.lit("h/"), "id").alias("canonical"), (F.col("id") < 4000).alias("listed"))
    hit = F.lit(True)
    for i, bit in enumerate(urls.bits("canonical")):
        hit = hit & (F.col(f"w{i}").bitwiseAND(bit) != 0)
    found = probe.withColumn("block", F.expr("pmod(xxhash64(canonical), 250L)")).join(table, "block", "left")
    sums = found.groupBy("listed").agg(F.avg(F.coalesce(hit, F.lit(False)).cast("int")).alias("p")).collect()
    rate = {r.listed: r.p for r in sums}
    assert rate[True] == 1.0 and rate[False] < 0.02


def test_licenses(documents):
    mit = licenses.TEMPLATES["mit"]
    words = mit.split()
    rows = [
        (1, None),
        (2, ""),
        (3, "CC BY cc-by ccby, cc  by"),
        (4, "GNU General PUBLIC license; all rights reserved. All Rights"),
        (5, "all rights reserved " * 3000),
        (6, "x " + mit + " y"),
        (7, "x " + " ".join(words[:10] + ["indeed"] + words[10:]) + " y"),
        (8, " ".join(words[:8])),
        (9, "é cc by é"),
        (10, "cc"),
        (10, "by"),
    ]
    got = {}
    for r in licenses.scan(documents(rows, clash=True)).collect():
        got.setdefault(r.doc_id, []).append(r)
    one = {k: v[0] for k, v in got.items()}
    assert [(one[i].n_words, one[i].n_base, one[i].first_word, one[i].labels, one[i].score) for i in (1, 2)] == [
        (0, 0, None, "", 0.0)
    ] * 2
    assert (one[3].n_base, one[3].first_word, one[3].last_word, one[3].base_labels) == (3, 0, 5, "cc-by")
    assert (one[4].n_base, one[4].base_labels, one[4].first_word, one[4].last_word) == (2, "gpl,reserved", 1, 4)
    assert (one[5].n_base, one[5].last_word, one[5].n_words) == (3000, 8997, 9000)
    assert one[6].labels == "mit" and one[6].score == 1.0
    assert one[7].labels == "mit" and one[7].score < 1.0
    assert one[8].labels == "" and 0 < one[8].score < 0.8
    assert (one[9].first_word, one[9].n_words) == (1, 4)
    assert len(got[10]) == 2
    assert licenses.scan(documents([])).count() == 0


ITEM = "If Anna buys 12 apples and 7 pears for 3 km of road, how many apples does Anna have left after Bob eats 12 apples?"
CHANGED = "If Maria buys 45 apples and 9 pears for 8 km of road, how many apples does Maria have left after Tom eats 45 apples?"
BROKEN = "If Maria buys 45 apples and 9 pears for 8 km of road, how many apples does Carla have left after Tom eats 46 apples?"


def test_decontamination(spark, documents):
    filler = "some words that no benchmark holds, quite a few of them. "
    rows = [
        (1, filler + ITEM + " " + filler),
        (2, filler + CHANGED),
        (3, filler + BROKEN),
        (4, filler * 2000),
        (5, None),
        (6, ""),
        (7, filler * 1500 + ITEM),
        (8, ITEM.split(" how")[0][:20]),
        (9, filler),
        (9, ITEM),
        (None, ITEM),
    ]
    bench = spark.createDataFrame([(1, ITEM), (2, None), (3, ""), (4, "too short"), (5, ITEM)], "item_id long, text string")
    docs = documents(rows, clash=True)
    got = decontamination.contaminated(docs, bench).collect()
    assert {(r.doc_id, r.item_id, r.kind) for r in got} == {
        (d, i, k) for d, k in ((1, "exact"), (2, "changed"), (7, "exact"), (9, "exact"), (None, "exact")) for i in (1, 5)
    }
    clean = decontamination.decontaminated(docs, bench)
    assert clean.columns == docs.columns
    assert sorted((r.doc_id, r.text) for r in clean.select("doc_id", "text").collect() if r.text) == sorted(
        (k, t) for k, t in rows if t and k in (3, 4, 8) or (k, t) == (9, filler)
    )
    assert clean.count() == 6
    assert decontamination.contaminated(docs.where("false"), bench).count() == 0
    assert decontamination.contaminated(docs, bench.where("false")).count() == 0


def test_templates_and_plain_words_stay_aligned(spark):
    rng = random.Random(11)
    parts = ["Anna", "buys", "3", "3.5", "1,000", "km", "kg", ".", ",", " ", " ", " ", "É", "ñu", "Élan", "2x", "\x01", "%", "\n", "McDo", "N"]
    rows = [("".join(rng.choice(parts) for _ in range(60)),) for _ in range(300)] + [("",), (None,)]
    df = spark.createDataFrame(rows, "text string").select(
        decontamination.template(F.col("text")).alias("a"), decontamination.plain(F.col("text")).alias("b")
    )
    for r in df.collect():
        assert len(r.a.split(" ")) == len(r.b.split(" ")), r


def test_decontamination_of_real_rows_against_substrings(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    bench = spark.read.parquet(f"{folder}/benchmark.parquet")
    found = {(r.doc_id, r.item_id) for r in decontamination.contaminated(docs, bench).collect()}
    items = {r.item_id: r.text for r in bench.collect()}

    def plain(text):
        return " ".join(re.findall(r"\w+", text.lower()))

    texts = {r.doc_id: plain(r.text) for r in docs.collect()}
    holds = {(d, i) for d, t in texts.items() for i, item in items.items() if f" {plain(item)} " in f" {t} "}
    assert holds <= found
    for d, i in found - holds:  # nothing clean: half of the item at least stands there word by word
        grams = lambda t: {tuple(t.split()[k : k + 5]) for k in range(len(t.split()) - 4)}
        assert len(grams(plain(items[i])) & grams(texts[d])) > 5
