from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from probity.operators import identities as I
from probity.operators.fuzzy import similar_pairs
from probity.operators.reports import canonical_identities
from probity.operators.similarity import jaro_winkler_pairs


def brute(links) -> dict:
    label: dict = {}

    def root(x):
        label.setdefault(x, x)
        while label[x] != x:
            x = label[x]
        return x

    for a, b in links:
        if a is None or b is None:
            [root(x) for x in (a, b) if x is not None]
            continue
        a, b = root(a), root(b)
        label[max(a, b)] = min(a, b)
    return {x: root(x) for x in label}


def shapes(rng):
    chain = [(f"c{i:03}", f"c{i + 1:03}") for i in range(150)]
    rng.shuffle(chain)
    hub = [("hub", f"h{i}") for i in range(3000)]
    ring = [(f"r{i}", f"r{(i + 1) % 17}") for i in range(17)]
    loose = [(f"x{rng.randrange(300)}", f"x{rng.randrange(300)}") for _ in range(170)]
    return chain + hub + ring + loose + loose[:20] + [("self", "self"), ("one", None), (None, "two"), (None, None)]


def test_components_next_to_brute_force(spark):
    links = shapes(random.Random(4))
    got = I.connected(spark.createDataFrame(links, "a string, b string")).collect()
    assert {r.node: r.component for r in got} == brute(links) and len(got) == len(brute(links))


def test_components_of_numbers_and_of_nothing(spark):
    links = [(-5, 3), (3, 2**62), (7, 8)]
    got = {r.node: r.component for r in I.connected(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == brute(links)
    assert I.connected(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("limit", [20_000, 0])
def test_all_similar_pairs(spark, limit):
    rng = random.Random(2)
    base = ["maria quispe", "jose flores", "ana", "luz mamani rojas", "ab"]
    names = {"".join(c for c in rng.choice(base) if rng.random() > 0.08) + rng.choice(["", "a", " s"]) for _ in range(90)}
    df = spark.createDataFrame([(n,) for n in names] * 2 + [(None,), ("",)], "name string")
    got = {(r.name, r.match): r.score for r in similar_pairs(df, 0.9, broadcast_names=limit, cell_rows=30).collect()}
    long_enough = sorted(n for n in names if len(n) >= 3)
    import pandas as pd

    pairs = [(a, b) for a in long_enough for b in long_enough if a < b]
    left, right = (pd.Series([p[i] for p in pairs]) for i in (0, 1))
    scores = [max(s) for s in zip(jaro_winkler_pairs(left, right), jaro_winkler_pairs(right, left))]
    assert got == {p: s for p, s in zip(pairs, scores) if s >= 0.9}


PEOPLE = "global_id string, dni string, name string, born string"


def identities(spark, rows, **options):
    people = spark.createDataFrame(rows, PEOPLE)
    options = {"exact": [["dni"]], "name": "name", "within": ["born"], **options}
    return {r.global_id: r.identity_id for r in I.resolve_identities(people, **options).collect()}


def test_spellings_with_different_ids_are_one(spark):
    rows = [
        ("p9", "1", "MARIA QUISPE ROJAS", "1970"),
        ("p1", None, "MARIA QUISPE ROJAZ", "1970"),  # similar to p9, same day
        ("p5", "1", "otra", None),  # same document as p9
        ("p2", None, "MARIA QUISPE ROJAS", "1980"),  # same name, another day
        ("p3", " ", "", "1970"),
        ("p4", None, None, None),
        (None, "1", "MARIA QUISPE ROJAS", "1970"),
        ("p9", "1", "MARIA QUISPE ROJAS", "1970"),
    ]
    assert identities(spark, rows) == {"p9": "p1", "p1": "p1", "p5": "p1", "p2": "p2", "p3": "p3", "p4": "p4"}
    assert identities(spark, rows, name=None) == {"p9": "p5", "p5": "p5"} | {k: k for k in ("p1", "p2", "p3", "p4")}
    assert identities(spark, rows, within=[])["p2"] == "p1"
    assert identities(spark, []) == {}
    with pytest.raises(ValueError):
        identities(spark, rows, exact=[], name=None)


def test_a_name_that_a_third_of_all_bear_gives_one_link_per_id(spark):
    rows = [(f"i{i:04}", None, "JUAN PEREZ" if i % 3 == 0 else f"N{i} {i * i}", "d") for i in range(3000)]
    people = spark.createDataFrame(rows, PEOPLE)
    links = I.identity_links(people, name="name", within=["born"], threshold=1.0)
    assert links.count() == 999
    got = identities(spark, rows, threshold=1.0)
    assert all(got[f"i{i:04}"] == ("i0000" if i % 3 == 0 else f"i{i:04}") for i in range(3000))


def test_reports_go_by_identity(spark):
    rows = [("a", "1", "ANA DIAZ", "x"), ("b", "1", "ANNA DIAZ", "x"), ("b", "1", "ANNA DIAZ", "x"), ("c", None, "LUZ", "x")]
    people = spark.createDataFrame(rows, PEOPLE)
    found = I.with_identity(people, I.resolve_identities(people, exact=[["dni"]]))
    got = {r.identity_id: (r.name, r.variants, r.occurrences) for r in canonical_identities(found, ["name"], "identity_id").collect()}
    assert got == {"a": ("ANNA DIAZ", 2, 3), "c": ("LUZ", 1, 1)}


def test_rounds_are_deleted(spark):
    from probity.sources.layers import matches, work_folder

    before = len(matches(spark, f"{work_folder(spark)}/identity-links-*"))
    I.connected(spark.createDataFrame([(1, 2), (2, 3), (3, 4)], "a long, b long")).count()
    assert len(matches(spark, f"{work_folder(spark)}/identity-links-*")) == before + 1


def test_rounds_cost_what_is_open(spark, monkeypatch):
    """A hub's links leave the rounds at once, however many a chain beside it still takes."""
    links = [(0, i) for i in range(1, 2001)] + [(i, i + 1) for i in range(5000, 5100)]
    sizes, real = [], I._written
    monkeypatch.setattr(I, "_written", lambda df: (out := real(df), sizes.append(out[0].count()))[0])
    got = {r.node: r.component for r in I.connected(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == brute(links)
    assert sizes[0] == 2100 and max(sizes[2:]) <= 200
