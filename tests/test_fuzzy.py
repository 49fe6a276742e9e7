from __future__ import annotations

import random

import pandas as pd
import pytest

from probity.operators import fuzzy, linking as L
from probity.operators.fuzzy import best_matches
from probity.operators.similarity import jaro_winkler_pairs


def jaro_winkler(a: str, b: str) -> float:
    """The measure written out character by character."""
    if not a or not b:
        return 1.0 if a == b else 0.0
    reach = max(max(len(a), len(b)) // 2 - 1, 0)
    taken = [False] * len(b)
    left = []
    for i, x in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not taken[j] and b[j] == x:
                taken[j] = True
                left.append(x)
                break
    right = [y for y, t in zip(b, taken) if t]
    m = len(left)
    if not m:
        return 0.0
    swaps = sum(x != y for x, y in zip(left, right)) // 2
    jaro = (m / len(a) + m / len(b) + (m - swaps) / m) / 3
    prefix = 0
    for x, y in zip(a[:4], b[:4]):
        if x != y:
            break
        prefix += 1
    return round(jaro + prefix * 0.1 * (1 - jaro) if jaro > 0.7 else jaro, 12)


def best_by_brute_force(names, choices, threshold):
    found = set()
    for name in names:
        if name is not None and len(name) >= 3:
            scored = [(-jaro_winkler(name, c), c) for c in choices if c]
            score, match = min(scored, default=(0, None))
            if -score >= threshold:
                found.add((name, match, -score))
    return found


def some_names(rnd, n, alphabet, low, high):
    words = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(2, 7))) for _ in range(25)]
    names = set()
    while len(names) < n:
        name = " ".join(rnd.choice(words) for _ in range(rnd.randint(1, 4)))
        name = name[: rnd.randint(low, high)]
        if rnd.random() < 0.6 and len(name) > 2:
            i = rnd.randrange(len(name))
            name = name[:i] + rnd.choice(["", rnd.choice(alphabet), name[i] * 2]) + name[i + 1 :]
        names.add(name)
    return sorted(names)


def test_pairs_are_scored_as_written_out():
    rnd = random.Random(1)
    words = some_names(rnd, 300, "ABCÑ 😀", 1, 30) + ["", "A", "AB", "X" * 300]
    pairs = [(rnd.choice(words), rnd.choice(words)) for _ in range(4000)]
    left, right = (pd.Series(side, dtype=object) for side in zip(*pairs))
    got = jaro_winkler_pairs(left, right)
    assert got.tolist() == pytest.approx([jaro_winkler(a, b) for a, b in pairs], abs=1e-12)


def test_null_pairs_have_no_score():
    scores = jaro_winkler_pairs(pd.Series(["a", None, "b"]), pd.Series(["a", "x", None]))
    assert scores[0] == 1 and pd.isna(scores[1]) and pd.isna(scores[2])


@pytest.mark.parametrize("broadcast_names", [20_000, 0])
@pytest.mark.parametrize(
    ("threshold", "alphabet", "low", "high"),
    [
        (0.92, "ABCDEFGHIJ", 3, 40),
        (0.85, "ABCDE", 1, 9),
        (0.97, "AB ", 1, 25),
        (0.9, "ÑÉ😀a1", 2, 12),
        (0.8, "ABCDEFGHIJ", 3, 20),
        (0.5, "ABCDEFGHIJKLM", 1, 9),
    ],
)
def test_join_equals_brute_force(spark, threshold, alphabet, low, high, broadcast_names):
    rnd = random.Random(int(threshold * 100) + len(alphabet))
    names = some_names(rnd, 150, alphabet, low, high)
    choices = some_names(rnd, 150, alphabet, low, high)
    as_frame = lambda words: spark.createDataFrame([(w,) for w in [*words, *words, None]], "name string")
    # cells of three rows, so that nearly every key is hot
    found = best_matches(
        as_frame(names), as_frame(choices), threshold, broadcast_names=broadcast_names, cell_rows=3
    )
    got = {(r.name, r["match"], r.score) for r in found.collect()}
    assert got == best_by_brute_force(names, choices, threshold)


def test_names_with_a_good_match_are_not_scored_at_lower_thresholds(spark, monkeypatch):
    rnd = random.Random(11)
    names, choices = some_names(rnd, 80, "ABCDE", 3, 12), some_names(rnd, 60, "ABCDE", 1, 12)
    asked, scored = {}, fuzzy._scored

    def spy(rest, every, offered, level, *limits):
        asked[level] = {r.name for r in rest.collect()}
        return scored(rest, every, offered, level, *limits)

    monkeypatch.setattr(fuzzy, "_scored", spy)
    frames = (spark.createDataFrame([(n,) for n in side], "name string") for side in (names, choices))
    got = {tuple(r) for r in best_matches(*frames, threshold=0.7).collect()}
    assert got == best_by_brute_force(names, choices, 0.7)
    first, last = max(asked), min(asked)
    assert last == 0.7 < first
    good = {name for name, _, score in got if score >= first}
    assert good & asked[first] and not good & asked[last] and asked[last] < asked[first]


def test_equal_scores_take_the_smallest_match(spark):
    names = spark.createDataFrame([("MARTHA",)], "name string")
    choices = spark.createDataFrame([("MARTHB",), ("MARTHC",)], "name string")
    assert best_matches(names, choices).first()["match"] == "MARTHB"


@pytest.mark.parametrize("broadcast_names", [20_000, -1])
def test_empty_sides(spark, broadcast_names):
    some = spark.createDataFrame([("MARTHA",)], "name string")
    for names, choices in ((some, some.limit(0)), (some.limit(0), some), (some.limit(0), some.limit(0))):
        assert best_matches(names, choices, broadcast_names=broadcast_names).count() == 0


def test_threshold_out_of_range(spark):
    names = spark.createDataFrame([("A",)], "name string")
    for threshold in (0, 1.1):
        with pytest.raises(ValueError):
            best_matches(names, names, threshold)


SANCTIONS = [
    ("00000000001", "Andina S.A.C.", "ANDINA", "MULTA"),
    ("00000000002", "Constructora Norte SA", "CONSTRUCTORA NORTE", "INHABILITACION"),
    ("00000000003", "Constructora Norte EIRL", "CONSTRUCTORA NORTE", "MULTA"),
    ("00000000001", "Andina S.A.C.", "ANDINA", "INHABILITACION"),
]


@pytest.fixture
def sanctions(spark):
    return spark.createDataFrame(
        SANCTIONS, "ruc string, nombre_empresa string, nombre_empresa_norm string, tipo_sancion string"
    )


@pytest.fixture
def company_links(spark):
    rows = [("11111111", "00000000001", "ANDINA puente"), ("22222222", "99999999999", "otra")]
    return spark.createDataFrame(rows, "numero_documento string, ruc string, nombre_empresa string")


def test_exact_link_keeps_both_names_apart(spark, company_links, sanctions):
    people = spark.createDataFrame([("a", " 11111111 "), ("b", "22222222"), ("c", None)], "global_id string, dni string")
    found = L.deterministic_links(people, company_links, sanctions).collect()
    assert {(r.global_id, r.empresa_candidato, r.osce_sancionada_match, r.tipo_sancion) for r in found} == {
        ("a", "ANDINA puente", "Andina S.A.C.", "MULTA"),
        ("a", "ANDINA puente", "Andina S.A.C.", "INHABILITACION"),
    }
    assert all(r.osce_match_score == 1.0 and r.fup_url.endswith("/00000000001") for r in found)


def test_fuzzy_names_only_for_people_without_exact_link(spark, company_links, sanctions):
    people = spark.createDataFrame(
        [
            ("a", "11111111", "Constructora Norte"),
            ("b", "22222222", "Constructora Nortee S.A."),
            ("c", None, "SA"),
            ("d", None, None),
            ("e", None, "Otra Cosa"),
        ],
        "global_id string, dni string, empresa_candidato string",
    )
    found = L.company_matches(people, company_links, sanctions)
    assert {(r.global_id, r.osce_match_method) for r in found.collect()} == {
        ("a", "DETERMINISTIC"),
        ("b", "FUZZY"),
    }
    fuzzy = found.where("global_id = 'b'").first()
    # one registry entry per normalised name: the smallest tax id
    assert fuzzy.ruc_sancionado == "00000000002" and 0.92 <= fuzzy.osce_match_score < 1


def test_phases_need_their_columns(spark, company_links, sanctions):
    ids = spark.createDataFrame([("a", "11111111")], "global_id string, dni string")
    assert L.company_matches(ids, company_links, sanctions).count() == 2
    names = spark.createDataFrame([("b", "Andina")], "global_id string, empresa_candidato string")
    assert L.company_matches(names, company_links, sanctions).first().osce_match_score == 1.0
    neither = spark.createDataFrame([("c",)], "global_id string")
    assert L.link_companies(neither, company_links, sanctions).first().osce_match_score is None


def test_nested_companies_are_unfolded_before_matching(spark, company_links, sanctions):
    people = spark.createDataFrame(
        [("a", ["x", "Andina SAC"]), ("b", []), ("c", None)], "global_id string, titularidad array<string>"
    )
    linked = {r.global_id: r for r in L.link_companies(people, company_links, sanctions).collect()}
    assert linked["a"].ruc_sancionado == "00000000001" and linked["a"].osce_match_method == "FUZZY"
    assert linked["b"].fup_url is None and linked["c"].osce_match_score is None
    assert linked["a"].titularidad == ["x", "Andina SAC"]


def test_best_link_has_a_total_order(spark):
    rows = [
        ("a", 0.95, "FUZZY", "1", "n"),
        ("a", 1.0, "FUZZY", "0", "n"),
        ("a", 1.0, "DETERMINISTIC", "9", "n"),
        ("a", 1.0, "DETERMINISTIC", "8", "n"),
    ]
    matches = spark.createDataFrame(
        rows,
        "global_id string, osce_match_score double, osce_match_method string, ruc_sancionado string, "
        "osce_sancionada_match string",
    ).withColumn("fup_url", L.F.lit("u"))
    best = L.best_match_per_person(matches).collect()
    assert [(r.osce_match_method, r.ruc_sancionado) for r in best] == [("DETERMINISTIC", "8")]


def test_copies_are_gone_before_the_joins(spark, company_links, sanctions):
    people = spark.range(3000).selectExpr(
        "'same' AS global_id", "'11111111' AS dni", "'Constructora Nortee' AS empresa_candidato"
    )
    assert L.deterministic_links(people, company_links, sanctions).count() == 2
    assert L.fuzzy_links(people, sanctions).count() == 1
