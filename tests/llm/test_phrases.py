"""Collocations next to brute force, whatever the sample was."""

from __future__ import annotations

import random
import re
import string
from collections import Counter

import numpy as np
import pytest

from probity.llm import phrases

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def brute(rows, least, first=None, contained=80) -> list:
    """Of rows of (text, lang)."""
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = lang or "und"
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            f.update((lang, tuple(w[i : i + k])) for k in range(1, 5) for i in range(len(w) - k + 1))
    found = {g: a for g, a in f.items() if len(g[1]) > 1 and a >= least}
    longer = Counter()
    for (lang, g), a in found.items():
        for k in range(2, len(g)):
            for i in range(len(g) - k + 1):
                longer[lang, g[i : i + k]] = max(longer[lang, g[i : i + k]], a)
    out: dict = {}
    for (lang, g), a in found.items():
        if 100 * longer[lang, g] < contained * a or not longer[lang, g]:
            score, k = min((2_000_000 * a // (f[lang, g[:k]] + f[lang, g[k:]]), k) for k in range(1, len(g)))
            out.setdefault(lang, []).append((-score, -a, " ".join(g).encode(), f[lang, g[:k]], f[lang, g[k:]]))
    return [
        (lang, rank, p.decode(), -a, left, right, n[lang], -score)
        for lang, rows in sorted(out.items())
        for rank, (score, a, p, left, right) in enumerate(sorted(rows)[:first], 1)
    ]


def found(df) -> list:
    return [tuple(r) for r in df.orderBy("lang", "rank").collect()]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(8)
    words = ["a", "b", "B", "c", "é", "É", "ab", "\x1c", "x" * 50]
    made = [(None, "en"), ("", None), (" \t", "de"), (". . .", "en"), ("a b a b a b a b " * 700, None), ("A  B\ta", "en")]
    for i in range(250):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r"]) for _ in range(rng.randrange(40)))
        made.append((text, rng.choice(["en", "en", "de", None])))
    return made + made[20:60]


@pytest.mark.parametrize(("every", "least", "first"), [(4, 30, None), (1, 10, 7), (100_000, 5, 40)])
def test_next_to_brute_force(documents, rows, every, least, first):
    docs = documents([(i, t, lang) for i, (t, lang) in enumerate(rows)], clash=True)
    assert found(phrases.collocations(docs, least, first, every=every)) == brute(rows, least, first)


def test_of_nothing(documents):
    assert phrases.collocations(documents([])).count() == 0
    assert phrases.collocations(documents([(1, None), (2, "a b")])).count() == 0


def test_a_sample_that_proposes_nothing_takes_more_passes(documents, rows, monkeypatch):
    """With an empty sample every level is opened by what the level before it missed."""
    docs = documents([(i, t, lang) for i, (t, lang) in enumerate(rows)])
    passes = []
    counted = phrases.counted
    monkeypatch.setattr(phrases, "counted", lambda *a: passes.append(a) or counted(*a))
    monkeypatch.setattr(phrases, "proposed", lambda *a: phrases.Known())
    assert found(phrases.collocations(docs, 10, None)) == brute(rows, 10)
    assert 2 <= len(passes) <= phrases.LONGEST


def test_a_full_table_of_known_phrases_loses_nothing(documents, rows, monkeypatch):
    docs = documents([(i, t, lang) for i, (t, lang) in enumerate(rows)])
    full = phrases.Known(np.full(phrases.FILTER_BITS // 64, ~np.uint64(0)))
    monkeypatch.setattr(phrases, "proposed", lambda *a: full)
    assert found(phrases.collocations(docs, 10, None)) == brute(rows, 10)


@pytest.mark.parametrize("bits", [1 << 7, 1 << 9, 1 << 11])
def test_phrases_that_a_table_holds_by_chance(documents, rows, monkeypatch, bits):
    monkeypatch.setattr(phrases, "FILTER_BITS", bits)
    docs = documents([(i, t, lang) for i, (t, lang) in enumerate(rows)])
    for every in (2, 40):
        assert found(phrases.collocations(docs, 8, None, every=every)) == brute(rows, 8)


def test_counts_beyond_64_bits_when_multiplied(spark, monkeypatch):
    big = 9_000_000_000_000_000
    table = [("en", 0, "", 3 * big), ("en", 1, "a", big + 7), ("en", 1, "b", big + 9), ("en", 2, "a b", big), ("en", 3, "a b c", big // 5)]
    table += [("en", 1, "c", big), ("en", 2, "b c", big // 5)]
    counts = spark.createDataFrame(table, phrases.COUNTS)
    monkeypatch.setattr(phrases, "frequent_phrases", lambda *a: counts)
    got = {r.phrase: r for r in phrases.collocations(spark.createDataFrame([], "lang string, text string")).collect()}
    assert got["a b"].score == 2_000_000 * big // (2 * big + 16) and "b c" not in got
