"""Alignment of two tokenizers next to plain set intersection of their ends."""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from probity.llm import alignment, queries

A, B = queries.tokenizer_path(), queries.tokenizer_path(queries.PIECES)
ends = st.lists(st.integers(0, 30_000), unique=True, max_size=400).map(sorted)


@settings(max_examples=200, deadline=None)
@given(ends, ends)
def test_galloping_is_intersection(a, b):
    a, b = np.array(a, np.int64), np.array(b, np.int64)
    i, j = alignment.common_ends(a, b)
    want = np.intersect1d(a, b)
    assert a[i].tolist() == b[j].tolist() == want.tolist()
    short, long = (a, b) if len(a) <= len(b) else (b, a)
    assert alignment.gallop(short, long).tolist() == np.searchsorted(long, short).tolist()


def test_galloping_over_many_blocks():
    rng = np.random.default_rng(2)
    for _ in range(40):
        a, b = (np.unique(rng.integers(0, 60_000, rng.integers(0, 20_000))) for _ in range(2))
        i, j = alignment.common_ends(a, b)
        assert a[i].tolist() == b[j].tolist() == np.intersect1d(a, b).tolist()


@pytest.fixture(scope="module")
def plain():
    model = Tokenizer.from_file(A)
    model.encode_special_tokens = True
    pieces = sentencepiece.SentencePieceProcessor(model_file=B)
    byte = {c: b for c, b in alignment._plain_bytes().items()}

    def sides(text):
        one = model.encode(" " + text, add_special_tokens=False)
        two = pieces.encode(text)
        a = [bytes(byte[c] for c in t) for t in one.tokens]
        b = [bytes([int(p[3:5], 16)]) if pieces.is_byte(i) else p.replace("▁", " ").encode() for i in two for p in [pieces.id_to_piece(i)]]
        return list(zip(one.ids, a)), list(zip(two, b))

    def brute(rows) -> list:
        held, count = [], Counter()
        for key, text in rows:
            a, b = sides(text) if text else ([], [])
            wanted = (" " + text).encode() if text else None
            if b"".join(t for _, t in a) != wanted or b"".join(t for _, t in b) != wanted:
                held.append((key, [], [], [], []))
                continue
            at = [dict(zip(np.cumsum([len(t) for _, t in s]).tolist(), range(1, len(s) + 1))) for s in (a, b)]
            groups, links, i, j = [], [], 0, 0
            for end in sorted(at[0].keys() & at[1].keys()):
                groups.append(([x for x, _ in a[i : at[0][end]]], [x for x, _ in b[j : at[1][end]]]))
                i, j = at[0][end], at[1][end]
                links.append((groups[-1][0][-1], groups[-1][1][-1]))
            count.update(links)
            held.append((key, a, b, groups, links))
        most = Counter()
        for (_, b), n in count.items():
            most[b] = max(most[b], n)
        out = []
        for key, a, b, groups, links in held:
            text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
            sums = (len(links), sum(count[k] == most[k[1]] for k in links), sum(count[k] for k in links))
            out.append((key, len(a), len(b), len(groups), *sums, hashlib.sha256(text.encode()).hexdigest() if text else ""))
        return sorted(out, key=repr)

    return brute


HARD = [
    (1, None), (2, ""), (3, " "), (4, "a  b\n\n c <|endoftext|> <s> </s> <0x41> <unk>"), (5, "x ▁ y"), (6, "日本語 の\t\x00 z"),
    (7, "  lead"), (8, "trail "), (9, " nb  é"), (10, "don't  stop\r\n"), (11, "word " * 40_000), (12, "x" * 20_000), (4, "again"),
    (4, "again"), (None, "🙂👍🏽 é"),
]


def test_hard_rows(documents, plain):
    got = alignment.alignments(documents(HARD, clash=True), A, B)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain(HARD)
    assert alignment.alignments(documents([]), A, B).count() == 0


def test_registered_query_next_to_brute_force(spark, folder, plain):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    got = queries.op13_token_alignment(spark, folder)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain(rows)


def test_forgotten_pieces_change_nothing(plain, monkeypatch):
    monkeypatch.setattr(alignment, "REMEMBERED", 3)
    aligner = alignment.Aligner(A, B)
    texts = ["one two three four", "one two", "", "five  six", "four three"]
    for text in texts:
        one = aligner.align([text])
        assert (len(one.a), len(one.b), len(one.groups.a_end)) == plain([(0, text)])[0][1:4]


def test_groups_cover_all_tokens(documents):
    text = "Antidisestablishmentarianism, naïve café"
    rows = alignment.token_groups(documents([(1, text), (2, None)]), A, B).orderBy("number").collect()
    aligner = alignment.Aligner(A, B)
    one = aligner.align([text])
    assert [i for r in rows for i in r.a_ids] == one.a.tolist() and [i for r in rows for i in r.b_ids] == one.b.tolist()
    assert {r.doc_id for r in rows} == {1} and rows[-1].end == len((" " + text).encode())
    assert aligner.a.bytes_of(rows[0].a_ids) == aligner.b.bytes_of(rows[0].b_ids)
