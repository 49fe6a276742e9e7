"""Repeated passages of the test documents next to brute force over all windows."""

from __future__ import annotations

import hashlib
from collections import Counter

from probity.llm import queries

WIDTH = 400


def brute(rows) -> list:
    texts = [(i, (t or "").encode()) for i, t in rows]
    digest = lambda t, k: hashlib.blake2b(t[k : k + WIDTH], digest_size=16).digest()
    windows = [[digest(t, k) for k in range(len(t) - WIDTH + 1)] for _, t in texts]
    seen = Counter(w for held in windows for w in held)
    out = []
    for (i, t), held in zip(texts, windows):
        kept, spans, free = bytearray(), 0, 0
        for k in range(len(t)):
            if k < len(held) and seen[held[k]] > 1:
                spans += k >= free or not free
                free = k + WIDTH
            if k >= free:
                kept.append(t[k])
        out.append((i, len(t), len(t) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def test_registered_query(spark, folder):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    got = queries.op7_repeated_passages(spark, folder)
    found = sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got.collect())
    assert found == brute(rows) and any(r[2] for r in found)
