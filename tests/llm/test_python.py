"""Language ID, SimHash, repeats, WARC and token blocks: brute force, round trips, hard rows."""

from __future__ import annotations

import gzip
import hashlib
import random
import zlib
from pathlib import Path

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from probity.llm import language, queries, repeats, simhash, tokens, warc

HARD = [(1, None), (2, ""), (3, " \n"), (4, "one two"), (5, "ONE Two"), (6, "w " * 30_000), (7, "w " * 30_000), (7, "é"), (None, "é")]


# ---- language ----


@pytest.fixture(scope="module")
def model(spark, folder):
    docs = queries.held_out(spark.read.parquet(f"{folder}/documents.parquet"))
    return language.train(docs.where("NOT held_out"))


def test_language_of_held_out_rows(spark, folder):
    rows = queries.op1_language_id(spark, folder)
    truth = spark.read.parquet(f"{folder}/documents.parquet").select(F.col("doc_id").alias("d"), "lang")
    joined = rows.join(truth, F.col("doc_id") == F.col("d")).collect()
    held = [r for r in joined if r.held_out]
    assert len(joined) == truth.count()
    assert sum(r.lang == r.lang_pred for r in held) / len(held) >= 0.95
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in joined)


def test_language_ignores_labels_and_ids(spark, folder, model):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(50)
    one = language.identify(docs, model)
    two = language.identify(docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit("y")), model)
    assert sorted(map(str, one.collect())) == sorted(map(str, two.collect()))


def test_language_of_hard_rows(documents, model):
    rows = [*HARD, (8, "12 ,. ²"), (9, "Ελλάδα"), (10, "퟿ 漢字 the")]
    got = [tuple(r) for r in language.identify(documents(rows, clash=True), model).collect()]
    by = {r[0]: r for r in got if r[0] not in (7, None)}
    assert len(got) == len(rows)
    assert all(by[i][1:] == ("und", 0.0, []) for i in (1, 2, 3, 8))
    assert by[9][1] in model.languages and by[6][3] and by[6][3][0][:2] == (0, 29_999)
    assert language.identify(documents([]), model).count() == 0


def test_all_labels_are_learned(documents):
    """More languages than a full model has buckets for: none is left out, and buckets shrink instead."""
    rows = [(i * 10 + k, " ".join([f"{chr(97 + i % 26)}{chr(97 + i // 26)}x"] * 9), f"l{i:03}") for i in range(150) for k in range(3)]
    model = language.train(documents(rows))
    assert len(model.languages) == 150 and model.logs.shape[1] == language.BUCKETS >> 2
    got = {r.doc_id: r.lang_pred for r in language.identify(documents(rows), model).collect()}
    assert sum(got[i] == lang for i, _, lang in rows) >= 0.95 * len(rows)
    assert language.buckets_for(64) == language.BUCKETS and language.buckets_for(65) == language.BUCKETS // 2


def test_no_labels_at_all(documents):
    docs = documents([(1, "some words"), (2, None)])
    empty = language.train(docs.where("false"))
    assert {r.lang_pred for r in language.identify(docs, empty).collect()} == {"und"}


def test_spans_of_mixed_text(spark, folder, model):
    by_lang: dict[str, list[str]] = {}
    for r in spark.read.parquet(f"{folder}/documents.parquet").collect():
        if r.text and len(r.text) > 400 and r.text.isprintable() is False:
            by_lang.setdefault(r.lang, []).append(r.text[:400].rsplit(" ", 1)[0])
    first, second = by_lang["fr"][0], by_lang["en"][1]
    names, share, spans = language.label([first + " . " + second], model)
    assert {s[2] for s in spans[0]} >= {"fr", "en"}
    cut = len(language.letters(first))
    assert any(abs(s[0] - cut) <= 3 for s in spans[0][1:])
    assert share[0] < 1


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(3)
    for _ in range(20):
        lengths = rng.integers(0, 6, 5)
        scores = rng.normal(0, 20, (8, 3)).astype(np.float32)
        codes = rng.integers(0, 8, lengths.sum())
        model = language.Model(("a", "b", "c"), None, rng.normal(0, 1, 3).astype(np.float32), None)
        path = language.viterbi(codes, lengths, scores, model)

        def value(p, c):
            total = model.prior[p[0]] + sum(scores[w, l] for w, l in zip(c, p))
            return total - language.SWITCH * sum(x != y for x, y in zip(p, p[1:]))

        at = 0
        for n in lengths:
            if n:
                all_paths = np.stack(np.meshgrid(*[range(3)] * n, indexing="ij"), -1).reshape(-1, n)
                best = max(value(p, codes[at : at + n]) for p in all_paths)
                assert value(path[at : at + n], codes[at : at + n]) == pytest.approx(best, abs=1e-3)
            at += n


# ---- SimHash ----


def brute_fingerprint(text) -> int:
    part = (text or "").encode().lower().split()
    shingles = [b" ".join(part[i : i + 3]) for i in range(len(part) - 2)] if len(part) >= 3 else [b" ".join(part)] * bool(part)
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(ids, fps):
    fps = np.array(fps, np.uint64)
    label = list(range(len(fps)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in range(len(fps)):
        for j in np.nonzero(np.bitwise_count(fps ^ fps[i]) <= 2)[0]:
            label[max(root(i), root(j))] = min(root(i), root(j))
    least: dict = {}
    for i, d in enumerate(ids):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return [least.get(root(i)) for i in range(len(ids))]


def test_simhash_of_hard_rows(documents):
    got = simhash.near_duplicates(documents(HARD, clash=True)).collect()
    fps = [brute_fingerprint(t) for _, t in HARD]
    want = [(d, f"{f:016x}", c) for (d, _), f, c in zip(HARD, fps, brute_components([d for d, _ in HARD], fps))]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert simhash.near_duplicates(documents([])).count() == 0


def test_one_row_of_each_component_stays(documents):
    docs = documents([*HARD, (8, "a b c d"), (8, "a b c d"), (8, "quite other words here")], clash=True)
    kept = simhash.deduplicated(docs)
    assert kept.columns == docs.columns
    rows = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
    assert rows == sorted([(1, None), (4, "one two"), (6, HARD[5][1]), (7, "é"), (8, "a b c d"), (8, "quite other words here")], key=str)
    assert simhash.deduplicated(documents([])).count() == 0


def test_simhash_of_real_rows(spark, folder):
    rows = spark.read.parquet(f"{folder}/documents.parquet").collect()
    fps = [brute_fingerprint(r.text) for r in rows]
    want = {r.doc_id: (f"{f:016x}", c) for r, f, c in zip(rows, fps, brute_components([r.doc_id for r in rows], fps))}
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.op3_simhash(spark, folder).collect()}
    assert got == want


@pytest.mark.parametrize("dense", [False, True])
def test_tree_finds_all_links(spark, monkeypatch, dense):
    """Random fingerprints with planted neighbours and a dense cluster, through small leaves."""
    rng = np.random.default_rng(9)
    monkeypatch.setattr(simhash, "DIRECT", 16)
    monkeypatch.setattr(simhash, "LEAF", 64)
    if dense:
        monkeypatch.setattr(simhash, "DENSE", 20)
    base = rng.integers(0, 1 << 63, 400, dtype=np.uint64)
    near = base[:150] ^ (np.uint64(1) << rng.integers(0, 64, 150).astype(np.uint64))
    cluster = base[0] ^ rng.integers(0, 1 << 12, 300).astype(np.uint64)
    fps = np.unique(np.concatenate((base, near, cluster)))
    df = spark.createDataFrame([(int(f),) for f in fps.view(np.int64)], "fp long")
    roots = {r.u: r.v for r in simhash.stars(simhash.links(df)).collect()}
    signed = fps.view(np.int64).tolist()
    want = brute_components(list(range(len(fps))), fps)
    groups: dict = {}
    for f, c in zip(signed, want):
        groups.setdefault(c, []).append(f)
    for members in groups.values():
        assert {roots.get(f, f) for f in members} == {min(members)}


# ---- repeats ----


def brute_repeats(texts):
    data = [(t or "").encode() for t in texts]
    seen: dict = {}
    for t in data:
        for i in range(len(t) - 399):
            seen[t[i : i + 400]] = seen.get(t[i : i + 400], 0) + 1
    out = []
    for t in data:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - 399):
            if seen[t[i : i + 400]] > 1:
                gone[i : i + 400] = True
        spans = int((np.diff(np.concatenate(([0], gone.astype(np.int8)))) == 1).sum())
        left = bytes(np.frombuffer(t, np.uint8)[~gone])
        out.append((len(t), int(gone.sum()), spans, hashlib.sha256(left).hexdigest()))
    return out


def passages(seed):
    rng = random.Random(seed)

    def word():
        return "".join(rng.choice("abcdé") for _ in range(rng.randint(1, 8)))

    def text(n):
        return " ".join(word() for _ in range(n))

    shared = [text(150) for _ in range(3)]
    rows = [(i, text(rng.randint(0, 60)) + rng.choice(shared) + text(rng.randint(0, 60))) for i in range(25)]
    twice = text(120)
    rows += [(100, twice + " and again " + twice), (101, "a" * 900), (102, "ab" * 399), (103, "abc " * 260), (104, "z" * 400)]
    rows += [(105, None), (106, ""), (107, text(400)), (107, "unrelated"), (None, shared[0][:399]), (108, shared[0][1:401])]
    rows += [(109, text(90)), (109, rows[0][1]), (110, "\x00" * 450 + "\x01" + "\x00" * 401)]
    return rows


@pytest.mark.parametrize("seed, crowd, size", [(1, None, None), (2, 1500, None), (3, None, 2000)])
def test_repeats(documents, monkeypatch, seed, crowd, size):
    monkeypatch.setattr(repeats, "CROWD", crowd or repeats.CROWD)
    monkeypatch.setattr(repeats, "TEXT", size or repeats.TEXT)
    rows = passages(seed)
    got = repeats.remove_repeats(documents(rows, clash=True)).drop("kept").collect()
    want = [(d, *w) for (d, _), w in zip(rows, brute_repeats([t for _, t in rows]))]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_repeats_of_nothing(documents):
    assert repeats.remove_repeats(documents([])).count() == 0
    got = repeats.remove_repeats(documents([(1, None), (2, "x")])).collect()
    assert [(r.n_bytes, r.n_removed) for r in sorted(got, key=lambda r: r.doc_id)] == [(0, 0), (1, 0)]


def test_two_stage_order_is_the_order_of_the_suffixes():
    rng = random.Random(4)
    for alphabet in (b"a", b"ab", b"abcd\x00\xff"):
        text = bytes(rng.choice(alphabet) for _ in range(700))
        starts = np.array(sorted(rng.sample(range(700), 200)))
        order = [p for p in repeats.suffix_order(text, starts).tolist() if p in set(starts.tolist())]
        keys = [text[p : p + 400] for p in order]
        assert keys == sorted(keys) and len(order) == 200


# ---- WARC ----


def archive_pages(spark, n=60):
    rng = random.Random(2)
    rows = [(i, f"http://h/{i}\r\nx", "<p>é" + "y\r\n\r\nWARC/1.1\r\n" * rng.randint(0, 400)) for i in range(n)]
    rows += [(n, None, None), (n + 1, "u", ""), (None, "u", "z"), (None, "u", "z"), (0, "again", "again"), (n + 2, "u", "l" * 900_000)]
    return rows, spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("file", F.lit("f"))


def test_archive_round_trip(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "RECORDS", 7)
    rows, df = archive_pages(spark)
    warc.write_archive(df, str(tmp_path / "a"))
    got = warc.read_archive(spark, str(tmp_path / "a")).collect()
    bodies = sorted(bytes(r.value).split(b"\r\n\r\n", 1)[1] for r in got)
    assert bodies == sorted((h or "").encode() for _, _, h in rows)
    assert sorted(r.name for r in got) == sorted(f"urn:page:{'null' if i is None else i}" for i, _, _ in rows)
    data = {p.parent.name[5:]: gzip.decompress(p.read_bytes()) for p in Path(tmp_path / "a").rglob("*.gz")}
    assert all(data[r.file][r.offset : r.offset + r.length] == bytes(r.value) for r in got)
    assert all(d.endswith(b"\r\n\r\n") and d.startswith(b"WARC/1.1\r\n") for d in data.values())


def test_audit_finds_what_differs(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "RECORDS", 9)
    monkeypatch.setattr(warc, "RANGE", 2000)
    monkeypatch.setattr(warc, "FAN", 2)
    _, df = archive_pages(spark)
    warc.write_archive(df, str(tmp_path / "a"))
    records = warc.read_archive(spark, str(tmp_path / "a"))
    assert warc.audit(records, records).count() == 0
    name = F.col("name")
    worse = F.when(name == "urn:page:5", F.replace(F.col("value").cast("string"), F.lit("é"), F.lit("è")))
    times = F.when(name == "urn:page:9", 0).when(name == "urn:page:20", 2).otherwise(1)
    other = records.select(
        "file", "seq", F.coalesce(worse, F.col("value").cast("string")).alias("value"), F.explode(F.array_repeat(F.lit(0), times))
    )
    warc.write_records(other, str(tmp_path / "b"), "seq")
    found = warc.audit(records, warc.read_archive(spark, str(tmp_path / "b"))).collect()
    assert {(r.name, r.kind) for r in found} == {("urn:page:5", "changed"), ("urn:page:9", "missing"), ("urn:page:20", "extra")}
    place = {r.name: (r.file, r.offset, r.length) for r in records.collect()}
    assert all(place[r.name] == (r.file, r.offset, r.length) for r in found if r.kind != "extra")


def test_audit_of_broken_files(spark, tmp_path):
    _, df = archive_pages(spark, 8)
    warc.write_archive(df.coalesce(1), str(tmp_path / "a"))
    source = next(Path(tmp_path / "a").rglob("*.gz"))
    target = tmp_path / "b" / source.parent.name
    target.mkdir(parents=True)
    data = gzip.decompress(source.read_bytes())
    broken = data.replace(b"Content-Length: ", b"Content-Width: ", 1)
    (target / "x.txt.gz").write_bytes(gzip.compress(broken)[:-9])
    read = lambda p: warc.read_archive(spark, str(tmp_path / p))
    assert warc.audit(read("a"), read("b")).count() > 0
    empty = read("a").where("false")
    assert warc.audit(empty, empty).count() == 0
    assert {r.kind for r in warc.audit(read("a"), empty).collect()} == {"missing"}


@pytest.mark.parametrize("place", ["check", 0.9, 0.5])
def test_damaged_bytes_cost_what_follows_only(spark, tmp_path, place):
    """One flipped bit: in the checksum it costs nothing, in the data not the records before it."""
    rows = [(i, f"u{i}", hashlib.sha256(str(i).encode()).hexdigest() * 30) for i in range(400)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    warc.write_archive(df, str(tmp_path / "a"))
    source = next(Path(tmp_path / "a").rglob("*.gz"))
    data = bytearray(source.read_bytes())
    data[-6 if place == "check" else int(len(data) * place)] ^= 4
    target = tmp_path / "b" / source.parent.name
    target.mkdir(parents=True)
    (target / "x.txt.gz").write_bytes(bytes(data))
    records = warc.read_archive(spark, str(tmp_path / "a"))
    found = warc.audit(records, warc.read_archive(spark, str(tmp_path / "b"))).collect()
    lost = {r.name for r in found if r.kind in ("changed", "missing")}
    if place == "check":
        assert not found
    else:
        order = [r.name for r in records.orderBy("seq").collect()]
        assert lost and not lost & set(order[: int(len(order) * (place - 0.05))])


def test_members_behind_damage_are_read():
    parts = [gzip.compress(hashlib.sha256(bytes([i])).digest() * 500) for i in range(4)]
    whole = [gzip.decompress(p) for p in parts]
    assert warc.inflate(b"".join(parts)) == b"".join(whole)
    bad = bytearray(parts[1])
    bad[20] ^= 255
    out = warc.inflate(parts[0] + bytes(bad) + parts[2] + parts[3])
    assert out.startswith(whole[0]) and out.endswith(whole[2] + whole[3])
    assert warc.inflate(parts[0][:-12]) in whole[0] and warc.inflate(b"no gzip") == b"" and warc.inflate(b"") == b""


# ---- tokens ----


@pytest.mark.parametrize("width", [1, 3, 8, 13, 16, 17, 31, 32])
def test_packing_round_trip(width):
    rng = np.random.default_rng(width)
    ids = rng.integers(0, 1 << width, 1001).astype(np.uint32)
    packed = tokens.pack(ids, width)
    assert len(packed) == -(-1001 * width // 8)
    assert (tokens.unpack(packed, width, 0, 1001) == ids).all()
    for a, n in ((0, 1), (7, 0), (13, 500), (1000, 1)):
        assert (tokens.unpack(packed, width, a, n) == ids[a : a + n]).all()


def test_width():
    assert [tokens.width_of(v) for v in (1, 2, 3, 256, 257, 50_257, 65_537)] == [1, 1, 2, 8, 9, 16, 17]


@pytest.fixture(scope="module")
def encoder():
    pytest.importorskip("public_tokenizers")
    return tokens.Encoder(queries.tokenizer_path())


def test_encoder_is_the_tokenizer(encoder):
    rng = random.Random(8)
    parts = [" ", "  ", "\n", "\t", "a", "Bo", "é", "12", "'s", "!", "\x1c", "\x85", " ", "​", "漢", "<|endoftext|>", "x.\ny", "#"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(1500)] + ["", " ", "a", " a", "a "]
    for group in (texts[:500], texts[500:], texts):
        for text, ids in zip(group, encoder.encode(group)):
            assert ids.tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def brute_tokens(encoder, rows):
    out, start = [], 0
    for key, text in rows:
        ids = encoder.tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        out.append((key, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_tokens_of_hard_rows(spark, documents, encoder, monkeypatch, tmp_path):
    monkeypatch.setattr(tokens, "BLOCK_IDS", 50)
    rows = [(3, "two words"), (1, None), (9, "w " * 9000), (2, ""), (None, "lost"), (5, "<|endoftext|> x"), (-4, "é\n\n é")]
    path = str(tmp_path / "t")
    got = tokens.encoded(documents(rows, clash=True), queries.tokenizer_path(), queries.VOCABULARY, 2, path=path).collect()
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    assert sorted(map(tuple, got), key=lambda r: r[1]) == brute_tokens(encoder, ordered)
    back = {r.doc_id: r.ids for r in tokens.text_ids(tokens.read_tokens(spark, path)).collect()}
    assert all(back[k] == encoder.tokenizer.encode(t or "", add_special_tokens=False).ids + [2] for k, t in rows)


def test_tokens_of_repeated_and_no_rows(documents, encoder):
    rows = [(1, "a b"), (1, "a b"), (1, "c")]
    got = tokens.encoded(documents(rows), queries.tokenizer_path(), queries.VOCABULARY).collect()
    assert sum(r.n_tokens for r in got) == 3 + 3 + 2 and len({r.start for r in got}) == 3
    assert tokens.encoded(documents([]), queries.tokenizer_path(), queries.VOCABULARY).count() == 0


def test_tokens_of_real_rows(spark, folder, encoder):
    rows = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect())
    got = queries.op10_token_ids(spark, folder).collect()
    assert sorted(map(tuple, got)) == brute_tokens(encoder, rows)


def test_language_without_spans(spark, folder, model):
    """The pipeline's label is that of the operator, though no span is made for it."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    both = docs.select(language.found(F.col("text"), model).alias("f"), language.language_of(F.col("text"), model).alias("only"))
    assert both.count() and both.where("f.lang_pred <> only OR only IS NULL").count() == 0
    assert language.label(["some plain words", None], model, spanned=False)[2] == [[], []]
