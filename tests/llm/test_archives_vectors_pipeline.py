"""WARC round trips, exact top-k search and the whole pipeline."""

import base64
import glob
import hashlib
import math
import re
import os
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from test_text_ops import plain_components, plain_dedup, plain_fingerprint, plain_measures
from tokenizers import Tokenizer

from chronovox.llm import common, secret_scan, top_k, warc

PAGES = "page_id long, url string, html string"


def payloads():
    rng = random.Random(1)
    texts = ["", "a", "é" * 9000, "x\r\n\r\nWARC/1.1\r\n" * 900, "0\r\n\r\n", "<p>1</p>"]
    return texts + ["".join(rng.choice("ab\r\n é") for _ in range(rng.randint(0, 40_000))) for _ in range(12)]


def test_chunks():
    for text in payloads():
        raw = text.encode()
        assert warc.unchunked(warc.chunked(raw, 100)) == raw
    assert warc.unchunked(b"3;x=y\r\nabc\r\n0\r\nTrailer: 1\r\n\r\n") == b"abc"
    with pytest.raises(ValueError):
        warc.unchunked(b"5\r\nabc\r\n0\r\n\r\n")


def names_in(folder):
    """Every record of the archives, read member by member; the records' names and those that revisits give."""
    own, kinds, asked = [], {}, []
    for path in glob.glob(f"{folder}/part-*"):
        raw, ends = open(path, "rb").read(), []
        while raw:
            one = zlib.decompressobj(31)
            data = one.decompress(raw)
            assert one.eof
            raw = one.unused_data
            ends.append(data)
        assert ends[-1] == b"" and b"" not in ends[:-1]
        for data in ends[:-1]:
            [(head, _)] = warc.parsed([data])  # a member is a record
            assert "warc-target-uri" in head and "warc-date" in head
            own.append(head["warc-record-id"])
            kinds[own[-1]] = head["warc-type"]
            asked += [head[k] for k in ("warc-refers-to", "warc-segment-origin-id") if k in head]
    assert len(set(own)) == len(own) and all(kinds[name] == "response" for name in asked)
    return kinds, asked


@pytest.mark.parametrize("segment", [8192, 700])
def test_round_trip(spark, tmp_path, segment):
    texts = payloads()
    rows = [(i, f"http://a/{i} b\nc" if i % 3 else None, t) for i, t in enumerate([*texts, *texts[:5], None])] + [(None, None, "é" * 9000), (3, None, "again 3"), (40, "u", "same row"), (40, "u", "same row")]
    pages = spark.createDataFrame([(*r, "x") for r in rows], PAGES + ", record string").repartition(5)
    folder = f"file://{tmp_path}/warc"
    warc.write(pages, folder, segment=segment, file_bytes=20_000)
    kinds, asked = names_in(f"{tmp_path}/warc")
    assert list(kinds.values()).count("revisit") == 7 and len(asked) > 7
    assert max(map(os.path.getsize, glob.glob(f"{tmp_path}/warc/part-*"))) < 40_000
    last = {}
    for i, _, t in rows:
        if i is not None:
            last[t or ""] = max(last.get(t or "", -1), i)
    want = []
    for i, _, t in rows:
        raw, target = (t or "").encode(), last[t or ""]
        same = i == target
        want.append((i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "response" if same else "revisit", None if same else target))
    key = lambda r: (r[0] is None, *map(str, r))
    assert sorted(map(tuple, warc.read(spark, folder).collect()), key=key) == sorted(want, key=key)


def test_small_payloads_are_not_matched_and_empty_table(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcdef"), (4, "u", "abcdef")], PAGES)
    warc.write(pages, f"file://{tmp_path}/a", least_bytes=3)
    assert {r.page_id: r.refers_to for r in warc.read(spark, f"file://{tmp_path}/a").collect()} == {1: None, 2: None, 3: 4, 4: None}
    warc.write(spark.createDataFrame([], PAGES), f"file://{tmp_path}/b")
    assert warc.read(spark, f"file://{tmp_path}/b").count() == 0


def test_damaged_archives_raise():
    good = b"".join(r + b"\r\n\r\n" for r in warc.records_of("urn:page:1:0", "u", b"abc", None, 8192, 10))
    assert len(list(warc.parsed([good[:20], good[20:]]))) == 1
    with pytest.raises(ValueError):
        list(warc.parsed([good[:-3]]))
    with pytest.raises(ValueError):
        list(warc.parsed([b"xx" + good]))
    packed = warc.member(good) + warc.NOTHING + warc.member(good)
    assert b"".join(warc.inflated(packed)) == 2 * good and len(list(warc.parsed(warc.inflated(packed)))) == 2
    with pytest.raises(ValueError):
        list(warc.inflated(packed[:-3]))


# top-k


def brute(rows, k, every):
    whole = [(i, n, [math.floor(256 * float(np.float32(x))) for x in v]) for n, (i, v) in enumerate(rows) if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, n, v in whole:
        if i is not None and i % every == 0:
            scores = sorted((-sum(a * b for a, b in zip(v, w)), math.inf if j is None else j) for j, m, w in whole if m != n)
            out += [(i, r, None if j == math.inf else j, -s) for r, (s, j) in enumerate(scores[:k], 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize("skewed", [False, True])
def test_top_k_against_brute_force(spark, skewed, monkeypatch):
    for name, value in (("TILE", 32), ("ROWS", 5), ("FIRST", 2), ("SEED", 16)):
        monkeypatch.setattr(top_k, name, value)
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 12)) * (np.exp(-np.arange(12)) if skewed else 1) * rng.lognormal(0, 1 if skewed else 0.1, (400, 1))
    x[50:70] = x[10]  # ties
    rows = [(i, [float(np.float32(v)) for v in r]) for i, r in enumerate(x)]
    rows += [(500, None), (510, [None] + [1.0] * 11), (520, [math.nan] * 12), (530, [math.inf] * 12), (None, rows[3][1])]
    frame = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, score int").repartition(6)
    got = top_k.top_k(frame, 5, 10, part_bytes=50 * 96, block_bytes=17 * 96).collect()
    assert sorted([tuple(r) for r in got], key=str) == brute(rows, 5, 10)


def test_bounds_spare_most_pairs_of_a_decaying_spectrum():
    rng = np.random.default_rng(5)
    x = np.floor(256 * rng.normal(size=(4000, 64)) * 0.9 ** np.arange(64) @ np.linalg.qr(rng.normal(size=(64, 64)))[0])
    x = x[np.argsort(-(x**2).sum(axis=1), kind="stable")]
    space = top_k.Space(x.T @ x)
    everything = top_k.Vectors(x, np.arange(4000), np.arange(4000), space)
    queries = top_k.Vectors(x[::40], np.arange(0, 4000, 40), np.arange(0, 4000, 40), space)
    best = top_k.Best(100, 5)
    scored = top_k.search(best, np.full(100, top_k.NONE), queries, everything, space)
    score = x[::40] @ x.T
    score[np.arange(100), np.arange(0, 4000, 40)] = -np.inf
    assert (best.score == -np.sort(-score, axis=1)[:, :5]).all()
    assert scored < 0.5 * 100 * 4000


@pytest.mark.parametrize("size", [1.0, 1e3, 1e5, 1e6])
def test_scores_of_large_components_are_exact(spark, size):
    x = np.random.default_rng(8).normal(size=(60, 64)) * size
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
    got = top_k.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), 5, 10).collect()
    scores = {i: sorted((-sum(math.floor(256 * a) * math.floor(256 * b) for a, b in zip(v, w)), j) for j, w in rows if j != i) for i, v in rows if i % 10 == 0}
    assert sorted(map(tuple, got)) == [(i, r, j, -s) for i, best in scores.items() for r, (s, j) in enumerate(best[:5], 1)]


def test_a_score_beyond_a_long_raises(spark):
    for value in (1e30, 1e200, 3e7):
        rows = [(i, [value] * 64) for i in range(4)]
        with pytest.raises(Exception, match="64 bits"):
            top_k.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), 5, 2).collect()


def test_blocks_go_only_to_parts_that_can_reach_them(spark, monkeypatch):
    monkeypatch.setattr(top_k, "SEED", 32)
    x = np.abs(np.random.default_rng(9).normal(size=(600, 8))) * 100 * (0.99 ** np.arange(600))[:, None]
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
    kept = {}
    written = top_k.common.written
    monkeypatch.setattr(top_k.common, "written", lambda df, name: kept.setdefault(name, written(df, name)))
    got = top_k.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), 3, 7, part_bytes=40 * 64, block_bytes=20 * 64).collect()
    parts, blocks = ([r[c] for r in kept[name].collect()] for name, c in (("candidates", "longest"), ("queries", "wanted")))
    assert 0 < sum(longest >= wanted for longest in parts for wanted in blocks) < 0.5 * len(parts) * len(blocks)
    best = {q: sorted((-sum(math.floor(256 * a) * math.floor(256 * b) for a, b in zip(rows[q][1], w)), j) for j, w in rows if j != q)[:3] for q in range(0, 600, 7)}
    assert sorted(map(tuple, got)) == [(q, r, j, -s) for q, found in best.items() for r, (s, j) in enumerate(found, 1)]


def test_top_k_of_few_rows(spark):
    schema = "vec_id long, embedding array<float>"
    assert top_k.top_k(spark.createDataFrame([], schema)).count() == 0
    assert top_k.top_k(spark.createDataFrame([(0, [1.0, 2.0])], schema)).count() == 0
    got = top_k.top_k(spark.createDataFrame([(0, [1.0, 2.0]), (1, [0.0, 0.0]), (2, None)], schema)).collect()
    assert [tuple(r) for r in got] == [(0, 1, 1, 0)]
    same = top_k.top_k(spark.createDataFrame([(0, [1.0, 0.0]), (0, [1.0, 0.0]), (7, [2.0, 0.0])], schema)).collect()
    assert sorted(tuple(r) for r in same) == [(0, 1, 7, 131072), (0, 1, 7, 131072), (0, 2, 0, 65536), (0, 2, 0, 65536)]


# pipeline


def test_pipeline_against_brute_force(spark, tmp_path):
    import corpus_pipeline

    rng = random.Random(2)
    # words of few syllables: with letters at random, the n-grams of sixty labelled documents would say nothing about others
    word = lambda: "".join(rng.choices(["an", "th", "er", "on", "in", "ti", "ou", "ed"], k=rng.randint(1, 4)))
    texts = []
    for i in range(120):
        body = " ".join(word() for _ in range(rng.randint(25, 120)))
        texts.append(body + "\nShared line of the site" * (i % 2) + "\nsecret = abcdef0123456789abcdef" * (i % 7 == 0))
    texts += [texts[3]] * 4 + [None, "", "too short"] + [" ".join(word() + "***" for _ in range(60)) for _ in range(20)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(i, int(i < 120), 0) for i in [*range(0, 120, 2), *range(127, 147, 2)]], "doc_id long, quality int, toxic int")
    docs.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    at = spark.read.parquet(f"{tmp_path}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        at = stage(spark, at, str(tmp_path))
        at.write.parquet(f"{tmp_path}/{name}")
        at = spark.read.parquet(f"{tmp_path}/{name}")
        seen[name] = {r.doc_id: r for r in at.collect()}
        if name != "packing":
            assert at.columns == docs.columns
    # 1: rules by brute force; the ratio rejects just the symbol-ridden documents
    kept = [i for i, t in enumerate(texts) if (m := plain_measures(t or ""))["n_words"] >= 20 and 100 * m["n_repeat_words"] <= 30 * m["n_words"] and i < 124]
    assert sorted(seen["quality rules"]) == kept
    # 2
    clean = dict(zip(kept, [x[2] for x in plain_dedup([texts[i] for i in kept], 10)]))
    assert {i: r.text for i, r in seen["line dedup"].items()} == clean
    assert all(r.n_chars == len(r.text) for r in seen["line dedup"].values())
    # 3
    root = plain_components([plain_fingerprint(clean[i]) for i in kept], 4)
    single = sorted({kept[r] for r in root})
    assert sorted(seen["near duplicates"]) == single and len(single) < len(kept)
    # 4
    hidden = {i: clean[i].replace("secret = abcdef0123456789abcdef", "[assign]") for i in single}
    assert {i: r.text for i, r in seen["secret scan"].items()} == hidden
    assert not any(secret_scan.secrets_in(t) for t in hidden.values())
    # 5
    library, rows = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), at.collect()
    for i in single:
        ids = [*library.encode(hidden[i], add_special_tokens=False).ids, 2]
        own = sorted((r for r in rows if r.doc_id == i), key=lambda r: r.piece)
        assert [r.ids_crc32 for r in own] == [zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes()) for r in own] and sum(r.length for r in own) == len(ids)
    assert len({r.sequence_id for r in rows}) <= 1 + 1.1 * sum(r.length for r in rows) / 1024
    whole = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {(r.doc_id, r.piece, r.ids_crc32) for r in whole} == {(r.doc_id, r.piece, r.ids_crc32) for r in rows}


def test_stages_with_clashing_names_repeated_and_null_ids(spark, tmp_path):
    import corpus_pipeline

    rng = random.Random(4)
    word = lambda: "".join(rng.choices(["an", "th", "er", "on"], k=rng.randint(1, 4)))
    body = [" ".join(word() for _ in range(60)) for _ in range(6)]
    ids = [None, None, 3, 3, 2**60, 9]
    more = ["row", "whole", "place", "key", "line", "lost", "secrets", "score", "item", "length", "fingerprint", "component", "h"]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in more)
    docs = spark.createDataFrame([(i, t, "en", "s", len(t), *more) for i, t in zip([*ids, 7], [*body, body[0]])], schema).repartition(2)
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    at = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        at = stage(spark, at, str(tmp_path))
        assert at.columns == docs.columns, name
        rows = at.collect()
        assert all(r[c] == c for r in rows for c in more), name
        assert sorted(r.text for r in rows) == sorted(body + [body[0]] * (name in ("quality rules", "line dedup"))), name
    packed = corpus_pipeline.STAGES[-1][1](spark, at, str(tmp_path)).collect()
    assert len(packed) == 6 and len({(r.sequence_id, r.offset) for r in packed}) == 6


def python_steps(plan) -> int:
    """The most steps in Python that one Spark stage of the plan has in a row, each with a worker of its own."""
    most = 0

    def walk(node, above):
        nonlocal most
        if node.nodeName() == "AdaptiveSparkPlan":
            node = node.inputPlan()
        above = 0 if "Exchange" in node.nodeName() else above + (node.nodeName() == "MapInArrow")
        most = max(most, above)
        for i in range(node.children().size()):
            walk(node.children().apply(i), above)

    walk(plan, 0)
    return most


def test_no_stage_of_the_pipeline_needs_two_python_workers_a_core(spark, tmp_path, monkeypatch):
    import corpus_pipeline

    rng = random.Random(6)
    texts = [" ".join(rng.choices(["an", "other", "into", "tied"], k=60)) for _ in range(20)]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    steps, plain = {}, common.written

    def written(df, name, **options):
        steps[name] = python_steps(df._jdf.queryExecution().executedPlan())
        return plain(df, name, **options)

    monkeypatch.setattr(common, "written", written)
    last = corpus_pipeline.run(spark, str(tmp_path))
    assert steps["quality-rules"] == steps["pieces"] == python_steps(last._jdf.queryExecution().executedPlan()) == 1
    assert max(steps.values()) == 1, steps
    assert sorted({r.doc_id for r in last.collect()}) == list(range(20))


def test_no_payload_goes_through_a_join_by_digest(spark, monkeypatch, tmp_path):
    """Digests meet narrow rows only; payloads meet the marks by row."""
    plans = []
    written = warc.common.written

    def kept(df, name):
        if name == "revisits":
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return written(df, name)

    monkeypatch.setattr(warc.common, "written", kept)
    pages = spark.createDataFrame([(i, f"u{i}", "same" if i % 2 else f"own {i}") for i in range(20)] + [(None, "u", "same")], "page_id long, url string, html string")
    warc.write(pages, f"{tmp_path}/out")
    found = {r["page_id"]: (r["record_type"], r["refers_to"]) for r in warc.read(spark, f"{tmp_path}/out").collect()}
    assert found == {i: ("revisit", 19) if i % 2 and i != 19 else ("response", None) for i in range(20)} | {None: ("revisit", 19)}
    (plan,) = plans
    read = re.findall("ReadSchema: (.*)", plan)
    assert len(read) >= 2 and all("digest" in r and "html" not in r for r in read)
