"""Cross-parsing against substring search, and accuracy on held-out documents."""

import io
import math
import random
import zlib

import numpy as np
import pytest

from chronovox.llm import language_id, queries

SCHEMA = "doc_id long, text string, lang string"


def model_of(samples):
    out = []
    for name, text in sorted(samples.items()):
        of, byte, to = language_id.automaton(text)
        blob = io.BytesIO()
        np.savez_compressed(blob, of=of, byte=byte, to=to)
        out.append((name, len(text), blob.getvalue()))
    return out


def plain_phrases(text, sample, block):
    n = 0
    for start in range(0, len(text), block):
        part, at = text[start : start + block], 0
        while at < len(part):
            end = at + 1
            while end < len(part) and part[at : end + 1] in sample:
                end += 1
            at, n = end, n + 1
    return n


@pytest.mark.parametrize("block", [7, 256])
def test_phrases_by_substring_search(monkeypatch, block):
    monkeypatch.setattr(language_id, "BLOCK", block)
    rng = random.Random(2)
    draw = lambda n, letters: bytes(rng.choice(letters) for _ in range(n))
    samples = {"x": draw(500, b"aab c"), "y": draw(300, b"abcd "), "z": b"q"}
    parser = language_id.Parser(model_of(samples))
    pieces = [draw(rng.randint(1, 900), b"abcde q") for _ in range(30)]
    found = parser.phrases([np.frombuffer(p, np.uint8) for p in pieces])
    assert found.tolist() == [[plain_phrases(p, samples[k], block) for k in "xyz"] for p in pieces]


def test_automaton_has_every_substring_and_no_other():
    text = b"abracadabra banana"
    of, byte, to = language_id.automaton(text)
    arcs = {(a, b): c for a, b, c in zip(of.tolist(), byte.tolist(), to.tolist(), strict=True)}

    def inside(part):
        state = 0
        for c in part:
            if (state := arcs.get((state, c))) is None:
                return False
        return True

    assert all(inside(text[i:j]) for i in range(len(text)) for j in range(i, len(text) + 1))
    rng = random.Random(1)
    for _ in range(500):
        part = bytes(rng.choice(b"abrcdn ") for _ in range(rng.randint(1, 5)))
        assert inside(part) == (part in text)


def test_folding():
    fold = lambda t: language_id.folded(t).tobytes().decode()
    assert fold("It's  12 O'Clock,\nÉTÉ!") == " it s o clock été "
    assert fold("") == " " and fold("...") == " "


ENGLISH = ["the cat and the dog were there with them", "this is what they thought about the thing", "when the weather is nice then they walk there"] * 3
GERMAN = ["der hund und die katze waren nicht da", "das ist was ich nicht sagen werde und auch nicht", "wenn das wetter gut ist gehen wir in die schule"] * 3


def labelled(spark):
    rows = [(i, t, "en") for i, t in enumerate(ENGLISH)] + [(20 + i, t, "de") for i, t in enumerate(GERMAN)]
    return spark.createDataFrame([*rows, (90, "no label", None), (91, None, "fr"), (92, "123", "fr")], SCHEMA)


def test_defined_cases(spark):
    model = language_id.fit(labelled(spark))
    assert [m[0] for m in model] == ["de", "en"]
    rows = [(1, None), (2, ""), (3, "12 ²³ !?"), (4, "what is the weather"), (4, "what is the weather"), (5, "漢字"), (6, "ist das wetter gut"), (None, "the")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'en' AS lang", "1.0 AS score", "'x' AS lang_pred", "text AS __text2")
    found = [tuple(r) for r in language_id.predict(frame, model).collect()]
    assert [(i, lang) for i, lang, _ in found] == [(1, "und"), (2, "und"), (3, "und"), (4, "en"), (4, "en"), (5, "en"), (6, "de"), (None, "en")]  # of unknown characters: least text learned from
    assert [s for *_, s in found[:3]] == [0.0] * 3 and all(0 < s <= 1 for *_, s in found[3:])
    assert language_id.predict(frame.limit(0), model).count() == 0
    nothing = language_id.fit(labelled(spark).limit(0))
    assert nothing == [] and {tuple(r)[1:] for r in language_id.predict(frame, nothing).collect()} == {("und", 0.0)}


def test_ties_go_to_the_first_name_and_copies_count_once(spark):
    rows = [(i, "same text for both", lang) for i, lang in enumerate(["b", "a"] * 50)]
    model = language_id.fit(spark.createDataFrame(rows, SCHEMA))
    assert [m[1] for m in model] == [len(" same text for both ")] * 2
    assert [tuple(r) for r in language_id.predict(spark.createDataFrame([(1, "same", None)], SCHEMA), model).collect()] == [(1, "a", 0.5)]


def test_the_sample_is_bounded(spark):
    rng = random.Random(4)
    rows = [(i, " ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(600)), f"l{i % 3}") for i in range(90)]
    frame = spark.createDataFrame(rows, SCHEMA)
    assert [m[1] for m in language_id.fit(frame, per_language=5000)] == [5000] * 3
    assert [m[1] for m in language_id.fit(frame, in_all=3000)] == [1000] * 3
    assert language_id.fit(frame.repartition(5), per_language=5000) == language_id.fit(frame, per_language=5000)


def test_a_long_text(spark):
    model = language_id.fit(labelled(spark))
    text = "the weather and the dog were there\n" * 90_000
    (found,) = language_id.predict(spark.createDataFrame([(1, text, None)], SCHEMA), model).collect()
    assert found["lang_pred"] == "en" and found["score"] == 1.0


def test_the_query(spark):
    folder = "/root/testdata/sf0.01"
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    found = queries.op13_language_id(spark, folder).collect()
    assert sorted(r["doc_id"] for r in found) == sorted(docs)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in found)
    judged = [(r["lang_pred"], docs[r["doc_id"]]["lang"]) for r in found if r["held_out"] and docs[r["doc_id"]]["lang"] and any(map(str.isalpha, docs[r["doc_id"]]["text"] or ""))]
    assert len(judged) > 100 and sum(a == b for a, b in judged) >= 0.99 * len(judged)
    assert all(math.isfinite(r["score"]) and 0 <= r["score"] <= 1 for r in found)
