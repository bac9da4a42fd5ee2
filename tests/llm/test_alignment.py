"""Linked tokens of two tokenizers against the libraries' own ids and dictionaries."""

import hashlib
from collections import defaultdict

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from chronovox.llm import alignment, bpe, queries

BYTE, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string"


def libraries():
    a, b = Tokenizer.from_file(BYTE), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    a.encode_special_tokens = True
    letters = {c: i for i, c in enumerate(bpe.byte_letters())}
    ids_a = lambda text: [(i, bytes(letters[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]

    def ids_b(text):
        pieces = [(i, b.id_to_piece(i)) for i in b.encode(text)]
        return [(i, bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()) for i, p in pieces]

    return ids_a, ids_b


def ends_of(tokens):
    at, out = 0, []
    for _, raw in tokens:
        at += len(raw)
        out.append(at)
    return out


def answers(texts):
    ids_a, ids_b = libraries()
    groups, holders = [], defaultdict(int)
    for text in texts:
        found = []
        a, b = (ids_a(text), ids_b(text)) if text else ([], [])
        whole = (" " + (text or "")).encode()
        if a and b"".join(x for _, x in a) == whole == b"".join(x for _, x in b):
            ends_a, ends_b = ends_of(a), ends_of(b)
            start_a = start_b = 0
            for end in sorted(set(ends_a) & set(ends_b)):
                to_a, to_b = ends_a.index(end, start_a) + 1, ends_b.index(end, start_b) + 1
                found.append(([i for i, _ in a[start_a:to_a]], [i for i, _ in b[start_b:to_b]]))
                start_a, start_b = to_a, to_b
        groups.append(found)
        for pair in {(x, y) for ga, gb in found for x in ga for y in gb}:
            holders[pair] += 1
    best = defaultdict(int)
    for (x, _), n in holders.items():
        best[x] = max(best[x], n)
    out = []
    for found in groups:
        links = [(x, y) for ga, gb in found for x in ga for y in gb]
        written = ";".join(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)) for ga, gb in found)
        out.append(
            (sum(len(g) for g, _ in found), sum(len(g) for _, g in found), len(found), len(links), hashlib.sha256(written.encode()).hexdigest() if found else "", sum(holders[p] == best[p[0]] for p in links), sum(holders[p] for p in links))
        )
    return out


def rows_of(df, key="doc_id"):
    names = ["n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum"]
    return sorted((r[key], *(r[c] for c in names)) for r in df.collect())


TEXTS = [
    "The unbelievable cat sat.", "the cat", None, "", "a ▁ mark", "<|endoftext|> and <s> stay </s> plain <unk>", "  two  spaces \n\t tab \n  x", "naïve café 漢字かな 🙂🙂 é", "x\n y \n\n  z", "don't we've I'LL",
    "1234567 89", " ", "\n", "a\x00b \x1c c\x85d\xa0 e　f", "…—“quoted” ½ ﬁ", "The unbelievable cat sat.", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa bbb", " lead", "trail ", "���",
]


@pytest.mark.parametrize(("block", "together", "part"), [(1 << 16, 1 << 20, 1_000_000), (2, 5, 2)])
def test_against_the_libraries(spark, monkeypatch, block, together, part):
    monkeypatch.setattr(alignment, "BLOCK", block)
    monkeypatch.setattr(alignment, "TOGETHER", together)
    pair = alignment.Pair(BYTE, PIECES)
    ids_a, ids_b = libraries()
    for text in TEXTS:
        if text and (found := pair.encode(text)) is not None:
            assert found[0].tolist() == [i for i, _ in ids_a(text)] and found[1].tolist() == [i for i, _ in ids_b(text)], text
    frame = spark.createDataFrame(list(enumerate(TEXTS)), SCHEMA).selectExpr("doc_id", "text", "doc_id AS row", "text AS a", "1 AS part")
    assert rows_of(alignment.align(frame.repartition(3), BYTE, PIECES, part_postings=part)) == [(i, *x) for i, x in enumerate(answers(TEXTS))]


def test_large_groups_by_distinct_ids(monkeypatch):
    pair = alignment.Pair(BYTE, PIECES)
    found = pair.encode("unbelievable " * 20 + "ÿþ漢字🙂 " * 7)
    ends = alignment.groups(pair, *found)
    want = alignment.postings(*found, *ends)
    monkeypatch.setattr(alignment, "LAID_OUT", 0)
    got = alignment.postings(*found, *ends)
    assert all((x == y).all() for x, y in zip(want[:2], got[:2], strict=True)) and want[2] == got[2] == want[1].sum()


def test_empty_table_repeated_and_string_ids(spark):
    assert alignment.align(spark.createDataFrame([], SCHEMA), BYTE, PIECES).count() == 0
    texts = ["same words here"] * 4 + ["other"]
    rows = spark.createDataFrame([("x", t) for t in texts], "key string, body string")
    assert rows_of(alignment.align(rows, BYTE, PIECES, "key", "body"), "key") == sorted(("x", *a) for a in answers(texts))


def test_a_long_text_and_one_word(spark):
    texts = ["long words and more " * 100_000, "z" * 300_000]
    found = rows_of(alignment.align(spark.createDataFrame(list(enumerate(texts)), SCHEMA), BYTE, PIECES))
    assert found == [(i, *x) for i, x in enumerate(answers(texts))]


def test_a_last_space_is_no_block_of_its_own(monkeypatch):
    monkeypatch.setattr(alignment, "BLOCK", 4)
    pair, (ids_a, ids_b) = alignment.Pair(BYTE, PIECES), libraries()
    for text in ("trail ", "a trail ", "trail  ", "trail \n"):
        found = pair.encode(text)
        assert found and (found[0].tolist(), found[1].tolist()) == ([i for i, _ in ids_a(text)], [i for i, _ in ids_b(text)]), text


@pytest.mark.parametrize(("block", "memory", "longest"), [(1 << 16, 1 << 26, 64), (2, 1 << 26, 64), (40, 2_000, 3), (1 << 16, 0, 0)])
def test_words_one_by_one_make_the_whole_text(monkeypatch, block, memory, longest):
    pair = alignment.Pair(BYTE, PIECES)
    texts = [*TEXTS, "the cat \n sat", "unbelievable ÿþ漢字🙂", *TEXTS[::-1], "the unbelievable cat sat " * 20]
    want = []
    for text in texts:
        if not text or (found := pair.encode(text)) is None:
            want.append(((0, 0, 0, 0, ""), [], []))
            continue
        ends = alignment.groups(pair, *found)
        keys, times, links = alignment.postings(*found, *ends)
        written = "".join(alignment.written(pair, *found, *ends))[:-1]
        want.append(((len(found[0]), len(found[1]), len(ends[0]), links, hashlib.sha256(written.encode()).hexdigest()), keys.tolist(), times.tolist()))
    for name, value in (("BLOCK", block), ("MEMORY", memory), ("LONGEST", longest), ("LAID_OUT", 2)):
        monkeypatch.setattr(alignment, name, value)
    words = alignment.Words(pair)
    assert [(n, k.tolist(), t.tolist()) for n, k, t in words.documents(texts)] == want


def test_known_words_are_not_encoded_again(monkeypatch):
    pair, encoded = alignment.Pair(BYTE, PIECES), []
    encode = pair.encode
    monkeypatch.setattr(pair, "encode", lambda text: encoded.append(text) or encode(text))
    words = alignment.Words(pair)
    assert len(list(words.documents(["the cat sat on the mat", "on the mat the cat sat "] * 500 + ["a cat"]))) == 1001
    assert sorted(w for text in encoded for w in text.split()) == ["a", "cat", "mat", "on", "sat", "sat", "the"]
    # when memory is full, words used more than once stay
    monkeypatch.setattr(alignment, "MEMORY", words.held + 800)
    list(words.documents([f"the {i} cat" for i in range(100)]))
    for i in range(100, 200):
        list(words.documents([f"the {i} cat"]))
    assert "the" in words.known and "cat" in words.known and "7" not in words.known and words.held <= alignment.MEMORY + 1000
    assert len(words.texts) < 20


def test_the_query(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    assert rows_of(queries.op12_alignment(spark, folder)) == sorted((r[0], *a) for r, a in zip(docs, answers([r[1] for r in docs]), strict=True))
