"""Token counts, line dedup, quality rules and near duplicates against brute force."""

import hashlib
import itertools
import random
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from tokenizers import Tokenizer, models, pre_tokenizers

from chronovox.llm import line_dedup, quality, simhash, token_count

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
BLANK = r"[\x20\x09-\x0D]"


def documents(spark, texts, ids=None):
    return spark.createDataFrame([(i, t, None, None, None) for i, t in zip(ids or range(len(texts)), texts)], SCHEMA)


# token counts


def unigram(vocabulary, byte_pieces):
    t = Tokenizer(models.Unigram([("<unk>", 0.0), *vocabulary], unk_id=0, byte_fallback=byte_pieces))
    t.pre_tokenizer = pre_tokenizers.Metaspace(prepend_scheme="always", split=True)
    return t


@pytest.mark.parametrize("byte_pieces", [False, True])
def test_counts_equal_the_library(byte_pieces):
    rng = random.Random(4)
    for turn in range(40):
        pieces = {"".join(rng.choice("abc▁") for _ in range(rng.randint(1, 4))) for _ in range(20)} | {"a", "▁"}
        vocabulary = [(p, -float(rng.randint(1, 6))) for p in sorted(pieces)]  # few values, so that ties are frequent
        if byte_pieces:
            vocabulary += [(f"<0x{b:02X}>", -20.0) for b in range(256)]
        library = unigram(vocabulary, byte_pieces)
        own = token_count.Unigram([v for v in vocabulary if not v[0].startswith("<0x")] + ([("\0never", -20.0)] if byte_pieces else []), byte_pieces)
        for _ in range(60):
            text = "".join(rng.choice("aabbcc dé🙂▁") for _ in range(rng.randint(0, 14)))
            assert own.count(text) == len(library.encode(text, add_special_tokens=False).ids), (turn, text)


def test_count_frame(spark):
    path = public_tokenizers.path("piece_bpe_32k.model")
    vocabulary, byte_pieces = token_count.pieces_of(path)
    assert byte_pieces and len(vocabulary) > 30_000
    library = unigram(vocabulary + [(f"<0x{b:02X}>", -1e6) for b in range(256)], True)
    texts = ["Hello world, how are  you?", "", None, "naïve 漢字 tokens", "x" * 400]
    got = {r.doc_id: r.n_tokens for r in token_count.count_tokens(documents(spark, texts).withColumnRenamed("lang", "n_tokens"), path).collect()}
    library.pre_tokenizer = pre_tokenizers.Metaspace(prepend_scheme="always", split=False)
    assert got == {i: len(library.encode(t or "", add_special_tokens=False).ids) for i, t in enumerate(texts)} and got[1] == got[2] == 0
    assert token_count.count_tokens(documents(spark, []), path).count() == 0


def whole_text_library(vocabulary):
    library = Tokenizer(models.Unigram([("<unk>", 0.0), *vocabulary, *[(f"<0x{b:02X}>", -1e6) for b in range(256)]], unk_id=0, byte_fallback=True))
    library.pre_tokenizer = pre_tokenizers.Metaspace(prepend_scheme="always", split=False)
    return library


def test_a_word_of_a_million_characters():
    own = token_count.Unigram([("a", -1.0), ("aa", -1.5), ("\u2581", -1.0)], False)
    assert own.count("a" * 1_000_000) == 500_001


def test_pieces_of_several_marks_are_in_reach():
    path = public_tokenizers.path("piece_bpe_32k.model")
    vocabulary, _ = token_count.pieces_of(path)
    library = whole_text_library(vocabulary)
    own = token_count.loaded(path)
    for text in ("def f():\n" + " " * 8 + "return  1" + " " * 16, "   a b", "a" + " " * 40 + "b  ", " ", "  ", "one two", "\u2581\u2581x y"):
        assert own.count(text) == len(library.encode(text, add_special_tokens=False).ids), text
    with pytest.raises(ValueError):
        token_count.Unigram([("a\u2581", -1.0), ("a", -1.0)], False, runs=True)


# line dedup


def plain_dedup(texts, least_documents, keep="none"):
    key = lambda x: re.sub("[A-Z]", lambda m: m[0].lower(), re.sub(f"^{BLANK}+|{BLANK}+$", "", x))
    lines = [(t or "").split("\n") for t in texts]
    found = Counter(k for doc in lines for k in {key(x) for x in doc} if k)
    frequent, first, out = {k for k, n in found.items() if n >= least_documents}, set(), []
    for doc in lines:
        kept = []
        for x in doc:
            if key(x) not in frequent or keep == "first" and key(x) not in first:
                kept.append(x)
                first.add(key(x))
        out.append((len(doc), len(doc) - len(kept), "\n".join(kept)))
    return out


@pytest.mark.parametrize("keep", ["none", "first"])
@pytest.mark.parametrize("limits", [{}, {"sent_bytes": -1}])
def test_lines_against_brute_force(spark, keep, limits, monkeypatch):
    monkeypatch.setattr(line_dedup, "HASHES_PER_SHARD", 1500)
    monkeypatch.setattr(line_dedup, "HELD_HASHES", 300)
    rng = random.Random(6)
    pool = ["Same LINE", " same line\t", "other", "É", "é", "", "   ", "rare", "x y\x0b", "long " * 300]
    texts = ["\n".join(rng.choice([*pool, f"own {rng.random()}"]) for _ in range(rng.randint(1, 6))) for _ in range(80)] + ["", None, "\n", "A\r\nB"]
    texts.append("\n".join(f"line {i}" for i in range(20_000)))
    docs = documents(spark, texts).withColumnsRenamed({"source": "n_lines", "lang": "row", "n_chars": "lost"}).repartition(7)
    got = {r.doc_id: (r.n_lines, r.n_dropped, r.text) for r in line_dedup.drop_repeated_lines(docs, 4, keep=keep, **limits).collect()}
    assert got == dict(enumerate(plain_dedup(texts, 4, keep)))


def test_a_full_filter_suspects_more_and_changes_nothing(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "BITS_PER_KEY", 0.001)
    texts = [f"a\nb{i}\nc{i % 3}" for i in range(3000)]
    got = {r.doc_id: (r.n_lines, r.n_dropped, r.text) for r in line_dedup.drop_repeated_lines(documents(spark, texts).repartition(3), 4).collect()}
    assert got == dict(enumerate(plain_dedup(texts, 4)))


@pytest.mark.parametrize("limits", [{}, {"sent_bytes": -1}])
def test_the_first_occurrence_is_one_line_of_any_type_of_id(spark, limits):
    for kind, ids, least in (("string", ["b", "a", "a", "c"], "a"), ("long", [5, 1, 1, 2], 1), ("string", ["10", "9", "9", None], None)):
        rows = [(i, "same\nsame", 1) for i in ids]
        frame = spark.createDataFrame(rows, f"doc_id {kind}, text string, row int").repartition(3)
        got = line_dedup.drop_repeated_lines(frame, 3, keep="first", **limits).collect()
        assert sum(r.n_lines - r.n_dropped for r in got) == 1
        assert [r.doc_id for r in got if r.text] == [least]
    none = line_dedup.drop_repeated_lines(spark.createDataFrame([("x", "a", 1)] * 3, "doc_id string, text string, row int"), 3, **limits)
    assert {r.text for r in none.collect()} == {""}


def test_lines_keep_columns_and_nulls(spark):
    docs = documents(spark, ["a\nb", None, "a", "a"])
    clean = line_dedup.drop_repeated_lines(docs, 3, counts=False)
    assert clean.schema == docs.schema and {r.doc_id: r.text for r in clean.collect()} == {0: "b", 1: None, 2: "", 3: ""}
    assert line_dedup.drop_repeated_lines(documents(spark, [])).count() == 0
    same = documents(spark, ["a"] * 3, [1, 1, None])
    assert [r.n_dropped for r in line_dedup.drop_repeated_lines(same, 3).collect()] == [1, 1, 1]


# quality


def plain_measures(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = defaultdict(list)
    for i in range(len(words) - 7):
        windows[tuple(words[i : i + 8])].append(i)
    marked = {j for at in windows.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
    lines, seen, same = text.split("\n"), set(), 0
    for x in lines:
        if re.search(r"[^\x20\x09-\x0D]", x):
            same += x in seen
            seen.add(x)
    return {"n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)), "n_dup_lines": same, "n_repeat_words": len(marked)}


def test_measures_against_brute_force(monkeypatch):
    monkeypatch.setattr(quality, "BLOCK", 2000)
    rng = random.Random(8)
    texts = ["", " \n", "a", "é ü\x0b漢 字", "x " * 5000]
    for _ in range(150):
        words = [rng.choice(["a", "b", "ab", "É", "#*", "c|<", "long" * 9]) for _ in range(rng.choice([3, 9, 30, 200]))]
        texts.append("".join(w + rng.choice([" ", "  ", "\n", "\t", "\xa0"]) for w in words * rng.randint(1, 2)))
    got = quality.Model(np.zeros(quality.BUCKETS), -np.inf).judged([t.encode() for t in texts])
    for i, t in enumerate(texts):
        want = plain_measures(t)
        assert {m: int(got[m][i]) for m in quality.METRICS} == want, t[:80]
        assert got["base_failed"][i] == (want["n_words"] < 20 or 100 * want["n_repeat_words"] > 30 * want["n_words"])


def made_corpus(n=240):
    rng = random.Random(9)
    syllables = ["an", "th", "er", "on", "in", "ti", "ou", "ed"]
    texts, good = [], []
    for i in range(n):
        words = ["".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(rng.randint(30, 90))]
        good.append(i % 5 != 0)
        texts.append(" ".join(words if good[-1] else [w + rng.choice(["***", "%%%", "&&&"]) for w in words]))
    return texts, good


def test_likelihood_ratio_on_held_out_documents(spark):
    texts, good = made_corpus()
    docs = documents(spark, [*texts, None, "short"]).withColumnRenamed("lang", "score")
    labels = spark.createDataFrame([(i, int(good[i]), 0) for i in range(0, len(texts), 2)] + [(None, 1, 0), (0, None, None)], "doc_id long, quality int, toxic int")
    model = quality.fit(docs, labels)
    rows = {r.doc_id: r for r in quality.assess(docs, model).collect()}
    assert all(rows[i].kept == good[i] for i in range(1, len(texts), 2))
    assert not rows[len(texts)].kept and not rows[len(texts) + 1].kept
    # the scores by counting n-grams one by one
    def grams(t):
        t = re.sub(b"[A-Z]", lambda m: m[0].lower(), t.encode())
        return [t[i : i + 4] for i in range(len(t) - 3)]
    bucket = lambda g: int(quality.common.doubling_hash(np.array([int.from_bytes(g, "big")], np.uint64), 4)[0] >> np.uint64(48))
    raw, target = Counter(), Counter()
    labelled_good = {r.doc_id for r in quality.labelled(labels, 1000).collect() if r.good and r.fitted}
    assert 20 < len(labelled_good) < 80
    for i, t in enumerate([*texts, "", "short"]):
        own = Counter(map(bucket, grams(t)))
        raw += own
        target += own if i in labelled_good else Counter()
    n, size = quality.BUCKETS, (sum(target.values()), sum(raw.values()))
    for i in (0, 1, 7):
        g = [bucket(x) for x in grams(texts[i])]
        want = sum(np.log((target[b] + 1) / (size[0] + n)) - np.log((raw[b] + 1) / (size[1] + n)) for b in g) / len(g)
        assert rows[i].score == pytest.approx(want, rel=1e-9)
    kept = quality.keep_good(docs, model)
    assert kept.schema == docs.schema and {r.doc_id for r in kept.collect()} == {i for i, r in rows.items() if r.kept}


def test_quality_without_labels_or_documents(spark):
    texts, _ = made_corpus(10)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    docs = documents(spark, texts)
    assert all(r.kept for r in quality.assess(docs, quality.fit(docs, none)).collect())
    empty = documents(spark, [])
    assert quality.assess(empty, quality.fit(empty, none)).count() == 0


def test_threshold_spares_the_good():
    scores, good = np.array([0.1, 0.2, 0.0, -2.0, -3.0, -2.5]), np.array([True, True, True, False, False, False])
    assert -2 < quality.threshold_of(scores, good, np.ones(6, int)) < 0.0
    assert quality.threshold_of(scores, ~good & False, np.ones(6, int)) == -np.inf


def test_threshold_survives_wrong_labels():
    rng = np.random.default_rng(1)
    scores, good = np.concatenate([rng.normal(0, 0.1, 1700), rng.normal(-3, 0.1, 150)]), np.arange(1850) < 1700
    for wrong in (0, 4, 20):  # labelled good, though they score like the bad
        flag = good | (np.arange(1850) >= 1850 - wrong)
        limit = quality.threshold_of(scores, flag, np.ones(1850, int))
        assert scores[~good].max() < limit < scores[good].min()
    # no bad one scores below a good one: still a bound
    assert quality.threshold_of(np.array([0.0, 1.0]), np.array([True, False]), np.ones(2, int)) == 0.0


# near duplicates


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or ([" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(prints, bits):
    root = list(range(len(prints)))
    def top(i):
        while root[i] != i:
            i = root[i]
        return i
    for i, j in itertools.combinations(range(len(prints)), 2):
        if bin(prints[i] ^ prints[j]).count("1") <= bits:
            a, b = sorted((top(i), top(j)))
            root[b] = a
    return [top(i) for i in range(len(prints))]


def test_near_duplicates_against_brute_force(spark):
    rng = random.Random(11)
    base = [" ".join("".join(rng.choices("abcdefgh", k=3)) for _ in range(rng.randint(1, 400))) for _ in range(30)]
    texts = ["", None, " \n", "One", "one", *base]
    for t in base:
        words = t.split()
        for _ in range(3):
            words[rng.randrange(len(words))] = "zz"
            texts.append(" ".join(words).upper() if rng.random() < 0.5 else " ".join(words))
    texts += [base[0]] * 20
    want = [plain_fingerprint(t or "") for t in texts]
    root = plain_components(want, 4)
    docs = documents(spark, texts).withColumnRenamed("lang", "fingerprint").repartition(5)
    rows = simhash.near_duplicates(docs).collect()
    assert {r.key: r.fingerprint & (2**64 - 1) for r in rows} == dict(enumerate(want))
    assert {r.key: r.component for r in rows} == dict(enumerate(root)) and len(set(root)) < len(set(want))
    left = simhash.one_of_each(docs)
    assert left.schema == docs.schema and sorted(r.doc_id for r in left.collect()) == sorted(set(root))


@pytest.mark.parametrize("bits", [2, 4])
def test_links_of_random_fingerprints(spark, bits, monkeypatch):
    monkeypatch.setattr(simhash, "VARIANTS_HELD", 3000)
    rng = random.Random(bits)
    prints = [rng.getrandbits(64) for _ in range(150)]
    for x in prints[:80]:
        for distance in range(1, bits + 3):
            for b in rng.sample(range(64), distance):
                x ^= 1 << b
            prints.append(x)
    signed = [x - 2**64 if x >> 63 else x for x in prints]
    frame = spark.createDataFrame([(x,) for x in set(signed)], "fingerprint long").repartition(3)
    node = {r.node: r.root for r in simhash.components(simhash.links(frame, bits)).collect()}
    got, want = defaultdict(set), defaultdict(set)
    for s, r in zip(signed, plain_components(prints, bits)):
        got[node.get(s, s)].add(s)
        want[r].add(s)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_long_chains_and_hubs(spark):
    chain = [(i + 1, i) for i in range(40)]
    hub = [(1000 + i, 1000) for i in range(1, 200)] + [(5, 5)]
    got = {r.node: r.root for r in simhash.components(spark.createDataFrame(chain + hub, "a long, b long").repartition(4)).collect()}
    assert all(got[i] == 0 for i in range(41)) and all(got[1000 + i] == 1000 for i in range(200))
    assert simhash.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_duplicates_edge_cases(spark):
    assert simhash.near_duplicates(documents(spark, [])).count() == 0
    rows = simhash.near_duplicates(documents(spark, ["a b c d e"] * 3, [None, 7, 7])).collect()
    assert {r.component for r in rows} == {7} and len(rows) == 3
    assert simhash.one_of_each(documents(spark, ["a b c d e"] * 3, [None, 7, 7])).count() == 1
    assert simhash.one_of_each(documents(spark, [])).count() == 0


def test_line_query_columns(spark, tmp_path):
    from chronovox.llm import queries

    documents(spark, ["a\nb", None]).write.parquet(f"{tmp_path}/documents.parquet")
    rows = {r.doc_id: r for r in queries.op4_line_dedup(spark, str(tmp_path)).collect()}
    assert rows[0].kept_sha256 == hashlib.sha256(b"a\nb").hexdigest() and rows[1].kept_sha256 == hashlib.sha256(b"").hexdigest()
    assert (rows[1].n_lines, rows[1].n_dropped) == (1, 0)


def test_buckets_keep_their_bound():
    for n in (10, 10**6, 10**7, 10**8, 10**9):
        buckets = simhash.buckets_for(n, 2)
        assert n * min(1, simhash.ball_size(2) / buckets) <= simhash.FINGERPRINTS_PER_BUCKET
    rng = np.random.default_rng(3)
    prints = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    for buckets in (64, 1 << 13):  # all fingerprints everywhere, and only where they have a variant
        dealt = Counter()
        for k, x in simhash.dealt(prints, 2, buckets):
            assert 0 <= k < buckets
            dealt.update(x.tolist())
        reach = len(np.unique(simhash.classes_of(simhash.flips_of(2), buckets)))
        assert set(dealt.values()) == {reach} and reach <= min(buckets, simhash.ball_size(2))


@pytest.mark.parametrize("buckets", [64, 1 << 13])
def test_a_forest_of_many_buckets_finds_every_link(buckets, monkeypatch):
    monkeypatch.setattr(simhash, "VARIANTS_HELD", 500)
    monkeypatch.setattr(simhash, "EDGES_HELD", 10)
    rng = random.Random(2)
    prints = [rng.getrandbits(64) for _ in range(20)]
    for x in list(prints):
        for distance in (1, 3, 4, 5):
            y = x
            for b in rng.sample(range(64), distance):
                y ^= 1 << b
            prints.append(y)
    prints += prints[:5]
    root = {x: x for x in prints}
    edges, held = [], defaultdict(list)
    for k, x in simhash.dealt(np.array(prints, np.uint64), 2, buckets):
        held[k].append(x)
    for k, parts in held.items():
        edges += zip(*simhash.forest(np.concatenate(parts), 2, k, buckets).tolist())
    for a, b in edges:
        low, high = sorted((root[a], root[b]))
        root = {x: low if r == high else r for x, r in root.items()}
    want = plain_components(prints, 4)
    groups = lambda of: sorted(sorted(x for x, r in of if r == g) for g in {r for _, r in of})
    assert groups([(x, root[x]) for x in set(prints)]) == groups([(x, prints[want[prints.index(x)]]) for x in set(prints)])
