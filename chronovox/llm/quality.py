"""Quality rules and a hashed n-gram likelihood ratio.

Rules count words, symbols, repeated lines and repeated passages.  What
passes them is judged by a likelihood ratio: n-grams are hashed to a fixed
number of buckets; one multinomial comes from all documents, the other from a
trusted target; a document's score is the mean over its n-grams of the log
ratio of the two, so that length does not matter.  A document is kept if its
score reaches a threshold that follows from the labelled documents' scores by
a fixed rule.

n-grams are of bytes (A-Z as a-z), from the start of the text to its end.
All counting is done on whole batches of bytes; words, windows of words and
n-grams never become Python objects.

The trusted target is the set of documents labelled good.  At most
``most_labels`` labelled ids are used, those with the least hash of the id;
that bounds what is sent to the tasks.  One half of them makes the target,
the other sets the threshold, so that the threshold suits unseen documents.  The corpus counts cover every
document, and every document is scored.

Defined cases: a null text has no words and fails; repeated rows count each;
labels with a null or repeated id: null ids are ignored, an id counts as good
if every label of it says so; without any good label all scores are 0; without
labels of both kinds every document that passes the rules is kept.  A text may
be of any length: it is gone through in blocks of 256 KB with carried borders,
and what is held of all of it are two hashes a word,
and up to 150 bytes a word while repeated windows are sought.  Further columns are
passed over, whatever their names, or kept where documents are returned.
"""

from __future__ import annotations

import dataclasses
import functools
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

#: White space between words, and symbols.
BLANK, SYMBOLS = b" \t\n\x0b\x0c\r", b"#*$%&|<>"
WINDOW = 8
LEAST_WORDS, MOST_REPEATED = 20, (30, 100)
ORDERS, BUCKETS = (4,), 1 << 16
#: Labelled ids that may be sent to the tasks (8 bytes each).
MOST_LABELS = 200_000
#: How far the threshold goes from the score that separates the labelled documents best towards the median of the bad
#: ones below it, to spare clean documents that are unlike the labelled ones.
MARGIN = 0.3
#: Bytes that are counted at once.
BLOCK = 256 << 10
METRICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _table(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


A_BLANK = re.compile(b"[" + BLANK + b"]")
IS_BLANK, IS_SYMBOL = _table(BLANK), _table(SYMBOLS)
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)


@functools.lru_cache(maxsize=4)
def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse, modulo 2**64."""
    back = pow(base, -1, 1 << 64)
    one = lambda b: np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(n, b, np.uint64))])
    return one(base), one(back)


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, base: int) -> np.ndarray:
    """Polynomial hashes of the spans, by prefix sums."""
    up, down = powers(base, common.power_of_two(max(len(data), BLOCK)))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)])])
    return common.doubling_hash((sums[end] - sums[start]) * down[start], 0)


def blocks(all_texts: list[bytes]):
    """(first, end) of runs of texts of about BLOCK bytes."""
    at = size = 0
    for i, t in enumerate(all_texts):
        size += len(t) + 1
        if size >= BLOCK:
            yield at, i + 1
            at, size = i + 1, 0
    if at < len(all_texts):
        yield at, len(all_texts)


def laid_out(some: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All bytes with a blank after each text; the texts' starts and ends."""
    data = np.frombuffer(b" ".join(some) + b" ", np.uint8)
    length = np.array([len(t) for t in some], np.int64)
    start = np.concatenate([[0], np.cumsum(length + 1)[:-1]]).astype(np.int64)
    return data, start, start + length


def per_text(flag: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(flag, dtype=np.int64)])
    return sums[end] - sums[start]


def repeated_words(word_text: np.ndarray, one: np.ndarray, two: np.ndarray, texts: int) -> np.ndarray:
    """Per text, the words in windows that the text has at least twice; ``one`` and ``two`` are hashes of the words."""
    n = len(word_text) - WINDOW + 1
    if n < 2:
        return np.zeros(texts, np.int64)
    first = np.flatnonzero(word_text[:n] == word_text[WINDOW - 1 :])
    roll = lambda h, m: functools.reduce(lambda a, k: a * np.uint64(m) + h[first + k], range(WINDOW), np.zeros(len(first), np.uint64))
    key = common.doubling_hash(roll(one, 0x9E3779B97F4A7C15) + word_text[first].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93), 1)
    order = np.argsort(key, kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    maybe = order[np.concatenate([same, [False]]) | np.concatenate([[False], same])]
    if len(maybe):
        # confirmed by text and a hash from other bases
        other = roll(two, 0xC2B2AE3D27D4EB4F)[maybe]
        rank = np.lexsort((other, key[maybe], word_text[first[maybe]]))
        a, b = maybe[rank[1:]], maybe[rank[:-1]]
        same = (key[a] == key[b]) & (other[rank[1:]] == other[rank[:-1]]) & (word_text[first[a]] == word_text[first[b]])
        maybe = maybe[rank][np.concatenate([same, [False]]) | np.concatenate([[False], same])]
    cover = np.zeros(len(word_text) + 1, np.int64)
    np.add.at(cover, first[maybe], 1)
    np.add.at(cover, first[maybe] + WINDOW, -1)
    return np.bincount(word_text[np.cumsum(cover[:-1]) > 0], minlength=texts)


def repeated_lines(text: bytes) -> int:
    lines = [x for x in text.split(b"\n") if x.strip(BLANK)]
    return len(lines) - len(set(lines))


def pieces_of(all_texts: list[bytes]):
    """(text's number, piece) of all texts in order: a long text is cut before blanks every BLOCK bytes or so, and a longer run without a blank is a piece of its own."""
    for i, text in enumerate(all_texts):
        at = 0
        while len(text) - at > BLOCK:
            found = A_BLANK.search(text, at + BLOCK)
            cut = found.start() if found else len(text)
            if cut - at > 2 * BLOCK:
                begins = max(text.rfind(bytes([c]), at, at + BLOCK) for c in BLANK) + 1
                if begins > at:
                    yield i, text[at:begins]
                    at = begins
            yield i, text[at:cut]
            at = cut
        yield i, text[at:]


def run_hash(word: bytes, base: int) -> np.ndarray:
    """span_hashes() of one word, a block at a time."""
    up, _ = powers(base, BLOCK)
    total, factor = np.zeros(1, np.uint64), np.ones(1, np.uint64)
    for at in range(0, len(word), BLOCK):
        part = np.frombuffer(word[at : at + BLOCK], np.uint8)
        total = total + factor * ((part.astype(np.uint64) + np.uint64(1)) * up[: len(part)]).sum(dtype=np.uint64)
        factor = factor * up[BLOCK]
    return common.doubling_hash(total, 0)


BASES = (0x5851F42D4C957F2D, 0x14057B7EF767814F)


def words_of(some: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Each word's text and two hashes, and the texts' characters in words and symbols."""
    if len(some) == 1 and len(some[0]) > 2 * BLOCK:  # a run without a blank, as pieces_of() cuts
        run, sums = some[0], np.zeros(2, np.int64)
        for at in range(0, len(run), BLOCK):
            part = np.frombuffer(run[at : at + BLOCK], np.uint8)
            sums += (((part & 0xC0) != 0x80).sum(), IS_SYMBOL[part].sum())
        return np.zeros(1, np.int64), run_hash(run, BASES[0]), run_hash(run, BASES[1]), sums[:1], sums[1:]
    data, start, end = laid_out(some)
    blank = IS_BLANK[data]
    before = np.concatenate([[True], blank[:-1]])
    word_start = np.flatnonzero(~blank & before)
    word_end = np.flatnonzero(blank & ~before)
    one, two = (span_hashes(data, word_start, word_end, base) for base in BASES)
    return np.searchsorted(start, word_start, side="right") - 1, one, two, per_text(~blank & ((data & 0xC0) != 0x80), start, end), per_text(IS_SYMBOL[data], start, end)


def measured(some: list[bytes]) -> dict[str, np.ndarray]:
    """The rules' numbers of each text; of a long text, only its words' hashes are held at once."""
    chars, symbols, found = np.zeros(len(some), np.int64), np.zeros(len(some), np.int64), []

    def add(owners, pieces):
        text, one, two, own_chars, own_symbols = words_of(pieces)
        owner = np.array(owners)
        found.append((owner[text], one, two))
        np.add.at(chars, owner, own_chars)
        np.add.at(symbols, owner, own_symbols)

    owners, pieces, size = [], [], 0
    for i, piece in pieces_of(some):
        if len(piece) > 2 * BLOCK:
            if pieces:
                add(owners, pieces)
                owners, pieces, size = [], [], 0
            add([i], [piece])
            continue
        owners.append(i)
        pieces.append(piece)
        size += len(piece)
        if size >= BLOCK:
            add(owners, pieces)
            owners, pieces, size = [], [], 0
    if pieces:
        add(owners, pieces)
    word_text, one, two = (np.concatenate([f[k] for f in found]) if found else np.zeros(0, kind) for k, kind in enumerate((np.int64, np.uint64, np.uint64)))
    return {
        "n_words": np.bincount(word_text, minlength=len(some)),
        "word_chars": chars,
        "n_symbols": symbols,
        "n_dup_lines": np.array([repeated_lines(t) for t in some], np.int64),
        "n_repeat_words": repeated_words(word_text, one, two, len(some)),
    }


def ngrams(some: list[bytes]):
    """Buckets of n-grams, and each n-gram's text; all of an order together, or of a long text a block after the other."""
    if sum(map(len, some)) > 2 * BLOCK:
        for i, text in enumerate(some):
            for at in range(0, max(1, len(text)), BLOCK):
                for n in ORDERS:  # what a block's last n-grams need of the next goes along
                    for bucket, own in grams(n, [text[at : at + BLOCK + n - 1]]):
                        yield bucket, own + i
        return
    for n in ORDERS:
        yield from grams(n, some)


def grams(n: int, some: list[bytes]):
    """Buckets of all n-grams of one length, and each n-gram's text."""
    data, start, end = laid_out(some)
    low = LOWER[data].astype(np.uint64)
    text = np.repeat(np.arange(len(some)), end - start + 1)
    size = len(data) - n + 1
    if size > 0:
        inside = np.arange(size) + n <= end[text[:size]]
        packed = functools.reduce(lambda a, k: a << np.uint64(8) | low[k : k + size], range(n), np.zeros(size, np.uint64))
        yield (common.doubling_hash(packed[inside], n) >> np.uint64(48)).astype(np.int64) % BUCKETS, text[:size][inside]


def corpus_counts(docs: DataFrame, good) -> np.ndarray:
    """Counts of buckets over the target and over all documents, from one pass over the texts.

    Each task adds up its own and sends them once, in slices; slices are
    summed as they stream by.
    """
    slices, width = 64, BUCKETS // 64

    def count(batches):
        sums = np.zeros((2, BUCKETS), np.int64)
        for batch in batches:
            ids, all_texts = common.column(batch, "doc_id"), common.text_bytes(batch)
            # a null becomes a number before numpy could make all ids floats
            trusted = np.isin(ids.fill_null(0).to_numpy(zero_copy_only=False), good.value) & ids.is_valid().to_numpy(zero_copy_only=False)
            for a, b in blocks(all_texts):
                for bucket, text in ngrams(all_texts[a:b]):
                    sums[1] += np.bincount(bucket, minlength=BUCKETS)
                    sums[0] += np.bincount(bucket[trusted[a:b][text]], minlength=BUCKETS)
        if sums.any():
            yield pa.RecordBatch.from_arrays([pa.array(range(slices), pa.int32()), pa.array([sums[:, k * width : (k + 1) * width].tobytes() for k in range(slices)], pa.binary())], names=["slice", "counts"])

    def added(batches):
        sums = {}
        for batch in batches:
            for k, raw in zip(*(c.to_pylist() for c in batch.columns)):
                sums[k] = sums.get(k, 0) + np.frombuffer(raw, np.int64)
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([x.tobytes() for x in sums.values()], pa.binary())], names=["slice", "counts"])

    out = np.zeros((2, BUCKETS), np.int64)
    sent = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(count, "slice int, counts binary")
    for r in sent.repartition(slices, "slice").mapInArrow(added, "slice int, counts binary").collect():  # a megabyte, whatever the input
        out[:, r["slice"] * width : (r["slice"] + 1) * width] += np.frombuffer(r["counts"], np.int64).reshape(2, width)
    return out


def log_ratio(counts: np.ndarray) -> np.ndarray:
    """Per bucket, the log ratio of the two multinomials, each smoothed by one n-gram a bucket."""
    if not counts[0].any():
        return np.zeros(BUCKETS)
    share = (counts + 1) / (counts.sum(axis=1, keepdims=True) + BUCKETS)
    return np.log(share[0]) - np.log(share[1])


def labelled(labels: DataFrame, most: int) -> DataFrame:
    """doc_id, good and fitted (booleans) of at most ``most`` labelled documents, chosen by hash.

    Half of them, the fitted ones, make the target; the others, which the
    target has not seen, set the threshold.
    """
    one = labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg((F.min("quality") > 0).alias("good"))
    h = F.xxhash64("doc_id")
    return one.orderBy(h, "doc_id").limit(most).withColumn("fitted", F.pmod(F.shiftright(h, 7), F.lit(2)) == 0)


def quantile_of(values: np.ndarray, times: np.ndarray, share: float) -> float:
    """The value at that share of all, each counted ``times`` times."""
    order = np.argsort(values, kind="stable")
    upto = np.cumsum(times[order])
    return float(values[order][np.searchsorted(upto, int(share * upto[-1]), side="right")])


def threshold_of(scores: np.ndarray, good: np.ndarray, times: np.ndarray, margin: float = MARGIN) -> float:
    """The good score that separates both classes best, less a share of its distance to the median of the bad ones below it.

    Best is the greatest share of bad ones below less the share of good ones
    below, the least such score if there are several; so a few wrong labels
    hardly move it.  Without labels of both kinds nothing is rejected.
    """
    if not good.any() or good.all():
        return -np.inf
    order = np.argsort(scores, kind="stable")
    s, n = scores[order], np.where(good, [[0], [1]], [[1], [0]])[:, order] * times[order]
    below = np.concatenate([np.zeros((2, 1)), np.cumsum(n, axis=1)], axis=1)[:, np.searchsorted(s, s, side="left")]
    gain = below[0] / n[0].sum() - below[1] / n[1].sum()
    bound = float(s[np.argmax(np.where(good[order], gain, -np.inf))])
    bad = ~good & (scores < bound)
    return bound - margin * (bound - quantile_of(scores[bad], times[bad], 0.5)) if bad.any() else bound


@dataclasses.dataclass
class Model:
    """Log ratio of each bucket, and the least score that is kept."""

    ratio: np.ndarray
    limit: float

    def scores(self, some: list[bytes]) -> np.ndarray:
        """Mean log ratio of each text's n-grams; 0 without any."""
        total, n = np.zeros(len(some)), np.zeros(len(some))
        for bucket, text in ngrams(some):
            total += np.bincount(text, self.ratio[bucket], minlength=len(some))
            n += np.bincount(text, minlength=len(some))
        return total / np.maximum(n, 1)

    def judged(self, some: list[bytes]) -> dict[str, np.ndarray]:
        """The rules' numbers, score, base_failed and kept of each text."""
        out = {m: np.zeros(0, np.int64) for m in METRICS} | {"score": np.zeros(0)}
        for a, b in blocks(some):
            for k, v in (measured(some[a:b]) | {"score": self.scores(some[a:b])}).items():
                out[k] = np.concatenate([out[k], v])
        out["base_failed"] = (out["n_words"] < LEAST_WORDS) | (MOST_REPEATED[1] * out["n_repeat_words"] > MOST_REPEATED[0] * out["n_words"])
        out["kept"] = ~out["base_failed"] & (out["score"] >= self.limit)
        return out


def fit(docs: DataFrame, labels: DataFrame, most_labels: int = MOST_LABELS) -> Model:
    """Count n-grams over all of ``docs``, and set the threshold by the labelled ones."""
    spark = common.text_session(docs.sparkSession)
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    known = common.written(labelled(labels, most_labels), "labels")
    good = np.array([r["doc_id"] for r in known.collect() if r["good"] and r["fitted"]], np.int64)  # at most most_labels
    ratio = spark.sparkContext.broadcast(log_ratio(corpus_counts(source, spark.sparkContext.broadcast(good))))

    def score(batches):
        model = Model(ratio.value, -np.inf)
        for batch in batches:
            own = model.judged(common.text_bytes(batch))
            pick = np.flatnonzero(~own["base_failed"])
            yield pa.RecordBatch.from_arrays([pa.array(own["score"][pick]), common.column(batch, "good").take(pa.array(pick))], names=["score", "good"])

    # the labelled ids are bounded, so they may be broadcast
    seen = source.join(F.broadcast(known.where("not fitted")), "doc_id").select("text", "good").mapInArrow(score, "score double, good boolean")
    seen = seen.groupBy("score", "good").count().orderBy(F.xxhash64("score", "good")).limit(most_labels).collect()  # rows with a label's id may repeat
    times = np.array([r["count"] for r in seen], np.int64)
    scores, is_good = np.array([r["score"] for r in seen], float), np.array([r["good"] for r in seen], bool)
    return Model(ratio.value, threshold_of(scores, is_good, times))


def assess(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, the rules' numbers, score, base_failed and kept, one row per document."""
    sent = common.text_session(docs.sparkSession).sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            own = sent.value.judged(common.text_bytes(batch))
            yield pa.RecordBatch.from_arrays([common.column(batch, "doc_id"), *(pa.array(own[m].astype(np.int64)) for m in METRICS), *(pa.array(own[m]) for m in ("score", "base_failed", "kept"))], names=["doc_id", *METRICS, "score", "base_failed", "kept"])

    kinds = "doc_id long, " + ", ".join(f"{m} long" for m in METRICS) + ", score double, base_failed boolean, kept boolean"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, kinds)


def keep_good(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns."""
    sent = common.text_session(docs.sparkSession).sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(sent.value.judged(common.text_bytes(batch))["kept"]))

    return docs.mapInArrow(run, docs.schema)
