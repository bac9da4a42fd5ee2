"""SimHash fingerprints and near-duplicate components.

Fingerprints at most 2r bits apart are linked.  Every distinct fingerprint
has a ball: all variants that differ from it in at most r bits.  Two linked
fingerprints share a variant, and two that share one are linked; so the
fingerprints that meet on a variant are a group without further partners.

Shuffling every variant as a row would move some two thousand rows for each
fingerprint of 64 bits and r = 2.  Variants are dealt to buckets by parities
of their bits instead.  Parity is linear: a fingerprint's parities and the
bucket's give those of the flips that lead there.  So a bucket needs only the
fingerprints that have a variant in it, eight bytes each, and makes its own
share of all variants.  A bucket is dealt on to classes by further parities;
fingerprints are sorted by class once, and a class takes its variants from
slices of that order, so that only about a million variants are held at once.

Within a bucket the meeting fingerprints are joined to a forest, never to all
pairs.  Components of the forests' edges come from alternating large-star and
small-star steps over tables in the shared folder.

Defined cases: a null text is the empty text; a text without words has
fingerprint zero and is linked like any other; equal fingerprints are one
node, so copies are never paired; rows with a null id get component_id null
only if their whole component has null ids.
"""

from __future__ import annotations

import functools
import itertools
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

#: Buckets that share out the variants at least; more once a bucket would get over FINGERPRINTS_PER_BUCKET.
BUCKETS, FINGERPRINTS_PER_BUCKET = 64, 8_000_000
#: Variants that a task holds at once, places of fingerprints that it deals at once, and edges it holds before it joins them.
VARIANTS_HELD, DEALT_AT_ONCE, EDGES_HELD = 1_000_000, 4_000_000, 1_000_000
SEED = 42


def shingle_hashes(text: bytes, width: int) -> np.ndarray:
    """XXH64 of every shingle of ``width`` words, repeats included."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    whole = b" ".join(words)
    ends = list(itertools.accumulate(map(len, words), lambda a, b: a + 1 + b))
    if len(words) <= width:
        return np.array([xxhash.xxh64_intdigest(whole, SEED)], np.uint64)
    starts = [0, *[e + 1 for e in ends[: len(words) - width]]]
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(whole[a:b], SEED) for a, b in zip(starts, ends[width - 1 :])), np.uint64, len(starts))


def fingerprint(hashes: np.ndarray) -> int:
    """Bit i is set if it is set in over half the hashes."""
    n = len(hashes)
    counts = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):  # a long text's bits in blocks
        bits = np.unpackbits(hashes[at : at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, width: int = 4, key_col: str = "doc_id") -> DataFrame:
    """key and fingerprint (long, the bits as they are)."""
    common.text_session(docs.sparkSession)
    source = docs.select(F.col(key_col).alias("key"), "text")

    def run(batches):
        for batch in batches:
            own = np.array([fingerprint(shingle_hashes(t, width)) for t in common.text_bytes(batch)], np.uint64)
            yield pa.RecordBatch.from_arrays([common.column(batch, "key"), pa.array(own.view(np.int64))], names=["key", "fingerprint"])

    return source.mapInArrow(run, T.StructType([source.schema["key"], T.StructField("fingerprint", T.LongType())]))


def ball_size(radius: int) -> int:
    return sum(math.comb(64, k) for k in range(radius + 1))


def buckets_for(n: int, radius: int) -> int:
    """As few buckets as keep a bucket's share of ``n`` fingerprints within FINGERPRINTS_PER_BUCKET.

    A fingerprint has a variant in at most ball_size(radius) buckets.
    """
    buckets = BUCKETS
    while n * min(1, ball_size(radius) / buckets) > FINGERPRINTS_PER_BUCKET:
        buckets *= 2
    return buckets


@functools.lru_cache(maxsize=2)
def flips_of(radius: int) -> np.ndarray:
    """Every change of at most ``radius`` of 64 bits, as a mask."""
    return np.array([sum(1 << i for i in c) for k in range(radius + 1) for c in itertools.combinations(range(64), k)], np.uint64)


#: Masks whose parities make up a class, one for each of its bits.
PARITIES = np.random.default_rng(20_240).integers(1, 1 << 63, 48, dtype=np.uint64) | (np.uint64(1) << np.arange(48, dtype=np.uint64))


def classes_of(x: np.ndarray, count: int) -> np.ndarray:
    """Each value's class of ``count``, a power of two; that of a ^ b is the classes' ^."""
    out = np.zeros(len(x), np.int64)
    for i, mask in enumerate(PARITIES[: count.bit_length() - 1]):
        out |= (np.bitwise_count(x & mask).astype(np.int64) & 1) << i
    return out


def joined_up(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least node of each node's component, for edges a-b among n nodes."""
    root = np.arange(n)
    while len(a):
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        if not (apart := low != high).any():
            break
        np.minimum.at(root, high[apart], low[apart])
        while (root != root[root]).any():
            root = root[root]
        a, b = a[apart], b[apart]
    return root


def starred(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges from each node of a-b to the least of its component."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    root = joined_up(len(nodes), at[: len(a)], at[len(a) :])
    child = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[child], nodes[root[child]]


def met(variants: np.ndarray) -> np.ndarray:
    """Places of the values that occur more than once, and perhaps of a few others."""
    order = np.sort(variants)
    again = order[1:][order[1:] == order[:-1]]
    if not len(again):
        return np.zeros(0, np.int64)
    mix = lambda v: (v * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(42)).astype(np.int64)
    marked = np.zeros(1 << 22, bool)
    marked[mix(again)] = True
    return np.flatnonzero(marked[mix(variants)])


def forest(prints: np.ndarray, radius: int, bucket: int, buckets: int) -> np.ndarray:
    """Rows (fingerprint, least fingerprint that it reaches in this bucket), for all that meet another there."""
    flips = flips_of(radius)
    share = len(prints) * max(1.0, len(flips) / buckets)
    inner = common.power_of_two(max(1, math.ceil(share / VARIANTS_HELD)))
    own, of_flip = classes_of(prints, buckets * inner), classes_of(flips, buckets * inner)
    order = np.lexsort((prints, own))
    prints, own = prints[order], own[order]
    new = np.ones(len(prints), bool)
    new[1:] = prints[1:] != prints[:-1]
    prints, own = prints[new], own[new]
    ends = np.searchsorted(own, np.arange(buckets * inner + 1)) if buckets * inner <= 2 * len(prints) else None
    a, b = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for wanted in range(bucket, buckets * inner, buckets):
        source = of_flip ^ wanted
        first, last = (ends[source], ends[source + 1]) if ends is not None else (np.searchsorted(own, source), np.searchsorted(own, source, side="right"))
        full = np.flatnonzero(last > first)
        if not len(full):
            continue
        size = last[full] - first[full]
        variants = np.concatenate([prints[i:j] ^ f for i, j, f in zip(first[full], last[full], flips[full])])
        at = met(variants)
        if not len(at):
            continue
        # which slice a place lies in, and so which fingerprint it is
        before = np.concatenate([[0], np.cumsum(size)])
        part = np.searchsorted(before, at, side="right") - 1
        number, value = first[full][part] + at - before[part], variants[at]
        order = np.argsort(value, kind="stable")
        same = np.flatnonzero(value[order[1:]] == value[order[:-1]])
        x, y = number[order[same]], number[order[same + 1]]
        # verified, though two that share a variant are always near
        near = np.bitwise_count(prints[x] ^ prints[y]) <= 2 * radius
        a, b = np.concatenate([a, x[near]]), np.concatenate([b, y[near]])
        if len(a) > EDGES_HELD + len(prints):
            a, b = starred(a, b)
    x, y = prints[a], prints[b]
    return np.stack(starred(x, y)) if len(x) else np.zeros((2, 0), np.uint64)


def dealt(prints: np.ndarray, radius: int, buckets: int):
    """(bucket, fingerprints that have a variant in it) for all buckets."""
    reach = np.unique(classes_of(flips_of(radius), buckets))
    own = classes_of(prints, buckets)
    if len(reach) == buckets:
        yield from ((k, prints) for k in range(buckets))
        return
    step = max(1, DEALT_AT_ONCE // len(reach))
    for i in range(0, len(prints), step):
        to = (own[i : i + step, None] ^ reach).ravel()
        order = np.argsort(to, kind="stable")
        found, starts = np.unique(to[order], return_index=True)
        yield from zip(found.tolist(), np.split(prints[i : i + step][order // len(reach)], starts[1:]))


def links(prints: DataFrame, bits: int = 4) -> DataFrame:
    """Edges (a, b) among the distinct fingerprints of ``prints`` (one long column), whose components are those of all links.

    bits is the most differing bits of a link and must be even.
    """
    if bits % 2 or not 0 <= bits <= 6:
        raise ValueError("bits is 0, 2, 4 or 6")
    radius = bits // 2
    buckets = buckets_for(prints.count(), radius)
    at_once = max(1, DEALT_AT_ONCE // min(buckets, ball_size(radius)))

    def deal(batches):
        held, size = [], 0

        def sent():
            rows = list(dealt(np.concatenate(held), radius, buckets))
            return pa.RecordBatch.from_arrays([pa.array([k for k, _ in rows], pa.int32()), pa.array([x.tobytes() for _, x in rows], pa.binary())], names=["bucket", "prints"])

        for batch in batches:
            held.append(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64))
            size += len(held[-1])
            if size >= at_once:
                yield sent()
                held, size = [], 0
        if size:
            yield sent()

    def meet(batches):
        """Rows come sorted by bucket."""
        at, held = None, []

        def done():
            a, b = forest(np.concatenate(held), radius, at, buckets).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

        for batch in batches:
            for bucket, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                if bucket != at:
                    if held:
                        yield done()
                    at, held = bucket, []
                held.append(np.frombuffer(raw.as_buffer(), np.uint64))
        if held:
            yield done()

    sent = prints.mapInArrow(deal, "bucket int, prints binary")
    edges = sent.repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(meet, "a long, b long")
    return edges.distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, root: every node of the edges (a, b) and the least node of its component.

    Large-star and small-star steps in turn: each node's neighbours are tied
    to the least of them.  A node's minimum is an aggregate, so a hub never
    meets in one task; the join that follows splits a hub's rows.  A table is
    deleted once the next one is written.
    """
    edges = common.written(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    while True:
        both = edges.union(edges.select("b", "a"))
        least = common.written(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "least")
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()
        large = common.written(large, "large-star")
        of_large = common.written(large.groupBy("a").agg(F.min("b").alias("m")), "least")
        small = large.join(of_large, "a").select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("e")).select("e.*")
        new = common.written(small.where("a != b").distinct(), "small-star")
        common.dropped(edges, least, large, of_large)
        edges = new
        now = edges.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0))).first()
        if now == before or not now[0]:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(edges.select("b", "b").distinct())
        before = now


def near_duplicates(docs: DataFrame, width: int = 4, bits: int = 4, key_col: str = "doc_id") -> DataFrame:
    """key, fingerprint (long) and component (the least key reachable) of every row; the key may be any column that can be ordered."""
    rows = common.written(fingerprints(docs, width, key_col), "fingerprints")
    known = common.written(rows.groupBy("fingerprint").agg(F.min("key").alias("least")), "distinct-fingerprints")
    return named(rows, known, components(links(known.select("fingerprint"), bits)))


def named(rows: DataFrame, known: DataFrame, linked: DataFrame) -> DataFrame:
    """``rows`` (key, fingerprint) with component, the least key that ``linked`` (node, root) reaches; ``known`` has each fingerprint's least key."""
    # Unlinked fingerprints are their own components.
    rooted = known.join(linked, known["fingerprint"] == linked["node"], "left").select("fingerprint", "least", F.coalesce("root", "fingerprint").alias("root"))
    rooted = common.written(rooted, "rooted")
    of_root = common.written(rooted.groupBy("root").agg(F.min("least").alias("component")), "roots")
    of_print = common.written(rooted.join(of_root, "root").select("fingerprint", "component"), "named")
    common.dropped(rooted, of_root)
    return rows.join(of_print, "fingerprint").select("key", "fingerprint", "component")


def one_of_each(docs: DataFrame, width: int = 4, bits: int = 4) -> DataFrame:
    """``docs`` with one row of each component, that of the least doc_id (null first; of repeated ids any one)."""
    # A column holds the whole row, so no name can clash.
    numbered = common.written(docs.select(F.struct(*docs.columns).alias("whole"), F.monotonically_increasing_id().alias("row")), "numbered-documents")
    found = near_duplicates(numbered.select(F.struct(F.col("whole.doc_id").alias("doc_id"), "row").alias("place"), F.col("whole.text").alias("text")), width, bits, "place")
    lost = found.where("key <> component").select(F.col("key.row").alias("row"))
    return numbered.join(lost, "row", "left_anti").select(*[F.col(f"whole.`{c}`").alias(c) for c in docs.columns])
