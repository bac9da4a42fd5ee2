"""Removal of lines that many documents share.

1. Every task hashes the distinct line keys of its documents.  Hashes go to
   shards of bounded size, where two Bloom filters take them up: a hash that
   is already in the once-seen filter goes into the twice-seen filter.  The
   shard then puts its hashes to the twice-seen filter; those found are the
   suspected repeats, and it counts their documents.  Filters never leave
   their shard.
2. Lines whose hash occurs in enough documents are counted by their whole
   keys, and the first occurrence is chosen.  Hashes meet lines in a join,
   which Spark does without a shuffle of lines as long as they are few.
3. Keys in enough documents lose their lines.  If the keys are small enough
   they are sent to every task; otherwise lines are joined with them.

A filter can err only towards suspicion, and keys of one hash only add up, so
no repeat is lost; the count by whole keys makes the result exact.

Defined cases: a null or empty text is one empty line, whose key is too short
to count; rows are documents, also where ids repeat or are null; a line that
occurs several times in a document counts once; the first occurrence is one
line of one row, that with the least (id, line), null ids first, of any type of
id; among rows of one id it is any one; a text is taken whole, however long.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

#: Fixed value: what counts as white space at a line's ends.
BLANK = b" \t\n\x0b\x0c\r"
BITS_PER_KEY, PROBES = 12, 4
#: Hashes of a shard, about, and of a task before it deals them to shards.
HASHES_PER_SHARD, HELD_HASHES = 4_000_000, 1_000_000
#: Most bytes, as Python objects, of frequent keys that are sent to every task, and what one key takes besides its own bytes.
SENT_BYTES, BYTES_PER_KEY = 64 << 20, 300


def key_of(line: bytes) -> bytes:
    return line.strip(BLANK).lower()  # bytes.lower() changes A-Z only


def long_enough(key: bytes, least: int) -> bool:
    return len(key) >= least and (least <= 1 or len(key.decode("utf-8", "replace")) >= least)


def keys_of(text: bytes, least: int) -> list[bytes | None]:
    """Each line's key; None where it is too short to count."""
    return [k if long_enough(k := key_of(line), least) else None for line in text.split(b"\n")]


def hashes(keys) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(k) for k in keys), np.uint64)


class Filter:
    """A Bloom filter over 64-bit hashes."""

    def __init__(self, bits: int):
        self.bits, self.data = np.uint64(bits), np.zeros(bits // 8, np.uint8)

    def _places(self, h: np.ndarray):
        step = common.doubling_hash(h, 0x51ED270B) | np.uint64(1)
        for i in range(PROBES):
            at = (h + np.uint64(i) * step) % self.bits
            yield (at >> np.uint64(3)).astype(np.int64), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8)

    def add(self, h: np.ndarray) -> None:
        for at, bit in self._places(h):
            np.bitwise_or.at(self.data, at, bit)

    def has(self, h: np.ndarray) -> np.ndarray:
        found = np.ones(len(h), bool)
        for at, bit in self._places(h):
            found &= (self.data[at] & bit) != 0
        return found


def shard_of(h: np.ndarray, shards: int) -> np.ndarray:
    return (common.doubling_hash(h, 0x2545F491) % np.uint64(shards)).astype(np.int64)


def suspects(docs: DataFrame, least_documents: int, least: int) -> DataFrame:
    """Pass 1: the hashes (h) of keys that, if no hashes collide, occur in enough documents; each once."""

    def hashed(batches):
        for batch in batches:
            # once per document; a batch sees the same key again if several of its documents have it
            all_of = [hashes({k for k in keys_of(t, least) if k is not None}) for t in common.text_bytes(batch)]
            h, n = np.unique(np.concatenate(all_of) if all_of else np.zeros(0, np.uint64), return_counts=True)
            again = n > 1
            yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in (h[~again], h[again], n[again].astype(np.int64))], names=["once", "twice", "counts"])

    found = common.written(docs.select("text").mapInArrow(hashed, "once binary, twice binary, counts binary"), "line-hashes")
    total = found.agg(F.coalesce(F.sum(F.octet_length("once") + F.octet_length("twice")), F.lit(0)).alias("n")).first()["n"] // 8
    shards = common.power_of_two(max(16, -(-total // HASHES_PER_SHARD)))

    def dealt(batches):
        held, size = ([], [], []), 0

        def sent():
            once, twice, counts = map(np.concatenate, held)
            columns, ends = [], []
            for h, *more in ((once,), (twice, counts)):
                own = shard_of(h, shards)
                order = np.argsort(own, kind="stable")
                ends += [np.searchsorted(own[order], np.arange(shards + 1))] * (1 + len(more))
                columns += [x[order] for x in (h, *more)]
            full = np.flatnonzero((ends[0][1:] > ends[0][:-1]) | (ends[1][1:] > ends[1][:-1])).tolist()
            return pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), *(pa.array([x[e[s] : e[s + 1]].tobytes() for s in full], pa.binary()) for x, e in zip(columns, ends))], names=["shard", "once", "twice", "counts"])

        for batch in batches:
            for raw in zip(*(c.to_pylist() for c in batch.columns)):
                for part, x, kind in zip(held, raw, (np.uint64, np.uint64, np.int64)):
                    part.append(np.frombuffer(x, kind))
                size += (len(raw[0]) + len(raw[1])) // 8
                if size >= HELD_HASHES:
                    yield sent()
                    held, size = ([], [], []), 0
        if size:
            yield sent()

    def repeats(rows: list) -> pa.RecordBatch:
        """A shard's hashes that are in its twice-seen filter and in enough documents."""
        parts = [tuple(np.frombuffer(x, kind) for x, kind in zip(row, (np.uint64, np.uint64, np.int64))) for row in rows]
        bits = max(1024, int(BITS_PER_KEY * sum(len(a) + len(b) for a, b, _ in parts)) // 8 * 8)
        seen, again = Filter(bits), Filter(bits)
        for single, several, _ in parts:
            again.add(np.concatenate([single[seen.has(single)], several]))
            seen.add(np.concatenate([single, several]))
        found = [(h[kept := again.has(h)], n[kept]) for a, b, counts in parts for h, n in ((a, np.ones(len(a), np.int64)), (b, counts))]
        h, at = np.unique(np.concatenate([h for h, _ in found]), return_inverse=True)
        documents = np.bincount(at, np.concatenate([n for _, n in found]), len(h))
        return pa.RecordBatch.from_arrays([pa.array(h[documents >= least_documents].view(np.int64))], names=["h"])

    def filtered(batches):
        """Rows come sorted by shard."""
        at, rows = None, []
        for batch in batches:
            for shard, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if shard != at and rows:
                    yield repeats(rows)
                    rows = []
                at = shard
                rows.append(row)
        if rows:
            yield repeats(rows)

    parts = found.mapInArrow(dealt, "shard int, once binary, twice binary, counts binary")
    out = common.written(parts.repartition(shards, "shard").sortWithinPartitions("shard").mapInArrow(filtered, "h long"), "suspected-lines")
    common.dropped(found)
    return out


def lines_of(docs: DataFrame, least: int, *more: str) -> DataFrame:
    """h, key and line (its number) of every distinct key of every document, with the document's columns ``more``."""
    source = docs.select(*more, "text")

    def run(batches):
        for batch in batches:
            rows, lines, keys = [], [], []
            for i, text in enumerate(common.text_bytes(batch)):
                seen = set()
                for n, k in enumerate(keys_of(text, least)):
                    if k is not None and k not in seen:
                        seen.add(k)
                        rows.append(i), lines.append(n), keys.append(k)
            at = pa.array(rows, pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(hashes(keys).view(np.int64)), pa.array(keys, pa.binary()), pa.array(lines, pa.int32()), *(common.column(batch, c).take(at) for c in more)], names=["h", "key", "line", *more])

    schema = T.StructType([T.StructField("h", T.LongType()), T.StructField("key", T.BinaryType()), T.StructField("line", T.IntegerType()), *(source.schema[c] for c in more)])
    return source.mapInArrow(run, schema)


def repeated(docs: DataFrame, least_documents: int, least: int, first: bool = True) -> DataFrame:
    """Pass 2: key, n_documents and, if wanted, first (doc_id, line, row) of every key in enough documents; then ``docs`` has ``row``, too."""
    lines = lines_of(docs, least, *["doc_id", "row"] * first)
    found = lines.join(suspects(docs, least_documents, least), "h", "left_semi").groupBy("key")
    exact = found.agg(F.count("*").alias("n_documents"), *[F.min(F.struct("doc_id", "line", "row")).alias("first")] * first)
    return common.written(exact.where(F.col("n_documents") >= least_documents), "repeated-lines")


def drop_repeated_lines(docs: DataFrame, least_documents: int = 10, least_chars: int = 1, keep: str = "none", sent_bytes: int = SENT_BYTES, counts: bool = True) -> DataFrame:
    """``docs`` with the lines of repeated keys taken out of ``text``.

    keep: "none" drops all their lines, "first" keeps the first occurrence.
    counts adds n_lines and n_dropped, or takes the place of input columns of
    those names; without it the result has just the columns of ``docs``.  A
    null text stays null without counts and becomes the empty text with them.
    """
    if keep not in ("none", "first"):
        raise ValueError("keep is none or first")
    spark = common.text_session(docs.sparkSession)
    # For first occurrences rows get a number, which is fixed by writing them. A column holds the whole row, so no name can clash.
    number = lambda: common.written(docs.select(F.struct(*docs.columns).alias("whole"), F.monotonically_increasing_id().alias("row")), "numbered-documents")
    numbered = number() if keep == "first" else None
    frequent = repeated(numbered.select("whole.doc_id", "whole.text", "row") if numbered else docs.select("text"), least_documents, least_chars, keep == "first")
    size = frequent.agg(F.coalesce(F.sum(F.octet_length("key") + BYTES_PER_KEY), F.lit(0)).alias("n")).first()["n"]
    docs = docs.drop("n_lines", "n_dropped") if counts else docs
    schema = common.wider(docs.schema, n_lines="long", n_dropped="long") if counts else docs.schema
    at, width, names = docs.columns.index("text"), len(docs.columns), schema.names
    whole = [F.col(f"whole.`{c}`").alias(c) for c in docs.columns]

    def cleaned(batch, dropped):
        """``dropped`` gives, for a row's number, a test of (line's number, line)."""
        out, lines, lost = [], [], []
        for i, (text, null) in enumerate(zip(common.text_bytes(batch), batch.column(at).is_null().to_pylist())):
            all_lines = text.split(b"\n")
            drop = dropped(i)
            kept = [x for k, x in enumerate(all_lines) if not drop(k, x)]
            out.append(None if null and not counts else (b"\n".join(kept) if len(kept) < len(all_lines) else text))
            lines.append(len(all_lines))
            lost.append(len(all_lines) - len(kept))
        own = pa.array(out, pa.binary()).cast(batch.schema.field(at).type)
        columns = [own if i == at else c for i, c in enumerate(batch.columns[:width])]
        extra = [pa.array(lines, pa.int64()), pa.array(lost, pa.int64())] if counts else []
        return pa.RecordBatch.from_arrays([*columns, *extra], names=names)

    if size <= sent_bytes:
        sent = spark.sparkContext.broadcast({bytes(r["key"]): (r["first"]["row"], r["first"]["line"]) if keep == "first" else None for r in frequent.collect()})

        def clean(batches):
            first = sent.value
            for batch in batches:
                if keep == "none":
                    yield cleaned(batch, lambda i: lambda k, line: key_of(line) in first)
                else:
                    rows = batch.column(width).to_pylist()
                    yield cleaned(batch, lambda i, rows=rows: lambda k, line: (place := first.get(key_of(line))) is not None and place != (rows[i], k))

        return (numbered.select(*whole, F.col("row").alias("number of the row")) if numbered else docs).mapInArrow(clean, schema)

    # Too many keys to send: lines are joined with them.
    numbered = numbered or number()
    lines = lines_of(numbered.select("row", "whole.text"), least_chars, "row").join(frequent, "key")
    if keep == "first":
        lines = lines.withColumn("kept", F.when(F.col("row") == F.col("first.row"), F.col("first.line")))
    else:
        lines = lines.withColumn("kept", F.lit(None).cast("int"))
    lost = lines.groupBy("row").agg(F.collect_list(F.struct("key", "kept")).alias("lost"))

    def clean_joined(batches):
        for batch in batches:
            lost = [{x["key"]: x["kept"] for x in of_row or ()} for of_row in batch.column(width).to_pylist()]
            yield cleaned(batch, lambda i, lost=lost: lambda k, line: (key := key_of(line)) in lost[i] and lost[i][key] != k)

    return numbered.join(lost, "row", "left").select(*whole, F.col("lost").alias("lost lines of the row")).mapInArrow(clean_joined, schema)
