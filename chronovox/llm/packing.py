"""Best-fit packing of token sequences under several capacities at once.

Every item is a vector: its tokens, one document, and its attention cost (the
square of its tokens).  Items of one length are alike, so the packing itself
needs only the number of items of each length, at most ``capacity`` numbers
however many items there are.  Lengths go from long to short; each item goes
to the bin, among those that it fits under every constraint, which scores
best: least weighted norm of the residual, or greatest weighted dot product
of item and residual.  Bins in the same state are kept as one run of bins,
so the plan is a short table (length, first rank, bins, offset).  An item
finds its place there by its rank among the items of its length.

Ranks come from counts per task and length, not from a sort of the items, so
no task ever holds all items of a length.

Defined cases: columns sequence_id and offset of the input give way to the
result's, and no other name can clash; an item of length 0 does not occur (a document always has its
end id); ties between equal lengths are settled by task and place in it;
repeated rows are separate items; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import bpe, common


def plan(counts: dict[int, int], capacity: int, documents: int, cost: int, weights=(1.0, 1e-3, 1e-3), score: str = "norm") -> list[tuple[int, int, int, int, int]]:
    """Rows (length, first rank, number, first bin, offset): that many items of the length go to as many bins in a row."""
    if score not in ("norm", "dot"):
        raise ValueError("score is norm or dot")
    full = np.array([capacity, documents, cost], float)
    scale = np.sqrt(np.array(weights, float)) / full
    states = np.zeros((1024, 3), np.int64)  # what is left in a bin of the run
    runs = np.zeros((1024, 2), np.int64)  # first bin, number of bins
    used = bins = 0
    rows = []

    def put(state, first, number):
        nonlocal used, states, runs
        if number:
            if used == len(states):
                states, runs = np.concatenate([states, states * 0]), np.concatenate([runs, runs * 0])
            states[used], runs[used] = state, (first, number)
            used += 1

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        item = np.array([length, 1, length * length], np.int64)
        if left and (length > capacity or documents < 1 or item[2] > cost):
            raise ValueError(f"an item of {length} tokens fits no empty bin")
        while left:
            fits = np.flatnonzero((states[:used] >= item).all(1) & (runs[:used, 1] > 0))
            if len(fits):
                rest = (states[fits] - item) * scale
                value = (rest * rest).sum(1) if score == "norm" else -((states[fits] * scale) * (item * scale)).sum(1)
                k = int(fits[np.argmin(value)])
                state, (first, number) = states[k].copy(), runs[k].copy()
            else:
                # as many new bins as items of this length fill at most; the next turns fill them up
                each = max(1, int(min(capacity // length, documents, cost // item[2]))) if length else 1
                state, first, number = full.astype(np.int64), bins, -(-left // each)
                bins += number
                put(state, first, number)
                k = used - 1
            take = min(left, int(number))
            rows.append((length, rank, take, int(first), int(capacity - state[0])))
            runs[k] = first + take, number - take
            put(state - item, first, take)
            left, rank = left - take, rank + take
            if not runs[k, 1]:  # the last run takes the place of the used-up one
                used -= 1
                states[k], runs[k] = states[used], runs[used]
    return rows


def ranked(items: DataFrame, length_col: str) -> DataFrame:
    """item (a row of ``items``), length, task and rank (place among the task's items of that length), written to the shared folder."""
    # Written first: items that Python makes would be numbered in the same stage, by a second Python worker for each core.
    source = common.written(items.select(F.struct(*items.columns).alias("item"), F.col(length_col).cast("long").alias("length")), "items")

    def number(batches):
        task, seen = TaskContext.get().partitionId(), {}
        for batch in batches:
            lengths = common.column(batch, "length").to_pylist()
            ranks = []
            for n in lengths:
                ranks.append(seen.get(n, 0))
                seen[n] = ranks[-1] + 1
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([task] * len(lengths), pa.int32()), pa.array(ranks, pa.int64())], names=["item", "length", "task", "rank"])

    out = common.written(source.mapInArrow(number, common.wider(source.schema, task="int", rank="long")), "pieces")
    common.dropped(source)
    return out


def pack(items: DataFrame, length_col: str = "length", capacity: int = 1024, documents: int | None = None, cost: int | None = None, weights=(1.0, 1e-3, 1e-3), score: str = "norm") -> DataFrame:
    """``items`` with sequence_id and offset.

    documents and cost (sum of squared lengths) bound a bin besides its
    tokens; unset, they are as large as a full bin can need.
    """
    documents = capacity if documents is None else documents
    cost = capacity * capacity if cost is None else cost
    items = items.drop("sequence_id", "offset")
    known = ranked(items, length_col)
    each = known.groupBy("task", "length").agg(F.count("*").alias("count"))
    before = F.coalesce(F.sum("count").over(Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = {r["length"]: r["c"] for r in each.groupBy("length").agg(F.sum("count").alias("c")).collect()}  # a row per length
    rows = plan(counts, capacity, documents, cost, weights, score)
    # A turn of the plan ends a length or uses up a run, and makes at most two runs for a length: so under capacity squared rows of 40 bytes.
    table = np.array(rows, np.int64).reshape(-1, 5)
    table = table[np.lexsort((table[:, 1], table[:, 0]))]
    shared = items.sparkSession.sparkContext.broadcast(table)
    placed = known.join(each.select("task", "length", before.alias("before")), ["task", "length"]).select("item", "length", (F.col("rank") + F.col("before")).alias("rank"))

    def place(batches):
        t = shared.value
        keys = t[:, 0] << 40 | t[:, 1]
        for batch in batches:
            length, rank = (common.column(batch, c).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            found = np.searchsorted(keys, length << 40 | rank, side="right") - 1
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(t[found, 3] + rank - t[found, 1]), pa.array(t[found, 4])], names=["item", "sequence_id", "offset"])

    out = placed.mapInArrow(place, common.wider(placed.select("item").schema, sequence_id="long", offset="long"))
    return out.select(*[F.col(f"item.`{c}`").alias(c) for c in items.columns], "sequence_id", "offset")


PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("ids", pa.list_(pa.int32()))])


def pieces(docs: DataFrame, path: str, capacity: int = 1024, end_id: int = 2, with_ids: bool = False) -> DataFrame:
    """Every document's ids and the end id, cut into pieces of ``capacity``; a longer document's first piece takes the remainder."""
    common.text_session(docs.sparkSession)
    schema = pa.schema(list(PIECES)[: None if with_ids else -1])

    def run(batches):
        coder = bpe.loaded_library(path)
        for batch in batches:
            rows = {f.name: [] for f in PIECES}
            for doc, text in zip(common.column(batch, "doc_id").to_pylist(), common.texts(batch)):
                ids = np.append(coder.packed(text).astype("<u4"), np.uint32(end_id)).astype("<u4")
                first = len(ids) % capacity or capacity
                cuts = [0, *range(min(first, len(ids)), len(ids) + 1, capacity)]
                for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    part = ids[a:b]
                    for name, value in zip(rows, (doc, k, a, b - a, zlib.crc32(part.tobytes()), part if with_ids else None)):
                        rows[name].append(value)
            yield common.made(schema, **{f.name: rows[f.name] for f in schema})

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids)


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves: sequence_id, ids, and the documents' lengths in order (for attention masks).

    ``packed`` is the result of pack() over pieces(with_ids=True).  A group
    is one sequence and so at most ``capacity`` tokens.
    """
    return packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "length", "ids"))).alias("p")).select("sequence_id", F.flatten("p.ids").alias("ids"), F.col("p.length").alias("lengths"))
