"""Exact top-k search by inner product.

Vectors are integers (each component times ``scale``, rounded down), and so are
scores: sums of doubles where the product of the lengths is below 2^53, where
every such sum is exact, and 64-bit integers elsewhere.  A score that no long
holds raises an error.  Candidates are sorted by length, longest first, and packed
into parts of bounded size.  Queries are packed into blocks of bounded size.
A part meets every block in one task, which holds the part and lets the
blocks pass: a stated query set against all rows, in blocks.

Space is rotated by the singular vectors of the candidates (the eigenvectors
of their Gram matrix, which is summed in the tasks and in slices), so that
the first dimensions hold most of every length.  A part is searched in tiles
in order of length.  By Cauchy-Schwarz, a query leaves the part once the
product of the lengths cannot reach its k-th score.  Of a tile's pairs, the
partial sums over the first dimensions are formed in steps, each of twice as
many dimensions; pairs whose partial sum plus the product of the residual
lengths cannot reach the k-th score are dropped after each step, and a tile
shrinks to the rows and columns that are left.  Only pairs that survive all
steps are scored.  Bounds carry a slack for rounding; a candidate is never
lost to it, as the score itself is computed in whole numbers.

A query's k-th score begins as that among a first few of the longest
candidates, which every task gets; they are at most SEED and a sixteenth of
the table.

Defined cases: vectors that are null, or hold null or non-finite components,
take no part; so do vectors whose dimension is not the most frequent (of
ties, the largest) one; ids may be null or repeated: a query is a row whose id
is divisible, and its own row only is left out; ties go to the smaller id,
and among equal ids to any; further columns are passed over.  The driver
holds one matrix of dimension x dimension and the first few candidates, so
vectors may have some thousands of dimensions.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

#: Bytes of a part of candidates and of a block of queries, and the longest candidates that give the first scores.
PART_BYTES, BLOCK_BYTES, SEED = 32 << 20, 8 << 20, 1024
#: Candidates and queries of a tile, and dimensions of the first partial sum.
TILE, ROWS, FIRST = 1024, 512, 8
#: A pair is scored by itself if under this share of a tile is left, and in one product of the tile otherwise.
SPARSE = 0.05
NO_ID, LARGE = np.iinfo(np.int64).max - 1, np.iinfo(np.int64).max
#: Less than any score; sums of whole doubles below this bound are exact; the first number beyond a long.
NONE, EXACT, BEYOND = np.iinfo(np.int64).min, 2.0**53, 2.0**63


class Best:
    """The k best (score, -vec_id) of each query, kept as two matrices."""

    def __init__(self, queries: int, k: int):
        self.score = np.full((queries, k), NONE)
        self.id = np.full((queries, k), LARGE)
        self.k = k

    def offer(self, query: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        """Take up further triples; ``query`` may repeat."""
        if not len(query):
            return
        asked = np.unique(query)
        q = np.concatenate([query, np.repeat(asked, self.k)])
        s = np.concatenate([score, self.score[asked].ravel()])
        v = np.concatenate([ids, self.id[asked].ravel()])
        order = np.lexsort((v, ~s, q))  # ~s falls as s rises, and has no overflow
        q, s, v = q[order], s[order], v[order]
        place = np.arange(len(q)) - np.searchsorted(q, q)
        keep = place < self.k
        self.score[q[keep], place[keep]], self.id[q[keep], place[keep]] = s[keep], v[keep]


class Space:
    """The rotation, and the ends of the steps."""

    def __init__(self, gram: np.ndarray):
        values, vectors = np.linalg.eigh(gram)
        self.turn = vectors[:, np.argsort(-values, kind="stable")]
        self.steps = [0]
        while self.steps[-1] < len(gram):
            self.steps.append(min(len(gram), 2 * self.steps[-1] or FIRST))


class Vectors:
    """Rows with their ids, row numbers and lengths; turned, also the rotated rows and what is left of each length after every step."""

    def __init__(self, x: np.ndarray, ids: np.ndarray, rows: np.ndarray, space: Space | None = None):
        self.x, self.id, self.row = x, ids, rows
        self.length = np.sqrt((x**2).sum(axis=1))
        if len(x) and not np.isfinite(self.length).all():
            raise OverflowError("a vector is too long for scores in whole numbers of 64 bits")
        if space is not None:
            self.turned = x @ space.turn
            parts = [(self.turned[:, a:b] ** 2).sum(axis=1) for a, b in zip(space.steps, space.steps[1:])]
            self.rest = np.sqrt(np.cumsum([np.zeros(len(x)), *parts[:0:-1]], axis=0)[::-1])

    @classmethod
    def packed(cls, row: dict, space: Space | None = None) -> Vectors:
        ids = np.frombuffer(row["ids"], np.int64)
        return cls(np.frombuffer(row["x"]).reshape(len(ids), -1), ids, np.frombuffer(row["rows"], np.int64), space)


def products(x: np.ndarray, y: np.ndarray, longest: float) -> np.ndarray:
    """Inner products of rows as integers; ``longest`` bounds the product of two lengths."""
    near = np.einsum("ij,ij->i", x, y)
    if longest < EXACT:
        return near.astype(np.int64)
    if max(np.abs(x).max(initial=0), np.abs(y).max(initial=0)) >= BEYOND or np.abs(near).max(initial=0) >= BEYOND * (1 - 1e-9):
        raise OverflowError("a score is beyond 64 bits")
    return np.einsum("ij,ij->i", x.astype(np.int64), y.astype(np.int64))  # what overflows on the way comes back, as the sum fits


def search(best: Best, threshold: np.ndarray, queries: Vectors, candidates: Vectors, space: Space) -> int:
    """Offer to ``best`` every candidate that may be among a query's k best; candidates in descending order of length.

    Returns the number of pairs whose products were formed over all dimensions.
    """
    slack, scored, n = 1e-6, 0, len(queries.x)
    for at in range(0, len(candidates.x), TILE):
        reach = slack * (1 + queries.length * candidates.length[at])
        need = np.maximum(threshold, best.score[:, -1]) - reach
        open_to = np.flatnonzero(queries.length * candidates.length[at] >= need)
        if not len(open_to):
            break  # candidates only get shorter
        for i in range(0, len(open_to), ROWS):
            q, c = open_to[i : i + ROWS], np.arange(at, min(at + TILE, len(candidates.x)))
            partial = np.zeros((len(q), len(c)))
            alive = np.ones((len(q), len(c)), bool)
            for k, (a, b) in enumerate(zip(space.steps, space.steps[1:])):
                if b == space.steps[-1]:
                    scored += int(alive.sum())
                partial += queries.turned[q, a:b] @ candidates.turned[c, a:b].T
                alive &= partial + queries.rest[k][q][:, None] * candidates.rest[k][c] >= need[q][:, None]
                rows, columns = alive.any(axis=1), alive.any(axis=0)
                if not rows.all() or not columns.all():
                    q, c = q[rows], c[columns]
                    partial, alive = partial[rows][:, columns], alive[rows][:, columns]
            alive &= queries.row[q][:, None] != candidates.row[c]
            rows, columns = np.nonzero(alive)
            if not len(rows):
                continue
            longest = float(queries.length[q].max() * candidates.length[at])
            if longest >= EXACT or len(rows) < SPARSE * alive.size:
                score = products(queries.x[q[rows]], candidates.x[c[columns]], longest)
            else:
                score = (queries.x[q] @ candidates.x[c].T)[rows, columns].astype(np.int64)
            enough = score >= need[q[rows]]
            best.offer(q[rows[enough]], score[enough], candidates.id[c[columns[enough]]])
    return scored


def packs(rows: DataFrame, per_pack: int, dimension: int) -> DataFrame:
    """``rows`` (id, row, x) packed: ids, rows and x of up to ``per_pack`` rows in a row's order, as bytes, and the greatest length."""

    def run(batches):
        held, size = [], 0

        def done():
            columns = [np.concatenate([h[k] for h in held]) for k in range(3)]
            longest = np.sqrt((columns[2].reshape(-1, dimension) ** 2).sum(axis=1).max())
            return pa.RecordBatch.from_arrays([*(pa.array([c.tobytes()], pa.binary()) for c in columns), pa.array([longest])], names=["ids", "rows", "x", "longest"])

        for batch in batches:
            ids = common.column(batch, "id").fill_null(NO_ID).to_numpy(zero_copy_only=False)
            numbers = common.column(batch, "row").to_numpy(zero_copy_only=False)
            x = common.column(batch, "x").flatten().to_numpy(zero_copy_only=False).reshape(-1, dimension)
            for i in range(0, len(ids), per_pack):
                part = slice(i, i + per_pack)
                if size + len(ids[part]) > per_pack:
                    yield done()
                    held, size = [], 0
                held.append((ids[part], numbers[part], x[part].ravel()))
                size += len(ids[part])
        if size:
            yield done()

    return rows.select("id", "row", "x").mapInArrow(run, "ids binary, rows binary, x binary, longest double")


def gram_of(rows: DataFrame, dimension: int) -> np.ndarray:
    """Sum of the outer products of all rows; tasks sum their own rows, and each of its lines is summed by itself."""

    def own(batches):
        total = np.zeros((dimension, dimension))
        for batch in batches:
            x = common.column(batch, "x").flatten().to_numpy(zero_copy_only=False).reshape(-1, dimension)
            total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(range(dimension), pa.int32()), pa.array([r.tobytes() for r in total], pa.binary())], names=["line", "sums"])

    def both(batches):
        sums = {}
        for batch in batches:
            for line, raw in zip(*(c.to_pylist() for c in batch.columns)):
                sums[line] = sums.get(line, 0) + np.frombuffer(raw)
        yield pa.RecordBatch.from_arrays([pa.array(sums, pa.int32()), pa.array([v.tobytes() for v in sums.values()], pa.binary())], names=["line", "sums"])

    parts = rows.select("x").mapInArrow(own, "line int, sums binary")
    lines = parts.repartition(min(dimension, 64), "line").mapInArrow(both, "line int, sums binary").collect()  # dimension squared numbers
    total = np.zeros((dimension, dimension))
    for r in lines:
        total[r["line"]] = np.frombuffer(r["sums"])
    return total


def top_k(vectors: DataFrame, k: int = 5, every: int = 50, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding", part_bytes: int = PART_BYTES, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """query_id, rank, vec_id and score: for each row whose id is divisible by ``every``, the k best of all other rows."""
    spark = vectors.sparkSession
    v = F.col(vector_col)
    usable = v.isNotNull() & ~F.exists(v, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    # beyond 2^53 a double is whole, and floor() would hold it within a long
    down = lambda y: F.when(F.abs(y) < EXACT, F.floor(y).cast("double")).otherwise(y)
    whole = F.transform(v, lambda x: down(x.cast("double") * scale))
    # Also the square of the length, an exact integer, to sort rows by.
    source = vectors.where(usable).select(F.col(id_col).cast("long").alias("id"), whole.alias("x")).withColumn("square", F.aggregate("x", F.lit(0.0), lambda a, b: a + b * b))
    sizes = source.groupBy(F.size("x").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).limit(1).collect()
    schema = "query_id long, rank int, vec_id long, score long"
    if not sizes or not sizes[0]["n"]:
        return spark.createDataFrame([], schema)
    dimension, count = sizes[0]["n"], sizes[0]["count"]
    per_part, per_block = (max(1, size // (8 * dimension)) for size in (part_bytes, block_bytes))
    ordered = source.where(F.size("x") == dimension).repartitionByRange(max(common.scan_partitions(source), -(-count // per_part)), F.desc("square")).sortWithinPartitions(F.desc("square"))
    known = common.written(ordered.withColumn("row", F.monotonically_increasing_id()), "vectors")
    space = Space(gram_of(known, dimension))
    seed = known.orderBy(F.desc("square"), "id").limit(max(1, min(SEED, count // 16))).collect()
    asked = known.where(F.pmod("id", F.lit(every)) == 0)
    first = spark.sparkContext.broadcast((space, np.array([r["x"] for r in seed]), np.array([NO_ID if r["id"] is None else r["id"] for r in seed], np.int64), np.array([r["row"] for r in seed], np.int64)))

    def begun(batches):
        """Each block's first k-th scores, and how long a candidate must be to reach one of them."""
        space, x, ids, rows = first.value
        longest = Vectors(x, ids, rows, space)
        for batch in batches:
            scores, wanted = [], []
            for row in batch.to_pylist():
                queries = Vectors.packed(row, space)
                best = Best(len(queries.x), k)
                search(best, np.full(len(queries.x), NONE), queries, longest, space)
                scores.append(best.score[:, -1].tobytes())
                least = np.where(queries.length > 0, best.score[:, -1] / np.maximum(queries.length, 1e-300), np.where(best.score[:, -1] > 0, np.inf, 0))
                wanted.append(float(least.min()) * (1 - 1e-6) - 1e-6)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.binary()), pa.array(wanted)], names=[*batch.schema.names, "least", "wanted"])

    # Packs of candidates are numbered; a block of queries goes to every part that is long enough, after the part itself.
    parts = common.written(packs(known, per_part, dimension).withColumn("part", F.monotonically_increasing_id()), "candidates")
    blocks = common.written(packs(asked.repartition(common.scan_partitions(asked)), per_block, dimension).mapInArrow(begun, "ids binary, rows binary, x binary, longest double, least binary, wanted double"), "queries")
    numbers = [(r["part"], r["longest"]) for r in parts.select("part", "longest").collect()]  # two numbers per PART_BYTES of the table
    places = parts.select("part", "ids", "rows", "x", F.lit(None).cast("binary").alias("least"))
    known_parts = F.array(*[F.struct(F.lit(n).alias("part"), F.lit(longest).alias("longest")) for n, longest in numbers])
    passing = blocks.select(F.explode(F.filter(known_parts, lambda p: p["longest"] >= F.col("wanted"))).alias("to"), "ids", "rows", "x", "least").select("to.part", "ids", "rows", "x", "least")
    meeting = places.union(passing).repartition(len(numbers), "part").sortWithinPartitions("part", F.asc_nulls_first("least"))

    def run(batches):
        space, held = first.value[0], None
        for batch in batches:
            for i in range(len(batch)):
                row = {name: batch.column(j)[i].as_py() for j, name in enumerate(batch.schema.names)}
                if row["least"] is None:
                    held = Vectors.packed(row, space)
                    continue
                queries = Vectors.packed(row, space)
                best = Best(len(queries.x), k)
                search(best, np.frombuffer(row["least"], np.int64), queries, held, space)
                q, place = np.nonzero(best.id != LARGE)
                ids = best.id[q, place]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(queries.row[q]), pa.array(queries.id[q]), pa.array(ids, mask=ids == NO_ID), pa.array(best.score[q, place])],
                    names=["query", "query_id", "vec_id", "score"],
                )

    found = meeting.mapInArrow(run, "query long, query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("vec_id")))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
