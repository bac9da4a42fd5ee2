"""One row per voxel with its frames as an array, and kernels over it.

Kernels whose result for a voxel depends only on that voxel and a small
matrix of its scan (regressors, frame mask) run on Arrow batches of any
voxels; the scan's matrix comes in by a join on scan_id.  Nothing is gathered
by scan.  What needs all voxels of a scan goes through the scan's Gram
matrix over frames, which is summed in the tasks.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.shared import small_batches

DOUBLES = pa.list_(pa.float64())
#: Cells of Gram matrices that a task holds before it passes them on.
HELD_CELLS = 4_000_000
#: Cells of series that a kernel gets at a time.
KERNEL_CELLS = 1 << 18


def to_series(bold: DataFrame) -> DataFrame:
    """scan_id, voxel_id, t and v (arrays, frames ascending). A group is one voxel's frames."""
    s = F.array_sort(F.collect_list(F.struct("t", "value")))
    return bold.groupBy("scan_id", "voxel_id").agg(s.alias("s")).select("scan_id", "voxel_id", F.col("s.t").alias("t"), F.col("s.value").alias("v"))


def to_bold(series: DataFrame, value: str = "v") -> DataFrame:
    z = F.explode(F.arrays_zip(F.col("t").alias("t"), F.col(value).alias("value"))).alias("z")
    return series.select("scan_id", "voxel_id", z).select("scan_id", "voxel_id", "z.t", "z.value")


def to_design(regressors: DataFrame) -> DataFrame:
    """scan_id, names and x (one array of frames per regressor) from long regressors (scan_id, name, t, value)."""
    one = regressors.groupBy("scan_id", "name").agg(F.array_sort(F.collect_list(F.struct("t", "value"))).alias("s"))
    both = one.groupBy("scan_id").agg(F.array_sort(F.collect_list(F.struct("name", F.col("s.value").alias("x")))).alias("d"))
    return both.select("scan_id", F.col("d.name").alias("names"), F.col("d.x").alias("x"))


def rows_of(column: pa.Array, rows: np.ndarray) -> np.ndarray:
    """Lists of equal length as a matrix (rows, length); nulls in them are NaN."""
    lists = column.take(pa.array(rows))
    return lists.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(rows), -1)


def lists_of(matrix: np.ndarray) -> pa.Array:
    """A matrix's rows as lists."""
    offsets = np.arange(len(matrix) + 1, dtype=np.int32) * matrix.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.ascontiguousarray(matrix, float).ravel()))


def by_scan(batch: pa.RecordBatch, names: list[str]):
    """(scan, its row numbers) of a batch; null is a scan too."""
    codes = batch.column(names.index("scan_id")).dictionary_encode()
    own, scans = codes.indices.fill_null(-1).to_numpy(zero_copy_only=False), codes.dictionary.to_pylist()
    for k in np.unique(own):
        yield scans[k] if k >= 0 else None, np.flatnonzero(own == k)


def pieces(batches, name: str):
    """Batches in pieces whose lists ``name`` have at most KERNEL_CELLS elements, or one row."""
    for batch in batches:
        longest = pc.max(batch.column(batch.schema.get_field_index(name)).value_lengths()).as_py() or 1
        most = max(1, KERNEL_CELLS // longest)
        for at in range(0, max(1, batch.num_rows), most):
            yield batch.slice(at, most)


def per_voxel(series: DataFrame, kernel: Callable, added: str, *more: str) -> DataFrame:
    """Add array columns ``added`` ("a array<double>, ...") from kernel(values (frames, voxels), *scan columns).

    Rows that share a scan go to the kernel together, up to KERNEL_CELLS at
    once, as a kernel holds several copies of what it gets.  A kernel that
    raises LinAlgError gives nulls: the scan cannot be fitted.
    """
    if more:
        small_batches(series.sparkSession)  # each row brings its scan's matrix along
    fields = T._parse_datatype_string(added).fields
    schema = T.StructType([*series.schema.fields, *fields])
    names = series.columns
    kinds = [DOUBLES if isinstance(f.dataType, T.ArrayType) else pa.float64() for f in fields]

    def run(batches):
        for batch in pieces(batches, "v"):
            order, outs = [np.zeros(0, np.int64)], [[pa.array([], k)] for k in kinds]
            for scan, rows in by_scan(batch, names):
                extra = [batch.column(names.index(m))[int(rows[0])].as_py() for m in more]
                order.append(rows)
                try:
                    got = kernel(rows_of(batch.column(names.index("v")), rows).T, *extra)
                except np.linalg.LinAlgError:
                    got = (None,) * len(fields)
                for out, kind, g in zip(outs, kinds, got if isinstance(got, tuple) else (got,)):
                    out.append(pa.nulls(len(rows), kind) if g is None else lists_of(g.T) if np.ndim(g) == 2 else pa.array(g, pa.float64()))
            back = pa.array(np.argsort(np.concatenate(order), kind="stable"))
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.concat_arrays(o).take(back) for o in outs)], names=schema.names)

    return series.mapInArrow(run, schema)


def frame_gram(series: DataFrame, centre: bool = True) -> DataFrame:
    """scan_id, gram: per scan the Gram matrix of its voxels over frames; with ``centre`` each voxel's mean is removed.

    Tasks sum their own voxels, up to HELD_CELLS at once; the lines of all
    tasks' matrices are then summed each by itself.  A scan's matrix, frames
    by frames, is one row of the result.
    """

    def lines(sums):
        scans, places, rows = [], [], []
        for scan, total in sums.items():
            scans += [scan] * len(total)
            places += range(len(total))
            rows.append(lists_of(total))
        return pa.RecordBatch.from_arrays([pa.array(scans, pa.string()), pa.array(places, pa.int32()), pa.concat_arrays([pa.array([], DOUBLES), *rows])], names=["scan_id", "line", "sums"])

    def part(batches):
        sums, held = {}, 0
        for batch in pieces(batches, "v"):
            for scan, rows in by_scan(batch, ["scan_id", "v"]):
                y = rows_of(batch.column(1), rows)
                y = y - y.mean(axis=1, keepdims=True) if centre else y
                held += 0 if scan in sums else y.shape[1] ** 2
                sums[scan] = sums.get(scan, 0) + y.T @ y
            if held > HELD_CELLS:
                yield lines(sums)
                sums, held = {}, 0
        if sums:
            yield lines(sums)

    def whole(batches):
        """Rows come sorted by scan and line."""
        at, total = None, None
        done = lambda: pa.RecordBatch.from_arrays([pa.array([at[0]], pa.string()), pa.array([at[1]], pa.int32()), lists_of(total[None])], names=["scan_id", "line", "sums"])
        for batch in batches:
            for i, key in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                own = batch.column(2)[i].values.to_numpy(zero_copy_only=False)
                if key == at:
                    total = total + own
                    continue
                if at is not None:
                    yield done()
                at, total = key, own
        if at is not None:
            yield done()

    kind = "scan_id string, line int, sums array<double>"
    parts = series.select("scan_id", "v").mapInArrow(part, kind).repartition("scan_id", "line").sortWithinPartitions("scan_id", "line").mapInArrow(whole, kind)
    return parts.groupBy("scan_id").agg(F.flatten(F.array_sort(F.collect_list(F.struct("line", "sums")))["sums"]).alias("gram"))


def square(cells) -> np.ndarray:
    cells = np.array(cells, float)
    return cells.reshape(round(np.sqrt(len(cells))), -1)


def by_rows(data: DataFrame, kernel: Callable, *more: str, held: int = 1 << 19) -> DataFrame:
    """scan_id, voxel_id, t and ``v`` after kernel(values (voxels, frames), *columns ``more``) on rows of one length at a time, of whatever scans."""
    schema = T.StructType([data.schema[c] for c in ("scan_id", "voxel_id", "t")] + [T.StructField("v", T.ArrayType(T.DoubleType()))])

    def run(batches):
        for batch in batches:
            column = lambda c, batch=batch: batch.column(batch.schema.get_field_index(c))
            sizes = column("v").value_lengths().to_numpy()
            for n in np.unique(sizes):
                own = np.flatnonzero(sizes == n)
                for at in range(0, len(own), max(1, held // max(1, int(n)))):
                    rows = own[at : at + max(1, held // max(1, int(n)))]
                    values = rows_of(column("v"), rows)
                    out = kernel(values, *[column(c).to_numpy(zero_copy_only=False)[rows] for c in more]) if n else values
                    yield pa.RecordBatch.from_arrays([*(column(c).take(pa.array(rows)) for c in ("scan_id", "voxel_id", "t")), lists_of(out)], names=["scan_id", "voxel_id", "t", "v"])

    return data.mapInArrow(run, schema)


def per_row(frame: DataFrame, kernel: Callable, schema: str) -> DataFrame:
    """kernel(row as a dict) yields tuples; for frames with one short row per scan."""

    names = T._parse_datatype_string(schema).names

    def run(batches):
        import pandas as pd

        for batch in batches:
            rows = [out for row in batch.to_dict("records") for out in kernel(row)]
            if rows:
                yield pd.DataFrame(rows, columns=names)

    return frame.mapInPandas(run, schema)


def per_scan(frame: DataFrame, kernel: Callable, schema: str) -> DataFrame:
    """kernel(pandas frame of one scan) for operators that need one scan's short table at once."""
    return frame.groupBy("scan_id").applyInPandas(kernel, schema)


def row_numbers(frame: DataFrame, *keys: str) -> DataFrame:
    return frame.withColumn("i", F.row_number().over(Window.partitionBy(*keys).orderBy("t")))
