"""Smooth fields of intensity: what a coil adds to an image, found from the image's own histogram and taken out.

The logarithm of an image is tissue plus field.  A round sharpens the
histogram of what is so far left (a deconvolution by a narrow Gaussian), which
says for every intensity what it would be without a field, and fits the rest by
a cubic B-spline on few control points.  Both are sums over voxels: bricks add
to histograms and to the sums of each control point, and only those are
shuffled.  Levels double the control points' density.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..kernels import spatial
from ..sources.shared import bucketed, dropped, written
from . import bricks

BINS = 200
#: Full width of the deconvolution's Gaussian (in logarithms), and the noise share of its Wiener filter.
WIDTH, NOISE = 0.15, 0.01


def basis(n: int, spans: int, at: np.ndarray) -> np.ndarray:
    """Weights (places, spans + 3) of the control points at coordinates of an axis of n voxels."""
    t = np.clip(at, 0, n - 1) / max(1, n - 1) * spans
    return spatial.cubic(t[:, None] - (np.arange(spans + 3) - 1))


def field_of(control: np.ndarray, axes: list[np.ndarray]) -> np.ndarray:
    """The spline on a box, from its control points and each axis' weights."""
    return np.einsum("abc,xa,yb,zc->xyz", control, *axes, optimize=True)


def control_sums(rest: np.ndarray, axes: list[np.ndarray]) -> np.ndarray:
    """For scattered-data approximation: each control point's sums of w^3 r / s and w^2, s the sum of a voxel's w^2. NaN takes no part."""
    known = np.isfinite(rest)
    up, down = [a**3 / np.maximum((a**2).sum(axis=1, keepdims=True), 1e-300) for a in axes], [a**2 for a in axes]
    return np.stack([np.einsum("xyz,xa,yb,zc->abc", np.where(known, rest, 0.0), *up, optimize=True), np.einsum("xyz,xa,yb,zc->abc", known.astype(float), *down, optimize=True)])


def sharpened(h: np.ndarray, low: float, high: float) -> np.ndarray:
    """What each bin's intensity is expected to be without the field."""
    n, step = len(h), (high - low) / (len(h) - 1) if high > low else 1.0
    size = 2 * spatial_power(n)
    centres = low + step * np.arange(n)
    d = np.minimum(np.arange(size), size - np.arange(size)) * step
    blur = np.exp(-4 * np.log(2) * (d / WIDTH) ** 2)
    blur = np.fft.rfft(blur / blur.sum())
    filled = np.zeros(size)
    filled[size // 4 : size // 4 + n] = h
    wiener = np.conj(blur) / (np.abs(blur) ** 2 + NOISE)
    plain = np.maximum(np.fft.irfft(np.fft.rfft(filled) * wiener, size), 0)
    place = low + step * (np.arange(size) - size // 4)
    top, bottom = (np.fft.irfft(np.fft.rfft(v) * blur, size)[size // 4 : size // 4 + n] for v in (plain * place, plain))
    return np.where(bottom > 1e-9 * max(bottom.max(), 1e-300), top / np.where(bottom == 0, 1, bottom), centres)


def spatial_power(n: int) -> int:
    return 1 << max(0, n - 1).bit_length()


def corrected(images: DataFrame, shape: tuple[int, int, int], levels: tuple[int, ...] = (1, 2, 4), rounds: int = 12, close: float = 1e-3, side: int = bricks.SIDE) -> DataFrame:
    """Images (scan_id, x, y, z, value) with ``field`` (the logarithm, 0 on average over a scan's positive voxels) and ``value`` divided by its exponential.

    levels: spans of the spline along each axis, coarse to fine.  A level ends
    when no scan's control points move by more than ``close`` on average, or
    after ``rounds``.  Voxels that are not positive take no part and stay.
    """
    spark, kind = images.sparkSession, f"scan_id {images.schema['scan_id'].dataType.simpleString()}"
    logs = images.where("value > 0").select("scan_id", "x", "y", "z", F.log("value").alias("value"))
    ends = logs.groupBy("scan_id").agg(F.min("value").alias("low"), F.max("value").alias("high"))
    held = bucketed(bricks.boxes(logs, shape, 0, side, float("nan")).join(ends, "scan_id"), "logarithms", "scan_id")
    sizes = [(s + 3) ** 3 for s in levels]
    width = sum(sizes)
    state = written(ends.select("scan_id", F.array_repeat(F.lit(0.0), width).alias("control"), F.lit(1.0).alias("far")), "fields")

    def axes(corner, spans):
        return [basis(n, spans, np.arange(c, c + side)) * (np.arange(c, c + side) < n)[:, None] for n, c in zip(shape, corner, strict=True)]

    def rest(box, corner, control):
        for k, spans in enumerate(levels):
            part = control[sum(sizes[:k]) : sum(sizes[: k + 1])]
            if part.any():
                box = box - field_of(part.reshape((spans + 3,) * 3), axes(corner, spans))
        return box

    def rows(batch, *lists):
        column = lambda c: batch.column(batch.schema.get_field_index(c))
        corner = np.stack([column(b).to_numpy() for b in bricks.BRICK], axis=1) * side
        box = bricks.matrix_of(column("box"), side**3).reshape(-1, side, side, side)
        given = [bricks.matrix_of(column(c), len(column(c)[0])) for c in lists] if batch.num_rows else []
        low, high = column("low").to_numpy(), column("high").to_numpy()
        for r, scan in enumerate(column("scan_id").to_pylist()):
            yield scan, box[r], corner[r], low[r], high[r], *(g[r] for g in given)

    def summed(each, size):
        """Sums of ``each`` row's numbers by scan, in the task and then over all."""

        def run(batches):
            total: dict = {}
            for whole in batches:
                for batch in bricks.sliced(whole, bricks.CELLS // side**3):
                    for scan, numbers in each(batch):
                        total[scan] = total.get(scan, 0) + numbers
                    if len(total) > 256:
                        yield out(total)
                        total = {}
            if total:  # a batch without scans would have no type
                yield out(total)

        def out(total):
            return pa.RecordBatch.from_arrays([pa.array(list(total)), bricks.lists_of(np.array(list(total.values())).reshape(-1, size))], names=["scan_id", "sums"])

        def gathered(batches):
            now, total = None, None
            for batch in batches:
                sums = bricks.matrix_of(batch.column(1), size)
                for r, scan in enumerate(batch.column(0).to_pylist()):
                    if now != (scan,):
                        if now is not None:
                            yield out({now[0]: total})
                        now, total = (scan,), np.zeros(size)
                    total = total + sums[r]
            if now is not None:
                yield out({now[0]: total})

        return lambda df: df.mapInArrow(run, f"{kind}, sums array<double>").repartition("scan_id").sortWithinPartitions("scan_id").mapInArrow(gathered, f"{kind}, sums array<double>")

    def histogram(batch):
        for scan, box, corner, low, high, control in rows(batch, "control"):
            v = rest(box, corner, control)
            place = np.clip((v[np.isfinite(v)] - low) / max(high - low, 1e-300), 0, 1) * (BINS - 1)
            base = np.minimum(place.astype(int), BINS - 2)
            yield scan, np.bincount(base, 1 - (place - base), BINS) + np.bincount(base + 1, place - base, BINS)

    for k, spans in enumerate(levels):
        state = state.withColumn("far", F.lit(1.0))
        at, size = sum(sizes[:k]), sizes[k]

        def fitted(batch, spans=spans):
            for scan, box, corner, low, high, control, h in rows(batch, "control", "h"):
                v = rest(box, corner, control)
                wanted = np.interp(v, np.linspace(low, high, BINS), sharpened(h, low, high))
                yield scan, control_sums(v - wanted, axes(corner, spans)).ravel()

        def moved(batches, at=at, size=size):
            for batch in batches:
                if batch.num_rows:
                    control, sums = bricks.matrix_of(batch.column(1), width).copy(), bricks.matrix_of(batch.column(2), 2 * size)
                    step = sums[:, :size] / np.where(sums[:, size:] > 0, sums[:, size:], 1)
                    control[:, at : at + size] += step
                    yield pa.RecordBatch.from_arrays([batch.column(0), bricks.lists_of(control), pa.array(np.abs(step).mean(axis=1))], names=["scan_id", "control", "far"])

        for _ in range(rounds):
            h = written(summed(histogram, BINS)(held.join(state, "scan_id")).withColumnRenamed("sums", "h"), "histograms")
            sums = summed(fitted, 2 * size)(held.join(state.join(h, "scan_id"), "scan_id"))
            state = written(state.join(sums, "scan_id").select("scan_id", "control", "sums").mapInArrow(moved, f"{kind}, control array<double>, far double"), "fields")
            if not state.where(F.col("far") > close).head(1):
                break

    def laid_out(batches):
        for whole in batches:
            for batch in bricks.sliced(whole, bricks.CELLS // side**3):
                for scan, box, corner, _, _, control in rows(batch, "control"):
                    at = np.nonzero(np.isfinite(box))
                    found = (box - rest(box, corner, control))[at]
                    yield pa.RecordBatch.from_arrays([pa.array([scan] * len(found)), *(pa.array((a + c).astype(np.int32)) for a, c in zip(at, corner, strict=True)), pa.array(found)], names=["scan_id", "x", "y", "z", "field"])

    fields = written(held.join(state, "scan_id").mapInArrow(laid_out, f"{kind}, x int, y int, z int, field double"), "fields")
    dropped(held)
    means = fields.groupBy("scan_id").agg(F.avg("field").alias("mean"))
    out = images.select("scan_id", "x", "y", "z", "value").join(fields, ["scan_id", "x", "y", "z"], "left").join(means, "scan_id", "left")
    field = F.coalesce(F.col("field") - F.col("mean"), F.lit(0.0))
    return out.select("scan_id", "x", "y", "z", (F.col("value") / F.exp(field)).alias("value"), field.alias("field"))
