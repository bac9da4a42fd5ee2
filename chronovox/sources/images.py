"""NIfTI images as tables, and tables as NIfTI images.

Files are read as binary rows by Spark, so any store that Spark reads will
do; a task parses whole files.  Headers alone are read from the first bytes
of a file where tasks can open it (paths of scheme file), and from its
content elsewhere, as Spark's readers give no part of a file.  The format is
the published NIfTI-1 layout.
"""

from __future__ import annotations

import gzip
import struct
import urllib.parse
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.options import stem

#: NIfTI-1 data types.
TYPES = {2: "u1", 4: "i2", 8: "i4", 16: "f4", 64: "f8", 256: "i1", 512: "u2", 768: "u4", 1024: "i8", 1280: "u8"}
CODES = {v: k for k, v in TYPES.items()}
HEADER = "path string, shape array<int>, spacing array<double>, origin array<double>, direction array<array<double>>, kind string, tr double"


def inflated(raw: bytes, most: int | None = None) -> bytes:
    if raw[:2] != b"\x1f\x8b":
        return raw if most is None else raw[:most]
    return zlib.decompressobj(31).decompress(raw, most or 0)


def header(raw: bytes) -> dict:
    """Shape, spacing, affine, type and place of the voxels."""
    order = "<" if struct.unpack("<i", raw[:4])[0] == 348 else ">"
    if struct.unpack(order + "i", raw[:4])[0] != 348:
        raise ValueError("not a NIfTI-1 image")
    dim = struct.unpack(order + "8h", raw[40:56])
    code = struct.unpack(order + "h", raw[70:72])[0]
    pix = struct.unpack(order + "8f", raw[76:108])
    offset, slope, inter = struct.unpack(order + "3f", raw[108:120])
    qform, sform = struct.unpack(order + "2h", raw[252:256])
    shape = [max(1, d) for d in dim[1 : dim[0] + 1]]
    spacing = [float(p) for p in pix[1 : dim[0] + 1]]
    if sform > 0:
        affine = np.array([struct.unpack(order + "4f", raw[280 + 16 * i : 296 + 16 * i]) for i in range(3)])
    elif qform > 0:
        b, c, d, x, y, z = struct.unpack(order + "6f", raw[256:280])
        a = np.sqrt(max(0.0, 1 - b * b - c * c - d * d))
        turn = np.array([[a * a + b * b - c * c - d * d, 2 * (b * c - a * d), 2 * (b * d + a * c)], [2 * (b * c + a * d), a * a + c * c - b * b - d * d, 2 * (c * d - a * b)], [2 * (b * d - a * c), 2 * (c * d + a * b), a * a + d * d - b * b - c * c]])
        scale = np.array([pix[1], pix[2], pix[3] * (-1 if pix[0] < 0 else 1)])
        affine = np.c_[turn * scale, [x, y, z]]
    else:
        affine = np.c_[np.diag(pix[1:4]), np.zeros(3)]
    size = np.sqrt((affine[:, :3] ** 2).sum(axis=0))
    direction = affine[:, :3] / np.where(size == 0, 1, size)
    return {"shape": shape, "spacing": spacing, "origin": affine[:, 3].tolist(), "direction": direction.tolist(), "kind": TYPES[code], "order": order, "offset": int(offset), "slope": slope, "inter": inter, "tr": spacing[3] if len(spacing) > 3 else None}


def voxels(raw: bytes) -> tuple[dict, np.ndarray]:
    """Header and array with axes x, y, z and, if there is one, t; in double precision."""
    raw = inflated(raw)
    h = header(raw)
    n = int(np.prod(h["shape"]))
    a = np.frombuffer(raw, h["order"] + h["kind"], n, h["offset"]).astype(float)
    if h["slope"] not in (0.0,) and np.isfinite(h["slope"]):
        a = a * h["slope"] + h["inter"]
    return h, a.reshape(h["shape"], order="F")


def encoded(array: np.ndarray, spacing=(1.0, 1.0, 1.0, 1.0), affine: np.ndarray | None = None, kind: str = "f4") -> bytes:
    """A gzipped NIfTI-1 file."""
    dim = [array.ndim, *array.shape, *[1] * (7 - array.ndim)]
    affine = np.diag([*spacing[:3], 1.0]) if affine is None else affine
    raw = bytearray(352)
    struct.pack_into("<i", raw, 0, 348)
    struct.pack_into("<8h", raw, 40, *dim)
    struct.pack_into("<2h", raw, 70, CODES[kind], np.dtype(kind).itemsize * 8)
    struct.pack_into("<8f", raw, 76, 1.0, *[*spacing, *[1.0] * 7][:7])
    struct.pack_into("<3f", raw, 108, 352.0, 1.0, 0.0)
    struct.pack_into("<2h", raw, 252, 0, 1)
    for i in range(3):
        struct.pack_into("<4f", raw, 280 + 16 * i, *affine[i])
    raw[344:348] = b"n+1\0"
    return gzip.compress(bytes(raw) + array.astype("<" + kind).tobytes(order="F"), mtime=0)


def _files(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)


def find(spark: SparkSession, folder: str) -> DataFrame:
    """Paths below a folder; contents are not read."""
    return _files(spark, folder).select("path", "length")


def _images(spark: SparkSession, folder: str) -> DataFrame:
    return _files(spark, folder).where(F.col("path").rlike(r"\.nii(\.gz)?$|/scan_id=[^/]+/part-[^/]+$"))


def scan_of(path: str):
    """The scan's name from its folder, if write() made it, or from the file's name."""
    return F.coalesce(F.nullif(F.regexp_extract(path, r"/scan_id=([^/]+)/", 1), F.lit("")), stem(path))


def headers(spark: SparkSession, folder: str) -> DataFrame:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    opened = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getUri().getScheme() == "file"

    def first_bytes(name):
        with open(urllib.parse.unquote(urllib.parse.urlparse(name).path), "rb") as file:
            return file.read(4096)

    def run(batches):
        for batch in batches:
            found = map(first_bytes, batch.column(0).to_pylist()) if opened else batch.column(1).to_pylist()
            rows = [header(inflated(raw, 352)) for raw in found]
            pick = lambda k: [r[k] for r in rows]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(pick("shape"), pa.list_(pa.int32())), pa.array(pick("spacing"), pa.list_(pa.float64())), pa.array(pick("origin"), pa.list_(pa.float64())), pa.array(pick("direction"), pa.list_(pa.list_(pa.float64()))), pa.array(pick("kind")), pa.array(pick("tr"), pa.float64())], names=["path", "shape", "spacing", "origin", "direction", "kind", "tr"])

    return _images(spark, folder).select("path", *([] if opened else ["content"])).mapInArrow(run, HEADER)


def read(spark: SparkSession, folder: str) -> DataFrame:
    """scan_id, t, voxel_id, x, y, z, value of every image; voxel_id counts with x fastest. A 3-D image has t 0."""

    def run(batches):
        for batch in batches:
            for scan, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                _, a = voxels(raw)
                a = a.reshape(a.shape[:3] + (-1,))
                ids = np.arange(a[..., 0].size)
                x, y, z = np.unravel_index(ids, a.shape[:3], order="F")
                for t in range(a.shape[3]):
                    n = len(ids)
                    yield pa.RecordBatch.from_arrays([pa.array([scan] * n), pa.array(np.full(n, t, np.int32)), pa.array(ids), *(pa.array(c.astype(np.int32)) for c in (x, y, z)), pa.array(a[..., t].ravel(order="F"))], names=["scan_id", "t", "voxel_id", "x", "y", "z", "value"])

    return _images(spark, folder).select(scan_of("path").alias("scan_id"), "content").mapInArrow(run, "scan_id string, t int, voxel_id long, x int, y int, z int, value double")


def affine_of(spacing, origin, direction) -> np.ndarray:
    """The matrix from a grid's indices to space."""
    return np.r_[np.c_[np.array(direction, float) * np.array(spacing[:3], float), np.array(origin, float)], [[0, 0, 0, 1]]]


def to_files(bold: DataFrame, spacing=(1.0, 1.0, 1.0, 1.0), shape: tuple[int, int, int] | None = None, affine: np.ndarray | None = None) -> DataFrame:
    """scan_id and content (a gzipped image) from rows with x, y, z, t and value; unset voxels are 0. A group is one scan.

    shape is that of the grid that the voxels belong to; without it, the grid
    ends at the greatest coordinates.  affine places the grid in space.
    """

    def one(pdf):
        import pandas as pd

        size = (*(shape or (int(pdf[c].max()) + 1 for c in "xyz")), int(pdf["t"].max()) + 1)
        a = np.zeros(size)
        a[pdf["x"], pdf["y"], pdf["z"], pdf["t"]] = pdf["value"]
        return pd.DataFrame({"scan_id": [pdf["scan_id"].iloc[0]], "content": [encoded(a if size[3] > 1 else a[..., 0], spacing, affine)]})

    return bold.select("scan_id", "x", "y", "z", "t", "value").groupBy("scan_id").applyInPandas(one, "scan_id string, content binary")


def write(bold: DataFrame, folder: str, spacing=(1.0, 1.0, 1.0, 1.0), shape: tuple[int, int, int] | None = None, affine: np.ndarray | None = None) -> None:
    """One image per scan, at scan_id=.../part-..., through Spark's writer; the line end after an image is not read."""
    to_files(bold, spacing, shape, affine).select("scan_id", F.col("content").cast("string")).write.partitionBy("scan_id").text(folder)
