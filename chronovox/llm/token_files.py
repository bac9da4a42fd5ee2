"""Token ids in Arrow files of fixed-size lists.

Ids of all documents, in ascending order of id, run on through rows of
``row`` ids each: a file's batches hold a fixed-size list of ids, a
fixed-size list of bytes whose bits are the mask (lowest first; 0 where the
file's last row is padded) and, per row, the documents that begin in it.
Fixed-size lists have no offsets, so row r of a memory-mapped file is a slice
of one buffer, ids and mask alike (``sequence``).

Files are cut at documents' ends and written through Spark's own writer, so
they reach any store that Spark can write.  The text writer puts a
separator after a row; here it is the last six bytes of the Arrow file
format, which complete the file.

Defined cases: a null text is the empty text, with the end id alone; null ids
sort first; rows with equal ids keep some order among themselves; a text may
be of any length, as a file ends with the document that fills it; an empty
table gives no rows.
"""

from __future__ import annotations

import functools
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import bpe, common

#: Fixed value: how an Arrow file ends.
MAGIC = b"ARROW1"
#: Rows of a batch, and ids of a file; a file ends with the first document that reaches them.
ROWS_PER_BATCH, IDS_PER_FILE = 4096, 16_000_000


def file_bytes(documents: list[tuple[int | None, np.ndarray]], row: int, place: tuple[int, int]) -> bytes:
    """One Arrow file with these documents' ids; ``place`` (partition, number) orders the files."""
    ids = np.concatenate([x for _, x in documents])
    kind = ids.dtype
    rows = max(1, -(-len(ids) // row))
    padded = np.zeros(rows * row, kind)
    padded[: len(ids)] = ids
    mask = np.packbits((np.arange(rows * row) < len(ids)).reshape(rows, row), axis=1, bitorder="little")
    one = pa.struct([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64())])
    starts = np.concatenate([[0], np.cumsum([len(x) for _, x in documents])[:-1]]).astype(np.int64)
    begin = np.concatenate([[0], np.cumsum(np.bincount(starts // row, minlength=rows))]).astype(np.int32)
    items = pa.StructArray.from_arrays([pa.array([d for d, _ in documents], pa.int64()), pa.array(starts), pa.array([len(x) for _, x in documents], pa.int64())], fields=list(one))
    columns = [
        pa.FixedSizeListArray.from_arrays(pa.array(padded), row),
        pa.FixedSizeListArray.from_arrays(pa.array(mask.ravel()), mask.shape[1]),
        pa.ListArray.from_arrays(pa.array(begin), items),
    ]
    schema = pa.schema([("ids", columns[0].type), ("mask", columns[1].type), ("documents", columns[2].type)], metadata={"partition": str(place[0]), "number": str(place[1]), "ids": str(len(ids))})
    sink = pa.BufferOutputStream()
    with pa.ipc.new_file(sink, schema) as out:
        out.write_table(pa.Table.from_arrays(columns, schema=schema), max_chunksize=ROWS_PER_BATCH)
    return sink.getvalue().to_pybytes()


def write(docs: DataFrame, folder: str, tokenizer: str, row: int = 2048, end_id: int = 2) -> None:
    """Encode every document and write the files to ``folder``."""
    common.text_session(docs.sparkSession)

    def run(batches):
        coder, task, number, held, size = bpe.loaded_library(tokenizer), TaskContext.get().partitionId(), 0, [], 0
        end = np.array([end_id], coder.kind)
        done = lambda: pa.RecordBatch.from_arrays([pa.array([file_bytes(held, row, (task, number)).removesuffix(MAGIC)], pa.binary())], names=["file"])
        for batch in batches:
            for doc, text in zip(common.column(batch, "doc_id").to_pylist(), common.texts(batch)):
                held.append((doc, np.concatenate([coder.packed(text), end])))
                size += len(held[-1][1])
                if size >= IDS_PER_FILE:
                    yield done()
                    number, held, size = number + 1, [], 0
        if held:
            yield done()

    source = docs.select(F.col("doc_id").cast("long"), F.col("text"))
    ordered = source.repartitionByRange(common.scan_partitions(source), "doc_id").sortWithinPartitions("doc_id")
    files = ordered.mapInArrow(run, "file binary").select(F.col("file").cast("string"))
    files.write.option("lineSep", MAGIC.decode()).option("maxRecordsPerFile", 1).text(folder)


def opened(raw: bytes) -> tuple[dict[str, int], list[pa.RecordBatch]]:
    """A file's numbers and batches; the batches are views of ``raw``."""
    reader = pa.ipc.open_file(pa.py_buffer(raw))
    meta = {k.decode(): int(v) for k, v in reader.schema.metadata.items()}
    return meta, [reader.get_batch(i) for i in range(reader.num_record_batches)]


def rows_of(batch: pa.RecordBatch, name: str) -> np.ndarray:
    """A fixed-size list column as a matrix: a view, not a copy."""
    lists = batch.column(batch.schema.get_field_index(name))
    return lists.flatten().to_numpy(zero_copy_only=True).reshape(len(lists), -1)


def sequence(source: pa.NativeFile | pa.Buffer, r: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and mask of row r of a file, for instance a memory-mapped one: views of its bytes; np.unpackbits(mask, bitorder="little") spreads the bits."""
    batch = pa.ipc.open_file(source).get_batch(r // ROWS_PER_BATCH)
    return rows_of(batch, "ids")[r % ROWS_PER_BATCH], rows_of(batch, "mask")[r % ROWS_PER_BATCH]


def read_sequences(spark: SparkSession, folder: str) -> DataFrame:
    """The files' rows: partition, number, row, ids, mask."""

    def run(batches):
        for batch in batches:
            for raw in common.column(batch, "content").to_pylist():
                meta, parts = opened(raw)
                at = 0
                for part in parts:
                    n = len(part)
                    ids = part.column(0)
                    bits = np.unpackbits(rows_of(part, "mask"), axis=1, count=ids.type.list_size, bitorder="little")
                    mask = pa.FixedSizeListArray.from_arrays(pa.array(bits.ravel().astype(bool)), ids.type.list_size)
                    yield pa.RecordBatch.from_arrays([pa.array([meta["partition"]] * n, pa.int32()), pa.array([meta["number"]] * n, pa.int32()), pa.array(range(at, at + n), pa.int64()), ids.cast(pa.list_(pa.int32())), mask.cast(pa.list_(pa.bool_()))], names=["partition", "number", "row", "ids", "mask"])
                    at += n

    return _files(spark, folder).mapInArrow(run, "partition int, number int, row long, ids array<int>, mask array<boolean>")


def _files(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.format("binaryFile").load(folder).select("content")


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids_crc32, from the files."""

    def run(batches):
        for batch in batches:
            for raw in common.column(batch, "content").to_pylist():
                meta, parts = opened(raw)
                ids = [rows_of(part, "ids").ravel() for part in parts]
                ids = (ids[0] if len(ids) == 1 else np.concatenate(ids))[: meta["ids"]]
                if sum(int(np.bitwise_count(rows_of(part, "mask")).sum()) for part in parts) != meta["ids"]:
                    raise ValueError("mask and ids differ")
                found = [x for part in parts for x in common.column(part, "documents").flatten().to_pylist()]
                crc = [zlib.crc32(ids[x["start"] : x["start"] + x["length"]].astype("<u4").tobytes()) for x in found]
                n = len(found)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([meta["partition"]] * n, pa.int32()), pa.array([meta["number"]] * n, pa.int32()), *(pa.array([x[k] for x in found], pa.int64()) for k in ("doc_id", "start", "length")), pa.array(crc, pa.int64())],
                    names=["partition", "number", "doc_id", "start", "length", "crc"],
                )

    found = common.written(_files(spark, folder).mapInArrow(run, "partition int, number int, doc_id long, start long, length long, crc long"), "token-index")
    # One row per file; the running sum is over files, not over documents.
    files = found.groupBy("partition", "number").agg(F.sum("length").alias("ids"))
    before = F.coalesce(F.sum("ids").over(Window.orderBy("partition", "number").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return found.join(files.select("partition", "number", before.alias("before")), ["partition", "number"]).select("doc_id", (F.col("start") + F.col("before")).alias("start"), F.col("length").alias("n_tokens"), F.col("crc").alias("ids_crc32"))


@functools.cache
def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
