"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..sources.shared import dropped, shared_dir, written  # noqa: F401  for the operators

#: Rows per Arrow batch for whole-text columns. Texts may be long, so a batch holds fewer rows than Spark's default.
TEXT_ROWS_PER_BATCH = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_session(spark: SparkSession) -> SparkSession:
    """Keep Arrow batches of whole texts to few rows, unless the session already asks for fewer.

    The setting stays, as results are lazy and their plans read it when they
    run.  Bytes are bounded besides by Spark's own
    spark.sql.execution.arrow.maxBytesPerBatch, whose default is left alone.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key, "10000")) <= TEXT_ROWS_PER_BATCH:
        spark.conf.set(key, str(TEXT_ROWS_PER_BATCH))
    return spark


def scan_partitions(df: DataFrame) -> int:
    """Partitions of the plan as it stands; follows the input's size for a file scan."""
    return max(1, df.rdd.getNumPartitions())


def wider(schema: T.StructType, **columns: str) -> T.StructType:
    """``schema`` with further columns, each given by its simple type."""
    kinds = {"int": T.IntegerType(), "long": T.LongType(), "binary": T.BinaryType(), "string": T.StringType()}
    return T.StructType([*schema.fields, *(T.StructField(name, kinds[kind]) for name, kind in columns.items())])


def power_of_two(n: int) -> int:
    return 1 << max(0, int(n) - 1).bit_length()


def texts(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """A string column as Python strings, null as the empty string."""
    return [x if x is not None else "" for x in batch.column(batch.schema.get_field_index(name)).to_pylist()]


def text_bytes(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """A string column as UTF-8 bytes, null as empty."""
    column = batch.column(batch.schema.get_field_index(name))
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    return [x if x is not None else b"" for x in column.cast(pa.large_binary() if wide else pa.binary()).to_pylist()]


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def made(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], type=f.type) if not isinstance(columns[f.name], pa.Array) else columns[f.name].cast(f.type) for f in schema], schema=schema)


def doubling_hash(h: np.ndarray, salt: int) -> np.ndarray:
    """A second 64-bit hash from a first (multiply-xorshift)."""
    x = h ^ np.uint64(salt)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


Batches = Iterator[pa.RecordBatch]
