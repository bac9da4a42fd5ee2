"""BPE ids of whole documents, and their decoded texts, as DataFrames.

Defined cases: a null text is the empty text and has no ids; ids follow the
tokenizers library without added special tokens, but the special tokens'
own strings in a text are those tokens, as in the library.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bpe, common


def list_of(arrays: list[np.ndarray], kind: pa.DataType = pa.int32()) -> pa.ListArray:
    """Arrow lists over the arrays' numbers, without a Python object for each."""
    offsets = np.zeros(len(arrays) + 1, np.int64)
    np.cumsum([len(a) for a in arrays], out=offsets[1:])
    values = np.concatenate(arrays) if arrays else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values.astype(kind.to_pandas_dtype())))


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", decoded: bool = True) -> DataFrame:
    """id, ``ids`` (array of int) and, if asked for, ``decoded`` text, one row per document."""
    common.text_session(docs.sparkSession)

    def run(batches):
        coder = bpe.loaded(path)
        for batch in batches:
            # in small groups, so that a batch of long texts doesn't hold all its ids as Python objects
            ids, back = [], []
            for text in common.texts(batch, "text"):
                ids.append(coder.packed(text))
                if decoded:
                    back.append(coder.decode(ids[-1].tolist()))
            yield pa.RecordBatch.from_arrays([common.column(batch, "id"), list_of(ids), *([pa.array(back, pa.string())] if decoded else [])], names=["id", "ids", *(["decoded"] if decoded else [])])

    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(run, f"id {kind}, ids array<int>" + ", decoded string" * decoded).withColumnRenamed("id", id_col)
