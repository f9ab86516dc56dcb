"""Helpers shared by the text operators: table access, Arrow batches, scratch.

Conventions every operator here follows:

* it selects the columns it needs and names its own outputs, so extra columns
  of the input, whatever their names, are never looked at;
* a NULL text counts as an empty text, a NULL ``doc_id`` stays NULL;
* repeated rows (same id, same text) give repeated results;
* an empty table gives an empty result with the same schema.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keelson.session import shared_dir

#: Text bytes handled at once inside a task. A longer text is a batch alone.
SLICE_BYTES = 16 << 20

#: ASCII white space: the separators of ``[^\x20\x09-\x0D]+``.
SPACE_BYTES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_text(docs: DataFrame, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """Only the id (as long) and the text (NULL as empty)."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder name below the session's shared checkpoint folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


#: Rows of an Arrow batch while a table is written for the operators.
BATCH_ROWS = 1000
_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def persisted(df: DataFrame, name: str, batch_rows: int = BATCH_ROWS,
              narrow: int = 1) -> DataFrame:
    """Write to the shared folder and read back: computed once, no lineage.

    ``narrow``: the last stage gets one task for so many shuffle partitions.

    Python stages of the write get batches of at most ``batch_rows`` rows, so
    rows that carry whole texts do not pile up in a task's memory.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    if narrow > 1:
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        df = df.coalesce(max(1, parts // narrow))
    before = spark.conf.get(_ROWS)
    spark.conf.set(_ROWS, str(min(batch_rows, int(before)) if int(before) > 0 else batch_rows))
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_ROWS, before)
    return spark.read.schema(df.schema).parquet(path)


def slices(batches: Iterator[pa.RecordBatch], text: str = "text",
           most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each holds about ``most`` bytes of text."""
    for batch in batches:
        if not batch.num_rows:
            continue
        offsets, _ = text_bytes(batch.column(text))
        sizes = offsets - offsets[0]
        start = 0
        while start < batch.num_rows:
            end = int(np.searchsorted(sizes, sizes[start] + most, side="right")) - 1
            end = min(max(end, start + 1), batch.num_rows)
            yield batch.slice(start, end - start)
            start = end


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of a string column without NULLs, without a copy."""
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    kind = np.int64 if wide else np.int32
    _, off, data = column.buffers()
    n = len(column)
    offsets = np.frombuffer(off, kind)[column.offset:column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return offsets, raw


def int_lists(values: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """A list<int32> column from flat values and the length of each row."""
    offsets = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int32()))


def filled(batches: Iterator[pa.RecordBatch], text: str
           ) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """(slice, its texts with NULL as empty)."""
    for b in batches:
        done = 0
        column = pc.fill_null(b.column(text), "")
        for part in slices([pa.RecordBatch.from_arrays([column], names=["t"])], "t"):
            yield b.slice(done, part.num_rows), part.column(0)
            done += part.num_rows


def free_name(columns: list[str], name: str) -> str:
    """``name``, lengthened until no column has it."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name
