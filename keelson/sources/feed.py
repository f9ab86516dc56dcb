"""Change-feed readers.

A landed feed is a directory of files (parquet by default) holding change
rows or captured messages. The batch reader and the streaming reader take
the same explicit schema - a stream cannot infer one, and a batch job
should not.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.changes import SEQ


def read_feed(spark: SparkSession, path: str, schema: StructType,
              fmt: str = "parquet", after: int | None = None) -> DataFrame:
    """All landed changes, optionally only those after a position (S10);
    the position filter is pushed into the scan."""
    df = spark.read.format(fmt).schema(schema).load(path)
    if after is not None:
        df = df.where(F.col(SEQ) > F.lit(after))
    return df


def stream_feed(spark: SparkSession, path: str, schema: StructType,
                fmt: str = "parquet", max_files: int | None = None,
                max_bytes: str | None = None) -> DataFrame:
    """The feed as a stream (S3). ``max_files`` / ``max_bytes`` bound one
    micro-batch (T2's size flush; the byte bound is a soft cap)."""
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader.load(path)
