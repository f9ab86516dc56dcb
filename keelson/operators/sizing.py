"""Computing a join side once, in a form whose size the planner can see.

The change side of a replication join is small per batch, the target is
huge. Broadcasting the change side means the target is streamed, never
shuffled - but only a side of a known size may be broadcast. So the change
side is written as Parquet in the shared folder and read back: the planner
then knows its bytes and broadcasts it up to
``spark.sql.autoBroadcastJoinThreshold``; beyond that the same join is a
shuffled join on the key. Nothing here counts rows or hints.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..session import scratch_path


def materialize(df: DataFrame) -> DataFrame:
    """Compute once into the shared folder (lineage cut, known size)."""
    spark = df.sparkSession
    path = scratch_path(spark, "staged")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fits_broadcast(df: DataFrame) -> bool:
    """Whether the planner's size of a staged table is within the session's
    broadcast threshold."""
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return limit >= 0 and int(str(size)) <= limit
