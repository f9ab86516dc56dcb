"""Parallelism for CPU-heavy per-row stages.

Decoding text or binary messages costs far more per row than reading it.
When an input arrives in far fewer splits than the cluster has cores (one
large unsplittable file, a small landed batch), the caller may deal its rows
over more tasks first. It is the caller's choice: nothing is moved unless a
number of partitions is given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame, partitions: int | None = None) -> DataFrame:
    return df.repartition(partitions) if partitions else df
