"""Change-frame contract and net change per key (O1).

A change frame has ``_seq bigint`` (capture position), optionally
``_sub int`` (order inside one position, used when one captured message
becomes two rows), optionally ``_lsn bigint``, ``_op`` in I/U/D, then the
target columns. Feed order is ``(_seq, _sub)``; arrival order and file order
never matter.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SEQ, SUB, LSN, OP = "_seq", "_sub", "_lsn", "_op"
META = (SEQ, SUB, LSN, OP)
INSERT, UPDATE, DELETE = "I", "U", "D"


def order_columns(df: DataFrame) -> list[str]:
    return [c for c in (SEQ, SUB) if c in df.columns]


def data_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in META]


def latest_first(df: DataFrame) -> list[Column]:
    return [F.col(c).desc() for c in order_columns(df)]


def net_changes(changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The last change per key in feed order.

    ``row_number() = 1`` over ``partitionBy(keys)`` is planned with a
    partial ``WindowGroupLimit`` ahead of the shuffle: each map task keeps
    one row per key before anything moves, so a key that holds a third of
    the feed sends at most one row per input split to its reducer.
    """
    keys = list(keys)
    if not keys:
        raise ValueError("net_changes needs at least one key column")
    w = Window.partitionBy(*keys).orderBy(*latest_first(changes))
    return (changes.withColumn("_rn", F.row_number().over(w))
            .where(F.col("_rn") == 1).drop("_rn"))


def tombstones(changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key-only delete rows (F7): keys kept, every other data column NULL."""
    keys = set(keys)
    cols = []
    for f in changes.schema.fields:
        if f.name in META or f.name in keys:
            cols.append(F.col(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return changes.where(F.col(OP) == DELETE).select(*cols)
