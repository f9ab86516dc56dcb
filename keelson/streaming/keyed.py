"""Keyed state across micro-batches (O1, T1): late older changes.

A target that keeps positions (``FileTarget``) sorts late changes out when it
is read. A plain table cannot, so its stream does: ``newest`` keeps the last
change of each key, deletes included, in the state of a streaming aggregate.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.changes import SEQ, SUB
from ..operators.unchanged import UNCHANGED


def newest(feed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A streaming change feed as, batch by batch, the newest change so far of
    each key that the batch names. A late older change brings the newer one
    again, which changes nothing; equal positions are one change.

    Run it with ``output_mode="update"``. It is one built-in aggregate with a
    partial aggregation before the shuffle, so a hot key moves one row a task.
    State: one change for each key, for good. Rows without a position are
    dropped. A feed whose changes leave columns out is refused: a late change
    may hold the only value of a column.
    """
    if UNCHANGED in feed.columns:
        raise ValueError("changes that leave columns unchanged need a target that keeps positions")
    sub = [F.coalesce(F.col(SUB), F.lit(0))] if SUB in feed.columns else []
    order = F.struct(F.col(SEQ), *sub)
    rest = [c for c in feed.columns if c not in keys]
    last = feed.where(F.col(SEQ).isNotNull()).groupBy(*keys).agg(
        F.max_by(F.struct(*rest), order).alias("_last"))
    return last.select(*[F.col(c) if c in keys else F.col(f"_last.{c}") for c in feed.columns])
