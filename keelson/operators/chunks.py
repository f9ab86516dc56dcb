"""A snapshot taken in chunks while the feed goes on.

Each chunk holds the rows of a key range, read at some moment between two feed
positions that were noted before (``_low``) and after (``_high``) its read. The
rows become changes of the feed at ``_high``, so snapshot and changes reach the
target as one feed, in any cut: nothing has to stop, and a chunk may be read
again. A row whose key changed between the two positions is left out - nobody
knows on which side of the change it was read, and the change itself is in the
feed. A row whose key did not change then is right at ``_high``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .asof import carry_forward
from .changes import INSERT, OP, SEQ, SUB

LOW, HIGH = "_low", "_high"
#: A chunk's rows come before the changes at their position.
BEFORE = -1


def standing_rows(chunks: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of ``chunks`` (columns, ``_low``, ``_high``) whose key has no
    change at a position above ``_low`` and up to ``_high``.

    The newest change of the key up to ``_high`` is carried forward to the row
    (``asof``), so a key with many changes costs their number only.
    """
    seen = changes.select(*keys, F.col(SEQ).alias(HIGH), F.col(SEQ).alias("_changed"))
    found = carry_forward(chunks, seen, list(keys), [HIGH], ["_changed"])
    return found.where(F.col("_changed").isNull() | (F.col("_changed") <= F.col(LOW))).drop("_changed")


def interleave(chunks: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One change feed of the chunks' rows and the changes.

    ``changes``: the feed from the first chunk's ``_low`` on at the latest, full
    images. Applied in feed order to an empty target, or one that has an
    earlier part of it, the result is the source's state.
    """
    sub = F.col(SUB).cast("int") if SUB in changes.columns else F.lit(0)
    data = [c for c in chunks.columns if c not in (LOW, HIGH)]
    rows = standing_rows(chunks, changes, keys).select(
        F.col(HIGH).alias(SEQ), F.lit(BEFORE).alias(SUB), F.lit(INSERT).alias(OP), *data)
    return changes.select(SEQ, sub.alias(SUB), OP, *data).unionByName(rows)
