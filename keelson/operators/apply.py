"""Row-level table changes: upsert, delete, apply in order.

Every operator is an anti join plus a union - never a full outer join of
the target. The change side is reduced first (one row per key, or
distinct keys) and staged once in the shared folder, so the planner knows its
bytes (``sizing``) and broadcasts it up to the session's threshold: the target
is then streamed through a hash lookup and never shuffled. Beyond that the join
is a sort-merge join on the key, in place if the target is bucketed on it; a
hot key cannot reach it because the change side has one row per key.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .changes import DELETE, OP, net_changes
from .sizing import fits_broadcast, materialize


def _project(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(c) for c in columns])


def _once(df: DataFrame, enabled: bool) -> DataFrame:
    return materialize(df) if enabled else df


def upsert(base: DataFrame, rows: DataFrame, keys: Sequence[str] | None = None,
           once: bool = True) -> DataFrame:
    """Replace base rows whose key is in ``rows``; insert the rest.

    ``rows`` must hold one row per key (see ``rows.check_duplicates``).
    With no keys, every column is the key (J2, ``insert_if_absent``).
    ``once``: materialise ``rows`` so the size check, the join and the
    union read it once computed.
    """
    if not keys:
        return insert_if_absent(base, rows, once)
    keys = list(keys)
    cols = base.columns
    rows = _once(_project(rows, cols), once)
    kept = base.join(rows.select(*keys), keys, "left_anti")
    return kept.unionByName(rows)


def _null_safe(left: str, right: str, cols: Sequence[str]):
    return reduce(lambda a, b: a & b,
                  [F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}"))
                   for c in cols])


def fingerprint(cols: Sequence[str]) -> list[Column]:
    """128 bits of a row, NULLs told apart from values and from each other."""
    nulls = F.concat(*[F.when(F.col(c).isNull(), "1").otherwise("0") for c in cols])
    return [F.xxhash64(F.lit(seed), nulls, *[F.col(c) for c in cols]).alias(name)
            for seed, name in ((1, "_f1"), (2, "_f2"))]


def insert_if_absent(base: DataFrame, rows: DataFrame,
                     once: bool = True) -> DataFrame:
    """Key = all columns: append source rows that are not already there.

    NULL equals NULL here, as it does for a whole-row key. The source rows
    are made distinct first (partial aggregation: a group of identical
    copies collapses map-side). A source side that may be broadcast meets the
    target in one inner join, which never shuffles the target. A larger one is
    held against 128-bit fingerprints of the target's rows, which are all that
    moves of it; the few rows whose fingerprint is in both are then compared
    column by column.
    """
    cols = base.columns
    new = _once(_project(rows, cols).distinct(), once)
    if once and not fits_broadcast(new):
        return base.unionByName(_absent_by_fingerprint(base, new))
    present = (base.alias("b").join(new.alias("n"), _null_safe("n", "b", cols), "inner")
               .select(*[F.col(f"n.{c}").alias(c) for c in cols]).distinct())
    missing = new.alias("n").join(present.alias("p"), _null_safe("n", "p", cols), "left_anti")
    return base.unionByName(missing.select(*[F.col(f"n.{c}").alias(c) for c in cols]))


def _absent_by_fingerprint(base: DataFrame, new: DataFrame) -> DataFrame:
    cols, marks = base.columns, ["_f1", "_f2"]
    new = new.select(*cols, *fingerprint(cols))
    both = materialize(new.select(*marks).join(
        base.select(*fingerprint(cols)), marks, "left_semi").distinct())
    hit = base.select(*cols, *fingerprint(cols)).join(both, marks, "left_semi")
    same = reduce(lambda a, b: a & b, [F.col(f"n.{m}") == F.col(f"b.{m}") for m in marks])
    return new.alias("n").join(hit.alias("b"), same & _null_safe("n", "b", cols),
                               "left_anti").select(*cols)


def delete(base: DataFrame, rows: DataFrame, keys: Sequence[str],
           once: bool = True) -> DataFrame:
    """Remove base rows whose key appears in ``rows`` (J3, J4 composite).

    Equality is SQL equality: a NULL key matches nothing, as in a
    ``col = value`` filter.
    """
    keys = list(keys)
    keyset = _once(rows.select(*keys).distinct(), once)
    return base.join(keyset, keys, "left_anti")


def apply_changes(base: DataFrame, changes: DataFrame, keys: Sequence[str],
                  order: str = "feed", once: bool = True) -> DataFrame:
    """Bring ``base`` up to date with a change frame.

    ``order='feed'`` (O2): the state after applying every change in
    ``(_seq, _sub)`` order, so a key deleted and inserted again survives.
    ``order='append_then_delete'`` (O3): what one upload pass of the
    reference does - the last insert/update per key is upserted, then every
    key deleted anywhere in the batch is removed.

    The net change feeds the size check, the anti join and the union;
    ``once`` checkpoints it so the feed is read and reduced a single time.
    """
    keys = list(keys)
    cols = base.columns
    if order == "feed":
        last = _once(net_changes(changes, keys), once)
        kept = base.join(last.select(*keys), keys, "left_anti")
        return kept.unionByName(_project(last.where(F.col(OP) != DELETE), cols))
    if order == "append_then_delete":
        ups = net_changes(changes.where(F.col(OP) != DELETE), keys)
        merged = upsert(base, _project(ups, cols), keys, once)
        return delete(merged, changes.where(F.col(OP) == DELETE), keys,
                      once)
    raise ValueError(f"unknown order {order!r}")


def bootstrap(snapshot: DataFrame, changes: DataFrame, keys: Sequence[str],
              snapshot_seq: int | None = None, **kwargs) -> DataFrame:
    """Seed from a snapshot, then follow the feed.

    The snapshot was taken after the feed's slot was created, so changes
    from the slot position onwards may already be in it. Replaying them is
    harmless: each change carries the full row image, and the last one per
    key wins, which is the state the snapshot would reach anyway.
    ``snapshot_seq``, when given, drops feed rows at or before a position
    the snapshot is known to contain.
    """
    feed = changes
    if snapshot_seq is not None:
        feed = changes.where(F.col("_seq") > F.lit(snapshot_seq))
    return apply_changes(snapshot, feed, keys, order="feed", **kwargs)
