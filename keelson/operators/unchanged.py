"""Net change with unchanged values.

A change may leave some columns out (sent as "unchanged": large values the
source did not re-send). Unchanged is not NULL: the column keeps its last
known value. Per key and column, the value is set by the latest change
that either deletes the row or sends the column:

* latest such change is a delete -> NULL (a later insert without the
  column cannot know it);
* it sends the column -> that value;
* there is none -> the base table's value.

The key survives when its last change is not a delete. All of this is one
grouped aggregate (``max_by`` over the feed order, with a partial
aggregation before the shuffle), so a key with a huge number of changes
is reduced map-side like any other.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from functools import reduce

from .asof import carry_forward
from .changes import DELETE, OP, SEQ, order_columns
from .sizing import materialize

UNCHANGED = "_unchanged"
MOVED_FROM = "_from"


def _order(changes: DataFrame) -> Column:
    return F.struct(*[F.col(c) for c in order_columns(changes)])


def net_with_unchanged(changes: DataFrame, keys: Sequence[str],
                       columns: Sequence[str], with_seq: bool = False
                       ) -> DataFrame:
    """One row per key: ``_last_op`` and, per column, ``_set_<c>`` =
    struct(deleted, v) of the change that last set it (NULL if none).
    ``with_seq`` adds ``_last_seq`` and the setting change's ``seq``."""
    order = _order(changes)
    is_del = F.col(OP) == DELETE
    aggs = [F.max_by(F.col(OP), order).alias("_last_op")]
    if with_seq:
        aggs.append(F.max(F.col(SEQ)).alias("_last_seq"))
    for c in columns:
        touch = is_del | ~F.coalesce(F.array_contains(F.col(UNCHANGED), F.lit(c)),
                                     F.lit(False))
        fields = [is_del.alias("deleted"), F.col(c).alias("v")]
        if with_seq:
            fields.append(F.col(SEQ).alias("seq"))
        val = F.struct(*fields)
        aggs.append(F.max_by(F.when(touch, val), F.when(touch, order))
                    .alias(f"_set_{c}"))
    return changes.groupBy(*keys).agg(*aggs)


def apply_with_unchanged(base: DataFrame, changes: DataFrame,
                         keys: Sequence[str], once: bool = True) -> DataFrame:
    """Apply changes that may leave columns unchanged.

    ``once`` stages the per-key result as Parquet, so an expensive input
    (decoded messages) is computed a single time and the planner knows its
    size: small, it is broadcast and the target is streamed past it twice
    (rows to drop, and base values for columns never sent); otherwise the
    same joins shuffle on the key. Rows whose key moved (``_from``) are
    completed first, see ``fill_moved``.
    """
    keys = list(keys)
    cols = [c for c in base.columns if c not in keys]
    net = net_with_unchanged(fill_moved(base, changes, keys), keys, cols)
    if once:
        net = materialize(net)
    live = net.where(F.col("_last_op") != DELETE)
    kept = base.join(net.select(*keys), keys, "left_anti")

    def fill(has_base: bool) -> list:
        out = []
        for c in cols:
            sent = (F.when(F.col(f"n._set_{c}.deleted"), F.lit(None))
                    .otherwise(F.col(f"n._set_{c}.v")))
            base_val = F.col(f"b.{c}") if has_base else F.lit(None)
            out.append(F.when(F.col(f"n._set_{c}").isNull(), base_val)
                       .otherwise(sent).alias(c))
        return out

    nk = [F.col(f"n.{k}").alias(k) for k in keys]
    match = reduce(lambda a, b: a & b,
                   [F.col(f"b.{k}") == F.col(f"n.{k}") for k in keys])
    hit = base.alias("b").join(live.alias("n"), match, "inner")
    with_base = hit.select(*nk, *fill(True))
    without = live.join(hit.select(*nk).distinct(), keys, "left_anti").alias("n").select(
        *nk, *fill(False))
    return kept.unionByName(with_base.unionByName(without).select(*base.columns))


def fill_moved(base: DataFrame | Callable[[DataFrame], DataFrame], changes: DataFrame,
               keys: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """Complete rows whose key moved and that left columns unchanged.

    ``_from`` (struct of the keys) names the row an insert was moved from. A
    column it did not send has the value which that row had just before: set
    by the newest earlier change of the old key, else the base value. That
    change may itself be a move that left the column out. So:

    1. the newest change of the old key that says something about the column
       is carried forward to the move (``asof``: linear in the changes of a
       key) - a value, a delete, or another waiting move;
    2. pointers from move to move are doubled until each ends at a value, a
       delete or the base: rounds grow with the logarithm of the longest
       chain, and a round reads only the pointers that are still open;
    3. the values are fetched where the pointers end.

    The changes are staged once, before anything is asked of them. ``base`` may
    be a function from a frame of keys to the base rows of these keys (with
    ``columns``, those of the base): only pointers that end at the base are
    looked up then, and without any the base is not read.
    """
    if MOVED_FROM not in changes.columns:
        return changes
    keys = list(keys)
    cols = [c for c in (base.columns if columns is None else columns) if c not in keys]
    rest = [c for c in changes.columns if c != MOVED_FROM]
    cur = materialize(changes)
    if not cols or cur.where(_waits()).isEmpty():
        return cur.select(*rest)
    ends = resolve_pointers(move_pointers(cur, keys, cols))
    ids = order_columns(cur)
    event = cur.select(*[F.col(c).alias(f"_end{c}") for c in ids],
                       *[F.col(c).alias(f"_e_{c}") for c in cols])
    fetched = ends.join(event, [f"_end{c}" for c in ids], "left")
    if callable(base):
        asked = materialize(ends.where(F.col("_base").isNotNull()).select("_base.*").distinct())
        base = None if asked.isEmpty() else base(asked)
    if base is not None:
        old = base.select(F.struct(*keys).alias("_base"),
                          *[F.col(c).alias(f"_b_{c}") for c in cols])
        fetched = fetched.join(old, "_base", "left")
    value = {c: F.when(F.col("_end" + SEQ).isNotNull(), F.col(f"_e_{c}")).otherwise(
        F.lit(None) if base is None else F.col(f"_b_{c}")) for c in cols}
    values = fetched.groupBy(*[F.col(f"_node{c}").alias(c) for c in ids]).agg(*[
        F.first(F.when(F.col("_column") == c, value[c]), ignorenulls=True).alias(f"_v_{c}")
        for c in cols])
    joined = cur.join(values, ids, "left")
    none = F.array().cast("array<string>")
    return joined.withColumns({
        **{c: F.when(_waits() & F.array_contains(UNCHANGED, c), F.col(f"_v_{c}"))
           .otherwise(F.col(c)) for c in cols},
        UNCHANGED: F.when(_waits(), none).otherwise(F.col(UNCHANGED))}).select(*rest)


def _waits() -> Column:
    """A moved row that leaves a column out."""
    return F.coalesce(F.col(MOVED_FROM).isNotNull() & (F.size(UNCHANGED) > 0), F.lit(False))


def move_pointers(cur: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """For each waiting move and each column it leaves out, where the value is:
    ``_node*`` (the move's position), ``_column``, and one of ``_to*`` (another
    waiting move), ``_end*`` (a change that sent it) or ``_base`` (the key of a
    base row); none of them if the row was deleted."""
    ids = order_columns(cur)
    spot = F.struct(*ids)
    probes = cur.where(_waits()).select(
        *[F.col(f"{MOVED_FROM}.{k}").alias(k) for k in keys],
        *[F.col(c).alias(f"_node{c}") for c in ids], UNCHANGED,
        *[(F.col(c) if c == SEQ else F.lit(-1).cast(cur.schema[c].dataType)).alias(c)
          for c in ids])
    deleted = F.col(OP) == DELETE
    said = {c: F.when(deleted, F.struct(F.lit("gone").alias("kind"), spot.alias("spot")))
            .when(~F.coalesce(F.array_contains(UNCHANGED, c), F.lit(False)),
                  F.struct(F.lit("sent").alias("kind"), spot.alias("spot")))
            .when(_waits(), F.struct(F.lit("moved").alias("kind"), spot.alias("spot")))
            .alias(f"_said_{c}") for c in cols}
    heard = cur.join(probes.select(*keys).distinct(), list(keys), "left_semi").select(
        *keys, *ids, *said.values())
    names = [f"_said_{c}" for c in cols]
    known = carry_forward(probes, heard, keys, ids, names, inclusive=False)

    def pointer(c: str) -> Column:
        last = F.col(f"_said_{c}")
        return F.when(F.array_contains(UNCHANGED, c), F.struct(
            F.lit(c).alias("_column"),
            *[F.when(last["kind"] == "moved", last["spot"][i]).alias(f"_to{i}") for i in ids],
            *[F.when(last["kind"] == "sent", last["spot"][i]).alias(f"_end{i}") for i in ids],
            F.when(last.isNull(), F.struct(*keys)).alias("_base")))

    return known.select(*[f"_node{c}" for c in ids], F.inline(F.array_compact(
        F.array(*[pointer(c) for c in cols])))).dropDuplicates(
        [*[f"_node{c}" for c in ids], "_column"])


def resolve_pointers(pointers: DataFrame, on_round=None) -> DataFrame:
    """Double the ``_to*`` pointers until none is left. ``on_round`` is called
    with the number of each round."""
    to = [c for c in pointers.columns if c.startswith("_to")]
    ids = [c.removeprefix("_to") for c in to]
    rest = [c for c in pointers.columns if not c.startswith(("_node", "_to")) and c != "_column"]
    open_ = F.col("_to" + SEQ).isNotNull()
    done, rounds = [], 0
    live = materialize(pointers)
    every = live
    while True:
        done.append(live.where(~open_))
        going = live.where(open_)
        if going.isEmpty():
            return reduce(DataFrame.unionByName, done)
        rounds += 1
        if on_round:
            on_round(rounds)
        far = every.select("_column", *[F.col(f"_node{i}").alias(f"_to{i}") for i in ids],
                           *[F.col(c).alias(f"_far{c}") for c in (*to, *rest)])
        doubled = materialize(going.drop(*rest).join(far, ["_column", *to]).select(
            *[f"_node{i}" for i in ids], "_column",
            *[F.col(f"_far{c}").alias(c) for c in (*to, *rest)]))
        # nodes settled in earlier rounds are still pointed at
        every = reduce(DataFrame.unionByName, [*done, doubled])
        live = doubled
