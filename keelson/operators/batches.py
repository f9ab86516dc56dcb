"""Size-bounded batching of a change feed (O5) and per-batch summary.

Two rules. ``plan_batches``: a row belongs to batch
``floor((running_bytes - row_bytes) / cap)``, the batch in which its first byte
falls; a batch holds at most ``cap`` plus one row. ``fill_segments``: the
sequential fill, a segment rolls *before* a row that would take it past the
cap; only a row larger than the cap makes a segment larger than it.

Both start from a distributed prefix sum, not one global window:

1. deal the rows into ranges of the feed order (Spark's range exchange, as many
   ranges as the session's partitions and the sizes ask for) and stage them
   with their range number - the size expression is evaluated once;
2. sum bytes per range (partial aggregation; one row per range);
3. prefix-sum those totals - a table of one row for each range;
4. a running sum inside each range (a window partitioned by range).

Where a segment of the sequential fill starts depends on where the one before
it started, a fold over the whole feed. It is cut at fixed byte offsets
(``GRID`` caps apart) into ranges: inside a range each possible first start
leads, by binary search on the prefix sums, to a first start in the next range.
These pointers - one for each row within a cap of a range's beginning - are
doubled to reach the true starts from the first row in logarithmically many
rounds; then each range is filled from its true start on its own.

Pass a narrow frame (position columns and the size): it is what moves.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .changes import SEQ, order_columns
from .sizing import materialize

SEGMENT_BYTES = 10 * 1024 * 1024  # fixed value: the reference's segment cap
SEGMENT_HEADER = 4096  # fixed value: a segment's header counts towards the cap
#: Caps of bytes in a range of the sequential fill.
GRID = 4


def range_buckets(changes: DataFrame, buckets: int | None = None) -> DataFrame:
    """Add ``_bucket``: the number of the range of feed order that holds the
    row, ranges of about equal row counts. Staged."""
    order = order_columns(changes) or [SEQ]
    ranged = changes.repartitionByRange(buckets, *order) if buckets else \
        changes.repartitionByRange(*order)
    return materialize(ranged.withColumn("_bucket", F.spark_partition_id()))


def running_bytes(changes: DataFrame, size_col: str, buckets: int | None = None) -> DataFrame:
    """Add ``_running``: the bytes of the feed through this row."""
    order = order_columns(changes) or [SEQ]
    b = range_buckets(changes, buckets)
    totals = b.groupBy("_bucket").agg(F.sum(size_col).alias("_bucket_bytes"))
    offsets = totals.select(
        "_bucket",
        (F.sum("_bucket_bytes").over(Window.orderBy("_bucket")) -
         F.col("_bucket_bytes")).alias("_offset"))
    w = (Window.partitionBy("_bucket").orderBy(*order)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    run = F.col("_offset") + F.sum(size_col).over(w)
    return b.join(offsets, "_bucket").withColumn("_running", run).drop("_bucket", "_offset")


def plan_batches(changes: DataFrame, size_col: str, cap: int = SEGMENT_BYTES,
                 buckets: int | None = None) -> DataFrame:
    """Add ``_running`` (bytes through this row) and ``_batch`` to each row.

    ``buckets``: number of position ranges; each range's running sum is one
    task."""
    return running_bytes(changes, size_col, buckets).withColumn(
        "_batch", F.floor((F.col("_running") - F.col(size_col)) / F.lit(cap)).cast("bigint"))


def fill_segments(changes: DataFrame, size_col: str, cap: int = SEGMENT_BYTES,
                  header: int = 0, grid: int = GRID, buckets: int | None = None,
                  on_round=None) -> DataFrame:
    """Add ``_running`` and ``_batch``, the segment of the sequential fill.

    A segment rolls before the row that would take ``header`` plus its rows
    past ``cap``; a first row always goes in. Sizes are positive (a row has its
    line end at least; a zero or NULL size fails). ``grid``: caps of bytes in a
    range. ``on_round`` is called with the number of each doubling round.
    """
    room = cap - header
    if room <= 0:
        raise ValueError("the header leaves no room below the cap")
    order = order_columns(changes) or [SEQ]
    size = F.col(size_col)
    sized = changes.withColumn(size_col, F.when(size > 0, size).otherwise(F.raise_error(
        F.lit("a row of a segment needs a positive size")).cast("bigint")))
    run = running_bytes(sized, size_col, buckets).withColumn(
        "_begin", F.col("_running") - size)
    run = materialize(run.withColumn("_range", F.floor(F.col("_begin") / (grid * room))))
    ranges = run.groupBy("_range").agg(F.min("_begin").alias("_first"))
    ranges = materialize(ranges.withColumn("_former", F.lag("_range").over(
        Window.orderBy("_range"))))
    # Starts are told apart by their byte offset. A range also sees the rows
    # that may be the first start of the next one.
    ahead = run.join(ranges, "_range").where(
        F.col("_former").isNotNull() & (F.col("_begin") <= F.col("_first") + room))
    own = run.join(ranges, "_range").select(
        "_range", "_begin", "_running", "_first", F.lit(True).alias("own"))
    seen = own.unionByName(ahead.select(F.col("_former").alias("_range"), "_begin", "_running",
                                        F.lit(None).cast("bigint").alias("_first"),
                                        F.lit(False).alias("own")))
    steps = seen.groupBy("_range").applyInArrow(_pointers(room), "node bigint, to bigint")
    true = reach(materialize(steps), on_round)
    starts = run.join(ranges, "_range").join(
        true.withColumnRenamed("node", "_begin").withColumn("_entry", F.lit(True)),
        "_begin", "left").groupBy("_range").applyInArrow(
        _starts(room), "_range bigint, _begin bigint")
    starts = materialize(starts)
    before = starts.groupBy("_range").agg(F.count(F.lit(1)).alias("n"))
    before = ranges.select("_range").join(before, "_range", "left").select(
        "_range", (F.coalesce(F.sum("n").over(Window.orderBy("_range").rowsBetween(
            Window.unboundedPreceding, -1)), F.lit(0))).alias("_before"))
    marked = run.join(starts.select("_begin", F.lit(1).alias("_start")), "_begin", "left")
    so_far = F.count("_start").over(Window.partitionBy("_range").orderBy("_begin"))
    out = marked.join(before, "_range").withColumn(
        "_batch", (F.col("_before") + so_far - 1).cast("bigint"))
    return out.select(*changes.columns, "_running", "_batch")


def _hops(begin: np.ndarray, running: np.ndarray, room: int) -> np.ndarray:
    """For each row, the index of the row that starts the next segment if it
    starts one (past the end: none seen)."""
    hop = np.searchsorted(running, begin + room, side="right")
    return np.maximum(hop, np.arange(len(begin)) + 1)


def _pointers(room: int):
    """From each row that may be a range's first start to the next range's."""
    schema = pa.schema([("node", pa.int64()), ("to", pa.int64())])

    def work(rows: pa.Table) -> pa.Table:
        begin = rows.column("_begin").to_numpy()
        order = np.argsort(begin, kind="stable")
        begin = begin[order]
        running = rows.column("_running").to_numpy()[order]
        own = int(rows.column("own").to_numpy(zero_copy_only=False).sum())
        hop = _hops(begin, running, room)
        # hops double until every row's leads out of the range's own rows
        out = np.append(hop, len(begin))
        while (inside := out[:own] < own).any():
            out[:own][inside] = out[out[:own][inside]]
        node = np.flatnonzero(begin[:own] <= begin[0] + room)
        to = out[node]
        node, to = node[to < len(begin)], to[to < len(begin)]
        return pa.Table.from_arrays([pa.array(begin[node]), pa.array(begin[to])], schema=schema)
    return work


def _starts(room: int):
    """The starts of a range's segments, from its true first start on."""
    schema = pa.schema([("_range", pa.int64()), ("_begin", pa.int64())])

    def work(rows: pa.Table) -> pa.Table:
        begin = rows.column("_begin").to_numpy()
        order = np.argsort(begin, kind="stable")
        begin = begin[order]
        hop = _hops(begin, rows.column("_running").to_numpy()[order], room)
        entry = rows.column("_entry").is_valid().to_numpy(zero_copy_only=False)[order]
        found, at = [], int(entry.argmax()) if entry.any() else len(begin)
        while at < len(begin):
            found.append(at)
            at = int(hop[at])
        return pa.Table.from_arrays([
            pa.array(np.full(len(found), rows.column("_range")[0].as_py()), pa.int64()),
            pa.array(begin[found] if found else [], pa.int64())], schema=schema)
    return work


def reach(steps: DataFrame, on_round=None) -> DataFrame:
    """The nodes on the way from node 0, ``steps`` being (node, to), by
    doubling: after round r the first 2**r nodes of the way are known."""
    spark = steps.sparkSession
    known = spark.createDataFrame([(0,)], "node bigint")
    rounds, jump = 0, steps
    while True:
        new = known.join(jump, "node").select(F.col("to").alias("node"))
        grown = materialize(known.unionByName(new).distinct())
        if grown.count() == known.count():
            return grown
        rounds += 1
        if on_round:
            on_round(rounds)
        known = grown
        far = jump.select(F.col("node").alias("to"), F.col("to").alias("_far"))
        jump = materialize(jump.join(far, "to").select("node", F.col("_far").alias("to")))


def batch_summary(planned: DataFrame, size_col: str) -> DataFrame:
    """One row per batch: rows, bytes, first and last position."""
    return planned.groupBy("_batch").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(size_col).alias("n_bytes"),
        F.min(SEQ).alias("first_seq"),
        F.max(SEQ).alias("last_seq"))
