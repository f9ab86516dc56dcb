"""Continuous replication with Structured Streaming.

    feed (readStream) -> foreachBatch(clean -> net change -> target) -> progress

* T1: ``replicate`` starts one streaming query per replicated table.
* T2: buffered flush - ``trigger={'processingTime': '120 seconds'}`` plus a
  size bound on the source (``maxBytesPerTrigger``/``maxFilesPerTrigger``);
  ``{'availableNow': True}`` drains what has landed and stops.
* T3: direct flush - ``direct=True`` uses the default trigger, so what arrives
  is applied at once; it cannot be combined with a trigger.
* T4: staged logs - the file target's per-batch log directories.
* T5: resume - the checkpoint holds source offsets, and the stream's own name
  (``run_name``). A restarted query replays at most the last batch, whose
  write is idempotent per stream and batch. A fresh checkpoint, also one that
  was emptied and used anew, is another stream: its batches have names of
  their own and are applied by position like all others.
* T6: snapshot once - ``seed`` writes generation 0 only if the ledger has
  no snapshot.
* T7: source identity - each batch's ``system_id`` must equal the one
  recorded first.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators.route import check_source_identity
from functools import reduce

from ..operators.rows import (conform, require, required_condition,
                              required_fields)
from ..session import scratch_path

DEFAULT_TRIGGER = {"processingTime": "120 seconds"}  # fixed value: upload interval


def prepare_batch(batch: DataFrame, schema: StructType, keys: Sequence[str],
                  required_mode: str = "all", cast_mode: str = "strict",
                  rejects_path: str | None = None, batch_id: int | None = None
                  ) -> DataFrame:
    """Cast to the target schema, then drop rows missing required fields.
    Deletes only need their key.

    ``cast_mode='try'``: text that does not cast becomes a reject instead
    of failing the batch; with ``rejects_path`` the raw rows are kept in
    ``<rejects_path>/batch_id=N`` (overwritten on replay)."""
    from pyspark.sql import functions as F
    if cast_mode == "try" and rejects_path is not None:
        _rejected_rows(batch, schema).write.mode("overwrite").parquet(f"{rejects_path}/batch_id={batch_id}")
    rows = conform(batch, schema, mode=cast_mode)
    if cast_mode == "try":
        rows = rows.where(~F.col("_rejected")).drop("_rejected")
    req = required_fields(schema, keys)
    if "_op" in rows.columns:
        # One filter: a delete needs its key, anything else the required
        # fields (one scan of the batch, not one per branch).
        keys_set = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]) \
            if keys else F.lit(True)
        rest_ok = required_condition(rows, req, required_mode, unchanged_ok=True)
        is_del = F.col("_op") == "D"
        return rows.where((is_del & keys_set) | (~is_del & rest_ok))
    return require(rows, req, required_mode, unchanged_ok=True)


def _rejected_rows(batch: DataFrame, schema: StructType) -> DataFrame:
    """Raw rows with a non-NULL value that does not cast to its column."""
    from pyspark.sql import functions as F
    bad = F.lit(False)
    for f in schema.fields:
        if f.name in batch.columns:
            c = F.col(f.name)
            bad = bad | (c.isNotNull() & c.try_cast(f.dataType).isNull())
    return batch.where(bad)


RUN_FILE = "keelson-run"


def run_name(spark: SparkSession, checkpoint: str) -> str:
    """The name of the stream that ``checkpoint`` belongs to: made on first use
    and kept inside the folder, so it goes when the folder's offsets go."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(checkpoint, RUN_FILE)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(path):
        stored = fs.open(path)
        try:
            return stored.readUTF()
        finally:
            stored.close()
    name = uuid.uuid4().hex[:16]
    out = fs.create(path, False)
    out.writeUTF(name)
    out.close()
    return name


def replicate(feed: DataFrame, target, keys: Sequence[str],
              schema: StructType | None = None, checkpoint: str | None = None,
              trigger: dict | None = None, direct: bool = False,
              required_mode: str = "all", cast_mode: str = "strict",
              transform: Callable[[DataFrame, int], DataFrame] | None = None,
              query_name: str | None = None,
              compact_every: int | None = None,
              rejects_path: str | None = None,
              output_mode: str = "append") -> StreamingQuery:
    """Start replicating a streaming change feed into ``target``.

    ``transform(batch, batch_id)`` runs first on each micro-batch (e.g.
    message decode).
    ``checkpoint`` defaults to a fresh folder under the session's shared
    checkpoint directory; pass the same one to resume. ``compact_every``
    folds the staged logs into a new base generation every N batches, so
    reading the current table never has to merge an unbounded log.
    """
    spark = feed.sparkSession
    schema = schema or getattr(target, "schema", None)
    if direct and trigger is not None:
        raise ValueError("a direct stream applies what arrives at once: give no trigger")
    checkpoint = checkpoint or scratch_path(spark, "streams")
    run = run_name(spark, checkpoint)

    def apply_batch(batch: DataFrame, batch_id: int) -> None:
        # A transform reads the batch more than once (relations, rows):
        # keep it for the duration of this batch only. A lost cached block
        # is recomputed from the source files.
        if transform is not None:
            batch = batch.persist()
        try:
            # Identity is checked on the raw batch: cheap, and before any
            # decoding work is spent on a feed from the wrong system.
            sys_id = None
            if "system_id" in batch.columns:
                expected = getattr(target, "state", lambda: {})().get("system_id")
                sys_id = check_source_identity(batch, expected)
            rows = transform(batch, batch_id) if transform else batch
            if schema is not None:
                rows = prepare_batch(rows, schema, keys, required_mode, cast_mode,
                                     rejects_path, batch_id)
            target.write_batch(rows, batch_id, system_id=sys_id, run=run)
        finally:
            if transform is not None:
                batch.unpersist()
        due = compact_every and (batch_id + 1) % compact_every == 0
        if due and hasattr(target, "compact"):
            target.compact()

    writer = (feed.writeStream.outputMode(output_mode).foreachBatch(apply_batch)
              .option("checkpointLocation", checkpoint))
    trig = {} if direct else (DEFAULT_TRIGGER if trigger is None else trigger)
    if trig:
        writer = writer.trigger(**trig)
    if query_name:
        writer = writer.queryName(query_name)
    return writer.start()


def run_available(feed: DataFrame, target, keys: Sequence[str], **kwargs
                  ) -> StreamingQuery:
    """Drain everything that has landed, then stop (``availableNow``; with
    ``direct=True`` batch after batch as they come)."""
    if kwargs.get("direct"):
        q = replicate(feed, target, keys, **kwargs)
        try:
            q.processAllAvailable()
        finally:
            q.stop()
        return q
    q = replicate(feed, target, keys, trigger={"availableNow": True}, **kwargs)
    q.awaitTermination()
    if q.exception():
        raise RuntimeError(str(q.exception()))
    return q
