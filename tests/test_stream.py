"""Streaming replication: drain a landed feed, resume on the same
checkpoint after a stop, and survive a batch that fails after its write."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import (DoubleType, LongType, StringType, StructField,
                               StructType)

from keelson.operators.apply import apply_changes
from keelson.plans import feeds
from keelson.sinks.target import FileTarget
from keelson.streaming.replicate import replicate, run_available

SMOKE = "/root/testdata/sf0.001"
SCHEMA = StructType([StructField("id", LongType(), False),
                     StructField("name", StringType(), True),
                     StructField("salary", DoubleType(), True)])
FEED = StructType([StructField("_seq", LongType()), StructField("_sub", LongType()),
                   StructField("_op", StringType()), StructField("id", LongType()),
                   StructField("name", StringType()), StructField("salary", DoubleType())])


def expected(spark):
    ch = feeds.employee_changes(spark, SMOKE)
    return sorted(map(tuple, apply_changes(feeds.employee_base(spark, SMOKE), ch,
                                           ["id"]).collect()))


def land(spark, path, where, name):
    ch = feeds.employee_changes(spark, SMOKE).where(where)
    ch.write.parquet(os.path.join(path, name))


def stream(spark, path):
    return (spark.readStream.schema(FEED).option("maxFilesPerTrigger", 1)
            .option("recursiveFileLookup", "true").parquet(path))


def target(spark, tmp):
    t = FileTarget(spark, os.path.join(tmp, "target"), ["id"], SCHEMA)
    t.seed(feeds.employee_base(spark, SMOKE))
    return t


def test_drain_and_resume(spark, tmp):
    feed, ckpt = os.path.join(tmp, "feed"), os.path.join(tmp, "ckpt")
    t = target(spark, tmp)
    land(spark, feed, F.col("_seq") < 400, "a")
    run_available(stream(spark, feed), t, ["id"], checkpoint=ckpt)
    first = t.staged_batches()
    land(spark, feed, F.col("_seq") >= 400, "b")
    # a new driver object, as after a restart
    t2 = FileTarget(spark, t.path, ["id"], SCHEMA)
    run_available(stream(spark, feed), t2, ["id"], checkpoint=ckpt)
    assert len(t2.staged_batches()) > len(first) > 0
    assert len({run for run, _ in t2.staged_batches()}) == 1
    assert sorted(map(tuple, t2.current().collect())) == expected(spark)


def test_snapshot_once(spark, tmp):
    t = target(spark, tmp)
    assert t.seed(feeds.employee_base(spark, SMOKE)) is False


def test_failed_batch_is_retried_once(spark, tmp):
    """The sink fails after writing batch 0; the restarted query replays
    batch 0 and the result still counts every change once."""
    feed, ckpt = os.path.join(tmp, "feed"), os.path.join(tmp, "ckpt")
    land(spark, feed, F.lit(True), "all")
    t = target(spark, tmp)

    class Flaky:
        schema = SCHEMA

        def __init__(self, inner):
            self.inner, self.failed = inner, False

        def state(self):
            return self.inner.state()

        def write_batch(self, df, batch_id, system_id=None, run="direct"):
            self.inner.write_batch(df, batch_id, system_id, run)
            if not self.failed:
                self.failed = True
                raise RuntimeError("executor lost after the write")

    flaky = Flaky(t)
    with pytest.raises(Exception):
        run_available(stream(spark, feed), flaky, ["id"], checkpoint=ckpt)
    run_available(stream(spark, feed), flaky, ["id"], checkpoint=ckpt)
    assert sorted(map(tuple, t.current().collect())) == expected(spark)


def test_source_identity_guard(spark, tmp):
    feed, ckpt = os.path.join(tmp, "feed"), os.path.join(tmp, "ckpt")
    t = target(spark, tmp)
    msgs = feeds.employee_changes(spark, SMOKE).withColumn("system_id", F.lit("A"))
    msgs.write.parquet(os.path.join(feed, "a"))
    schema = StructType(FEED.fields + [StructField("system_id", StringType())])
    s = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(feed)
    run_available(s, t, ["id"], checkpoint=ckpt)
    assert t.state()["system_id"] == "A"
    msgs.withColumn("system_id", F.lit("B")).write.parquet(os.path.join(feed, "b"))
    with pytest.raises(Exception):
        run_available(s, t, ["id"], checkpoint=ckpt)


def test_processing_time_trigger_starts(spark, tmp):
    feed = os.path.join(tmp, "feed")
    land(spark, feed, F.lit(True), "all")
    t = target(spark, tmp)
    q = replicate(stream(spark, feed), t, ["id"], trigger={"processingTime": "1 second"})
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert sorted(map(tuple, t.current().collect())) == expected(spark)


def test_periodic_compaction(spark, tmp):
    feed, ckpt = os.path.join(tmp, "feed"), os.path.join(tmp, "ckpt")
    for i, lo in enumerate(range(0, 1000, 250)):
        land(spark, feed, (F.col("_seq") >= lo) & (F.col("_seq") < lo + 250), f"p{i}")
    t = target(spark, tmp)
    run_available(stream(spark, feed), t, ["id"], checkpoint=ckpt, compact_every=2)
    assert t.state()["gen"] >= 1
    assert sorted(map(tuple, t.current().collect())) == expected(spark)


def test_hard_kill_and_resume(spark, tmp):
    """SIGKILL the driver process mid-stream; a new driver resumes from the
    same checkpoint and target and the result counts every change once."""
    import signal
    import subprocess
    import sys
    import time

    feed, ckpt = os.path.join(tmp, "feed"), os.path.join(tmp, "ckpt")
    tpath = os.path.join(tmp, "target")
    for i, lo in enumerate(range(0, 1000, 100)):
        land(spark, feed, (F.col("_seq") >= lo) & (F.col("_seq") < lo + 100), f"p{i:02d}")
    here = os.path.dirname(os.path.abspath(__file__))
    env = dict(os.environ, PYTHONPATH=here)
    child = subprocess.Popen(
        [sys.executable, os.path.join(here, "helpers", "stream_child.py"),
         feed, tpath, ckpt, os.path.join(tmp, "child-ckdir")],
        env=env, stdout=subprocess.DEVNULL, stderr=subprocess.DEVNULL,
        start_new_session=True)
    try:
        deadline = time.time() + 240
        logs = os.path.join(tpath, "log")
        while time.time() < deadline:
            done = [d for r in os.listdir(logs) for d in os.listdir(os.path.join(logs, r))] \
                if os.path.isdir(logs) else []
            if len(done) >= 3:
                break
            if child.poll() is not None:
                break
            time.sleep(0.2)
        assert child.poll() is None, "child finished before it could be killed"
        os.killpg(child.pid, signal.SIGKILL)
        child.wait(30)
    finally:
        if child.poll() is None:
            os.killpg(child.pid, signal.SIGKILL)
    t = FileTarget(spark, tpath, ["id"], SCHEMA)
    assert t.state()["snapshot_done"]
    run_available(stream(spark, feed), t, ["id"], checkpoint=ckpt)
    assert sorted(map(tuple, t.current().collect())) == expected(spark)
    assert [b for _, b in t.staged_batches()] == list(range(10))


def test_csv_stream_sink_exactly_once(spark, tmp):
    from keelson.sinks.target import CsvTarget
    feed, ckpt = os.path.join(tmp, "feed"), os.path.join(tmp, "ckpt")
    land(spark, feed, F.col("_seq") < 500, "a")
    sink = CsvTarget(spark, os.path.join(tmp, "csv"))
    cols = stream(spark, feed).select("_seq", "_op", "id", "name")
    q = sink.stream_sink(cols, ckpt).trigger(availableNow=True).start()
    q.awaitTermination()
    land(spark, feed, F.col("_seq") >= 500, "b")
    q = sink.stream_sink(cols, ckpt).trigger(availableNow=True).start()
    q.awaitTermination()
    back = sink.read(StructType([StructField("_seq", LongType()), StructField("_op", StringType()),
                                 StructField("id", LongType()), StructField("name", StringType())]))
    assert back.count() == 1000 and back.select("_seq").distinct().count() == 1000


def test_rejects_table(spark, tmp):
    feed, ckpt = os.path.join(tmp, "feed"), os.path.join(tmp, "ckpt")
    text = StructType([StructField("_seq", LongType()), StructField("_op", StringType()),
                       StructField("id", StringType()), StructField("name", StringType()),
                       StructField("salary", StringType())])
    rows = [(1, "I", "1", "a", "1.5"), (2, "I", "x2", "b", "2.0"),
            (3, "I", "3", "c", "oops"), (4, "U", "1", "d", "4")]
    spark.createDataFrame(rows, text).write.parquet(os.path.join(feed, "a"))
    t = FileTarget(spark, os.path.join(tmp, "target"), ["id"], SCHEMA)
    t.seed(spark.createDataFrame([], SCHEMA))
    s = spark.readStream.schema(text).option("recursiveFileLookup", "true").parquet(feed)
    rej = os.path.join(tmp, "rejects")
    run_available(s, t, ["id"], checkpoint=ckpt, cast_mode="try", rejects_path=rej)
    assert sorted(map(tuple, t.current().collect())) == [(1, "d", 4.0)]
    assert sorted(r._seq for r in spark.read.parquet(rej).collect()) == [2, 3]


def test_snapshot_position_then_full_replay(spark, tmp):
    """Snapshot taken at position 500 (its rows carry that position), then
    the feed replayed from the start: changes the snapshot already holds
    lose to it, and the result equals one pass over the whole feed."""
    ch = feeds.employee_changes(spark, SMOKE)
    snap = apply_changes(feeds.employee_base(spark, SMOKE), ch.where("_seq <= 500"), ["id"])
    t = FileTarget(spark, os.path.join(tmp, "target"), ["id"], SCHEMA)
    t.seed(snap, snapshot_seq=500)
    t.write_batch(ch, 0)
    assert sorted(map(tuple, t.current().collect())) == expected(spark)
