"""Batches and streams that come again: nothing twice, nothing lost."""

import os
import shutil

import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

from keelson.sinks.target import CsvTarget, FileTarget
from keelson.streaming.replicate import replicate, run_available, run_name

ROW = StructType([StructField("id", LongType(), False), StructField("name", StringType())])
FEED = "_seq long, _op string, id long, name string"


def changes(spark, *rows):
    return spark.createDataFrame(list(rows), FEED)


def target(spark, path):
    t = FileTarget(spark, path, ["id"], ROW)
    t.seed(spark.createDataFrame([(1, "a"), (2, "b")], ROW))
    return t


def stream(spark, path):
    return spark.readStream.schema(FEED).option("maxFilesPerTrigger", 1).parquet(path)


def test_emptied_checkpoint_is_another_stream(spark, tmp):
    t, ckpt = target(spark, tmp + "/t"), tmp + "/ckpt"
    changes(spark, (1, "U", 1, "x")).write.parquet(tmp + "/one")
    run_available(stream(spark, tmp + "/one"), t, ["id"], checkpoint=ckpt)
    first = run_name(spark, ckpt)
    shutil.rmtree(ckpt)
    changes(spark, (2, "I", 3, "c")).write.parquet(tmp + "/two")
    run_available(stream(spark, tmp + "/two"), t, ["id"], checkpoint=ckpt)
    assert run_name(spark, ckpt) != first
    assert sorted(map(tuple, t.current().collect())) == [(1, "x"), (2, "b"), (3, "c")]


def test_run_name_outlives_a_restart(spark, tmp):
    ckpt = tmp + "/ckpt"
    assert run_name(spark, ckpt) == run_name(spark, ckpt + "/")


def test_another_batch_of_the_same_name_fails(spark, tmp):
    t = target(spark, tmp + "/t")
    t.write_batch(changes(spark, (1, "U", 1, "x")), 0)
    t.write_batch(changes(spark, (1, "U", 1, "x")), 0)  # a replay
    for other in ((2, "I", 3, "c"), (1, "U", 2, "x"), (1, "D", 1, None)):
        with pytest.raises(ValueError, match="committed with other changes"):
            t.write_batch(changes(spark, other), 0)
    assert sorted(map(tuple, t.current().collect())) == [(1, "x"), (2, "b")]


def test_text_batch_is_there_once(spark, tmp):
    t = CsvTarget(spark, tmp + "/csv")
    t.write_batch(changes(spark, (1, "I", 1, "a")), 0)
    t.write_batch(changes(spark, (2, "I", 2, "b")), 1)
    t.write_batch(changes(spark, (1, "I", 1, "a")), 0)
    t.write_batch(changes(spark, (1, "I", 1, "a")), 0, run="other")
    schema = StructType([StructField("_seq", LongType()), StructField("_op", StringType()),
                         StructField("id", LongType()), StructField("name", StringType())])
    assert sorted(r._seq for r in t.read(schema).collect()) == [1, 1, 2]


def test_direct_takes_no_trigger_and_one_file_a_batch(spark, tmp):
    for k in range(3):
        changes(spark, (k + 1, "U", 1, f"v{k}")).coalesce(1).write.mode("append").parquet(tmp + "/f")
    t = target(spark, tmp + "/t")
    with pytest.raises(ValueError, match="no trigger"):
        replicate(stream(spark, tmp + "/f"), t, ["id"], direct=True, trigger={"availableNow": True})
    run_available(stream(spark, tmp + "/f"), t, ["id"], checkpoint=os.path.join(tmp, "c"), direct=True)
    assert len(t.staged_batches()) == 3
    assert sorted(map(tuple, t.current().collect())) == [(1, "v2"), (2, "b")]


def test_buffered_flush_cuts_by_bytes(spark, tmp):
    """The cap is below the feed's size: several batches, none above the cap by
    more than a file."""
    for k in range(6):
        changes(spark, *[(100 * k + i, "U", 1, f"v{i}" * 9) for i in range(100)]).coalesce(1) \
            .write.mode("append").parquet(tmp + "/f")
    sizes = [os.path.getsize(os.path.join(tmp, "f", x)) for x in os.listdir(tmp + "/f")
             if x.endswith(".parquet")]
    feed = (spark.readStream.schema(FEED).option("maxBytesPerTrigger", 2 * max(sizes) + 1)
            .parquet(tmp + "/f"))
    t = target(spark, tmp + "/t")
    run_available(feed, t, ["id"], checkpoint=tmp + "/c")
    assert len(t.staged_batches()) == 3
