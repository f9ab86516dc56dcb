"""Late older changes never win, also after a restart."""

import uuid

import pytest
from pyspark.sql import functions as F

from keelson.sinks.partitioned import RangeTarget
from keelson.streaming.keyed import newest
from keelson.streaming.replicate import run_available

FEED = "_seq long, _sub int, _op string, id long, name string"


def land(spark, path, *rows):
    spark.createDataFrame(list(rows), FEED).coalesce(1).write.mode("append").parquet(path)


def test_late_changes_and_restart(spark, tmp):
    base = spark.range(4).select("id", F.concat(F.lit("n"), "id").alias("name"))
    t = RangeTarget.create(f"t_{uuid.uuid4().hex}", base, ["id"], 2, f"{tmp}/t")

    def drain():
        feed = spark.readStream.schema(FEED).option("maxFilesPerTrigger", 1).parquet(f"{tmp}/f")
        run_available(newest(feed, ["id"]), t, ["id"], checkpoint=f"{tmp}/c", output_mode="update")
        return {r.id: r.name for r in t.current().collect()}

    land(spark, f"{tmp}/f", (10, 0, "U", 0, "new"), (11, 0, "D", 1, None), (12, 0, "U", 2, "a"),
         (12, 1, "U", 2, "b"))
    assert drain() == {0: "new", 2: "b", 3: "n3"}
    # another run on the same checkpoint: older, equal and newer changes
    land(spark, f"{tmp}/f", (5, 0, "U", 0, "old"), (6, 0, "U", 1, "back"), (12, 0, "U", 2, "a"),
         (12, 1, "U", 2, "b"), (3, 0, "U", 3, "first"), (None, 0, "U", 3, "nowhere"))
    assert drain() == {0: "new", 2: "b", 3: "first"}
    land(spark, f"{tmp}/f", (13, 0, "I", 1, "again"), (12, 2, "D", 2, None))
    assert drain() == {0: "new", 1: "again", 3: "first"}


def test_partial_images_are_refused(spark, tmp):
    land(spark, f"{tmp}/f", (1, 0, "U", 0, "x"))
    feed = spark.readStream.schema(FEED + ", _unchanged array<string>").parquet(f"{tmp}/f")
    with pytest.raises(ValueError, match="keeps positions"):
        newest(feed, ["id"])
