"""Targets as plain catalog tables (K3, K4, J1, J3): no log, no format of our own.

``RangeTarget`` - a Parquet table partitioned by ranges of its key. A batch of
changes reads and writes only the partitions its keys fall into (dynamic
partition overwrite); the files of all others keep their names and times.

``bucketed_table`` - a table bucketed on its key. A change side too large to
broadcast is dealt into the same buckets and joined there; the table is not
moved.
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

from ..operators.apply import apply_changes
from ..operators.changes import META
from ..operators.sizing import materialize
from ..operators.unchanged import MOVED_FROM, UNCHANGED, apply_with_unchanged
from ..session import scratch_path

PART = "_part"
BOUNDS = "keelson.bounds"
KEYS = "keelson.keys"
PLACE = "keelson.location"
IDENTITY = "keelson.system_id"


def range_bounds(rows: DataFrame, key: str, parts: int) -> list:
    """Lower ends of up to ``parts - 1`` ranges of about equal row counts; at
    most that many values come to the driver."""
    ranged = rows.select(F.col(key).alias("k")).where("k is not null").repartitionByRange(parts, "k")
    least = ranged.groupBy(F.spark_partition_id()).agg(F.min("k").alias("k"))
    return [r[0] for r in least.orderBy("k").select("k").collect()][1:]


def range_number(key: Column, bounds: Sequence, kind: DataType) -> Column:
    """How many of the ascending ``bounds`` are at or below ``key``, by a
    balanced tree of comparisons. A NULL key is in range 0."""
    if not bounds:
        return F.lit(0)

    def pick(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(key >= F.lit(bounds[mid]).cast(kind), pick(mid + 1, hi)).otherwise(
            pick(lo, mid))
    return F.when(key.isNull(), F.lit(0)).otherwise(pick(0, len(bounds)))


class RangeTarget:
    """A catalog table kept current by overwriting touched key ranges."""

    def __init__(self, spark: SparkSession, name: str):
        if not spark.catalog.tableExists(name):
            raise ValueError(f"target table {name} does not exist")
        self.spark, self.name = spark, name
        found = self._properties()
        if BOUNDS not in found:
            raise ValueError(f"{name} is not partitioned by key ranges")
        self.keys = json.loads(found[KEYS])
        self.bounds = json.loads(found[BOUNDS])
        self.location = found[PLACE]
        whole = spark.table(name).schema
        self.schema = StructType([f for f in whole.fields if f.name != PART])
        self.columns = [f.name for f in self.schema.fields]

    @classmethod
    def create(cls, name: str, snapshot: DataFrame, keys: Sequence[str],
               parts: int = 200, location: str | None = None) -> RangeTarget:
        """The table, made from a snapshot: once (a table that exists fails).
        Ranges are of the first key column."""
        spark, keys = snapshot.sparkSession, list(keys)
        bounds = [b if isinstance(b, (int, float, str)) else str(b)
                  for b in range_bounds(snapshot, keys[0], parts)]
        kind = snapshot.schema[keys[0]].dataType
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in snapshot.schema.fields)
        where = location or scratch_path(spark, "tables")
        spark.sql(f"CREATE TABLE {name} ({cols}, {PART} INT) USING parquet "
                  f"PARTITIONED BY ({PART}) LOCATION '{where}'")
        for key, value in ((BOUNDS, json.dumps(bounds)), (KEYS, json.dumps(keys)), (PLACE, where)):
            _set_property(spark, name, key, value)
        rows = snapshot.withColumn(PART, range_number(F.col(keys[0]), bounds, kind))
        rows.repartition(PART).sortWithinPartitions(PART, *keys).write.insertInto(name)
        return cls(spark, name)

    def _properties(self) -> dict:
        rows = self.spark.sql(f"SHOW TBLPROPERTIES {self.name}").collect()
        return {r["key"]: r["value"] for r in rows}

    def state(self) -> dict:
        return {"system_id": self._properties().get(IDENTITY)}

    def part(self, key: Column) -> Column:
        return range_number(key, self.bounds, self.schema[self.keys[0]].dataType)

    def current(self) -> DataFrame:
        return self.spark.table(self.name).select(*self.columns)

    def where_key(self, *values) -> DataFrame:
        """The rows of one key: one partition, and the filter reaches its scan."""
        first = F.lit(values[0]).cast(self.schema[self.keys[0]].dataType)
        found = self.spark.table(self.name).where(F.col(PART) == self.part(first))
        for k, v in zip(self.keys, values):
            found = found.where(F.col(k) == F.lit(v))
        return found.select(*self.columns)

    def write_batch(self, changes: DataFrame, batch_id: int = 0, system_id: str | None = None,
                    run: str = "direct") -> dict:
        """Apply one batch. What it touches is staged, checked and then written
        in one job; a failed or repeated batch is applied again and leads to
        the same table. The source's identity is checked in the pass that stages
        the changes, before anything is published. Returns the touched
        partitions and those left without rows."""
        staged, seen = self._stage(changes)
        self._check_identity(seen, system_id)
        touched = [r[0] for r in staged.select(PART).distinct().orderBy(PART).collect()]
        if not touched:
            return {"touched": [], "emptied": []}
        # literals: the scan is pruned to these partitions
        base = self.spark.table(self.name).where(F.col(PART).isin(touched)).select(*self.columns)
        rows = staged.drop(PART, "system_id")
        if UNCHANGED in rows.columns:
            new = apply_with_unchanged(base, rows, self.keys)
        else:
            new = apply_changes(base, rows, self.keys)
        new = new.select(*self.columns).withColumn(PART, self.part(F.col(self.keys[0])))
        filled = Observation("keelson-filled")
        words = range(math.ceil((len(self.bounds) + 1) / 64))
        flag = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col(PART) % 64)
        new = new.repartition(PART).sortWithinPartitions(PART, *self.keys).observe(filled, *[
            F.bit_or(F.when(F.floor(F.col(PART) / 64) == w, flag).otherwise(F.lit(0).cast("bigint")))
            .alias(f"w{w}") for w in words])
        (new.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(PART).parquet(self.location))
        bits = [filled.get[f"w{w}"] or 0 for w in words]
        # an overwrite leaves a partition alone that gets no row: drop it
        emptied = [p for p in touched if not bits[p // 64] >> (p % 64) & 1]
        listed = " ".join(f"PARTITION ({PART} = {p})" for p in touched if p not in emptied)
        if listed:
            self.spark.sql(f"ALTER TABLE {self.name} ADD IF NOT EXISTS {listed}")
        listed = ", ".join(f"PARTITION ({PART} = {p})" for p in emptied)
        if listed:
            self.spark.sql(f"ALTER TABLE {self.name} DROP IF EXISTS {listed}")
            self._remove(emptied)
        self.spark.catalog.refreshTable(self.name)
        return {"touched": touched, "emptied": emptied}

    def _remove(self, parts: Sequence[int]) -> None:
        """The folders of partitions without rows (dropping an external table's
        partition leaves its files)."""
        jvm, sc = self.spark.sparkContext._jvm, self.spark.sparkContext
        for p in parts:
            path = jvm.org.apache.hadoop.fs.Path(self.location, f"{PART}={p}")
            path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)

    def _stage(self, changes: DataFrame) -> tuple[DataFrame, dict]:
        """(the batch with its partitions, written once; the least and greatest
        ``system_id``, observed on the way)."""
        keep = [c for c in changes.columns
                if c in (*META, UNCHANGED, MOVED_FROM, "system_id", *self.columns)]
        rows = changes.select(*keep).withColumn(PART, self.part(F.col(self.keys[0])))
        if "system_id" not in keep:
            return materialize(rows), {}
        ids = Observation("keelson-identity")
        staged = materialize(rows.observe(ids, F.min("system_id").alias("lo"),
                                          F.max("system_id").alias("hi")))
        return staged, ids.get

    def _check_identity(self, seen: dict, system_id: str | None) -> None:
        found = {v for v in (seen.get("lo"), seen.get("hi"), system_id) if v is not None}
        if len(found) > 1:
            raise ValueError(f"feed mixes source systems: {sorted(found)}")
        known = self.state()["system_id"]
        if found and known is not None and found != {known}:
            raise ValueError(f"source system changed: {known!r} -> {found.pop()!r}")
        if found and known is None:
            _set_property(self.spark, self.name, IDENTITY, found.pop())


def _set_property(spark: SparkSession, name: str, key: str, value: str) -> None:
    text = value.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{key}' = '{text}')")


def bucketed_table(name: str, rows: DataFrame, keys: Sequence[str], buckets: int,
                   location: str | None = None) -> DataFrame:
    """``rows`` as a table bucketed and sorted on ``keys``, one file a bucket.
    Joins and anti joins on the keys read it in place."""
    spark = rows.sparkSession
    (rows.repartition(buckets, *keys).write.format("parquet")
     .option("path", location or scratch_path(spark, "tables"))
     .bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name))
    return spark.table(name)
