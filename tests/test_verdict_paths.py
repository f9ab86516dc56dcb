"""Paths on which changes or values could be lost."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import (DoubleType, LongType, StringType, StructField,
                               StructType)

from keelson.operators.unchanged import apply_with_unchanged
from keelson.sinks.target import CatalogTarget, CsvTarget, FileTarget
from keelson.sources.messages import decode_messages
from keelson.sources.snapshot import copy_lines_to_rows, rejected_lines
from keelson.streaming.messages import replicate_messages
from keelson.streaming.replicate import run_available
from test_messages import U, dele, frame, ins, rel, upd

SCHEMA = StructType([StructField("id", LongType()), StructField("name", StringType()),
                     StructField("salary", DoubleType())])
COLS = ["id", "name", "salary"]
FEED = "_seq long, _op string, id long, name string, salary double"


def base(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def applied(spark, start, msgs):
    changes = decode_messages(frame(spark, msgs), SCHEMA)
    out = apply_with_unchanged(base(spark, *start), changes, ["id"])
    return sorted(map(tuple, out.collect()))


def test_moved_key_keeps_what_was_not_sent(spark):
    got = applied(spark, [(1, "keepme", 1.0)], [
        rel(COLS, ["id"]), upd([2, U, 9.0], old=[1, None, None])])
    assert got == [(2, "keepme", 9.0)]


def test_chain_of_moves(spark):
    got = applied(spark, [(1, "keepme", 1.0), (7, "other", 0.0)], [
        rel(COLS, ["id"]), upd([2, U, 9.0], old=[1, None, None]),
        upd([2, U, 10.0]), upd([3, U, U], old=[2, None, None]),
        ins([1, "again", 5.0]), upd([4, U, 6.0], old=[1, None, None]), dele([7, None, None])])
    assert got == [(3, "keepme", 10.0), (4, "again", 6.0)]


def test_full_old_row_gives_the_value(spark):
    got = applied(spark, [(1, "big", 1.0)], [
        rel(COLS, []), upd([1, U, 9.0], old=[1, "big", 1.0], tag=b"O")])
    assert (1, "big", 9.0) in got and (1, None, 9.0) not in got


def test_truncate_fails(spark):
    df = frame(spark, [rel(COLS, ["id"]), ins([1, "a", 1.0])])
    cut = df.limit(1).select(*[F.lit(bytearray(b"T\0\0\0\1\0\0\0\0\7")).alias("payload")
                               if c == "payload" else c for c in df.columns])
    with pytest.raises(Exception, match="truncate"):
        decode_messages(df.unionByName(cut), SCHEMA).collect()


def test_tables_of_one_name_in_two_namespaces(spark):
    msgs = [rel(COLS, ["id"], oid=1, ns="public", name="employee"), ins([1, "a", 1.0], oid=1),
            rel(COLS, ["id"], oid=2, ns="archive", name="employee"), ins([2, "b", 1.0], oid=2)]
    df = frame(spark, msgs)
    with pytest.raises(ValueError, match="namespaces"):
        decode_messages(df, SCHEMA, table="employee")
    got = decode_messages(df, SCHEMA, table="employee", namespace="archive").collect()
    assert [r.id for r in got] == [2]


@pytest.mark.parametrize("line", ["1,a,2.0,EXTRA", "2,b"])
def test_copy_line_with_a_wrong_field_count(spark, line):
    lines = spark.createDataFrame([("1,a,2.0",), (line,)], "value string")
    with pytest.raises(Exception, match="COPY line"):
        copy_lines_to_rows(lines, SCHEMA).collect()
    assert [tuple(r) for r in copy_lines_to_rows(lines, SCHEMA, strict=False).collect()] \
        == [(1, "a", 2.0)]
    assert [r.value for r in rejected_lines(lines, SCHEMA).collect()] == [line]


def land(spark, path, name, rows):
    spark.createDataFrame(rows, FEED).write.parquet(f"{path}/{name}")


def feed(spark, path):
    schema = spark.createDataFrame([], FEED).schema
    return spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(path)


def test_new_checkpoint_after_compaction(spark, tmp):
    t = FileTarget(spark, tmp + "/t", ["id"], SCHEMA)
    t.seed(base(spark, (1, "a", 1.0)))
    land(spark, tmp + "/f1", "a", [(10, "U", 1, "b", 2.0)])
    run_available(feed(spark, tmp + "/f1"), t, ["id"], checkpoint=tmp + "/c1")
    t.compact()
    land(spark, tmp + "/f2", "a", [(20, "I", 100, "new", 3.0)])
    run_available(feed(spark, tmp + "/f2"), t, ["id"], checkpoint=tmp + "/c2")
    want = [(1, "b", 2.0), (100, "new", 3.0)]
    assert sorted(map(tuple, t.current().collect())) == want
    t.compact()
    fresh = FileTarget(spark, t.path, ["id"], SCHEMA)
    assert sorted(map(tuple, fresh.current().collect())) == want


def test_half_written_batch_is_not_read(spark, tmp):
    import os
    t = FileTarget(spark, tmp + "/t", ["id"], SCHEMA)
    t.seed(base(spark, (1, "a", 1.0)))
    t.write_batch(spark.createDataFrame([(5, "I", 2, "x", 1.0)], FEED), 0)
    os.unlink(tmp + "/t/log/run=direct/batch_id=0/_SUCCESS")
    assert [r.id for r in t.current().collect()] == [1]
    t.write_batch(spark.createDataFrame([(5, "I", 2, "x", 1.0)], FEED), 0)
    assert sorted(r.id for r in t.current().collect()) == [1, 2]


def test_targets_refuse_or_honour_unchanged(spark, tmp):
    changes = spark.createDataFrame(
        [(5, "U", 1, None, 9.0, ["name"])], FEED + ", _unchanged array<string>")
    t = FileTarget(spark, tmp + "/a", ["id"], SCHEMA)
    with pytest.raises(ValueError, match="seed"):
        t.write_batch(changes, 0)
    t.seed(base(spark, (1, "keepme", 1.0)))
    with pytest.raises(Exception, match="unchanged"):
        t.write_batch(changes, 0)
    t = FileTarget(spark, tmp + "/b", ["id"], SCHEMA, unchanged=True)
    t.seed(base(spark, (1, "keepme", 1.0)))
    t.write_batch(changes, 0)
    assert [tuple(r) for r in t.current().collect()] == [(1, "keepme", 9.0)]


class Recorder(CatalogTarget):
    """A catalog target whose MERGE is kept instead of run (no catalog with
    row-level changes here)."""

    def __init__(self, spark, schema):
        self.spark, self.name, self.keys, self.schema = spark, "t", ["id"], schema
        self.columns = [f.name for f in schema.fields]
        self.merged, self.known = [], None

    def current(self):
        return base(self.spark, (1, "keepme", 1.0))

    def state(self):
        return {"system_id": self.known}

    def merge(self, net):
        self.merged += [r.asDict() for r in net.collect()]


def test_messages_into_a_catalog_target(spark, tmp, monkeypatch):
    t = Recorder(spark, SCHEMA)
    frame(spark, [rel(COLS, ["id"]), upd([1, U, 9.0]), ins([2, "new", 1.0]),
                  dele([3, None, None])]).write.parquet(tmp + "/m")
    schema = spark.read.parquet(tmp + "/m").schema
    stream = spark.readStream.schema(StructType([f for f in schema.fields if f.name != "system_id"])) \
        .parquet(tmp + "/m")
    q = replicate_messages(stream, t, ["id"], SCHEMA, checkpoint=tmp + "/c",
                           trigger={"availableNow": True})
    q.awaitTermination()
    assert q.exception() is None
    got = {r["id"]: r for r in t.merged}
    assert got[1]["_op"] == "U" and not got[1]["_sent_name"] and got[1]["salary"] == 9.0
    assert got[2]["_op"] == "I" and got[2]["_sent_name"] and got[2]["name"] == "new"
    assert got[3]["_op"] == "D"


def test_text_files_keep_any_text(spark, tmp):
    rows = [(1, "I", 1, "a\nb,c\\ \"q\"", 1.0), (2, "I", 2, "", 2.0), (3, "I", 3, None, None),
            (4, "D", 4, "gone", 5.0)]
    t = CsvTarget(spark, tmp + "/csv", keys=["id"])
    t.write_batch(spark.createDataFrame(rows, FEED))
    back = t.read(spark.createDataFrame([], FEED).schema).collect()
    assert sorted(map(tuple, back)) == [*rows[:3], (4, "D", 4, None, None)]
