"""Decode captured messages built here byte by byte with ``struct`` (an
encoder independent of the one used for the registered queries)."""

import struct

import pytest
from pyspark.sql.types import (BinaryType, DoubleType, LongType, StringType,
                               StructField, StructType)

from keelson.sources.messages import (decode_messages, parse_relations,
                                      parse_rows)

OID = 16400
U = object()  # marker: value sent as unchanged
SCHEMA = StructType([StructField("id", LongType()), StructField("name", StringType()),
                     StructField("salary", DoubleType())])
MSG = StructType([StructField("system_id", StringType()), StructField("_seq", LongType()),
                  StructField("_lsn", LongType()), StructField("payload", BinaryType())])


def rel(cols, keys, name="emp", ns="public", oid=OID):
    out = b"R" + struct.pack(">i", oid) + ns.encode() + b"\0" + name.encode() + b"\0"
    out += b"d" + struct.pack(">h", len(cols))
    for c in cols:
        out += bytes([1 if c in keys else 0]) + c.encode() + b"\0"
        out += struct.pack(">i", 25) + struct.pack(">i", -1)
    return out


def tup(values):
    out = struct.pack(">h", len(values))
    for v in values:
        if v is None:
            out += b"n"
        elif v is U:
            out += b"u"
        else:
            b = str(v).encode()
            out += b"t" + struct.pack(">i", len(b)) + b
    return out


def ins(values, oid=OID):
    return b"I" + struct.pack(">i", oid) + b"N" + tup(values)


def upd(values, old=None, tag=b"K", oid=OID):
    head = b"U" + struct.pack(">i", oid)
    if old is not None:
        head += tag + tup(old)
    return head + b"N" + tup(values)


def dele(values, tag=b"K", oid=OID):
    return b"D" + struct.pack(">i", oid) + tag + tup(values)


BEGIN = b"B" + b"\0" * 20
COMMIT = b"C" + b"\0" * 25


def frame(spark, payloads):
    return spark.createDataFrame(
        [("sys", i, 1000 + i, bytearray(p)) for i, p in enumerate(payloads)], MSG)


def decoded(spark, payloads, **kw):
    df = decode_messages(frame(spark, payloads), SCHEMA, **kw)
    return sorted(((r._seq, r._sub, r._op, r.id, r.name, r.salary,
                    tuple(r._unchanged)) for r in df.collect()))


def test_all_message_kinds(spark):
    cols = ["id", "name", "salary"]
    got = decoded(spark, [
        BEGIN,
        rel(cols, ["id"]),
        ins([1, "Ann", 10.5]),
        ins([2, None, 3.0]),                       # NULL in an insert
        upd([1, U, 11.0]),                          # unchanged name
        upd([3, "Bo", 7.0], old=[1, None, None]),   # key moves 1 -> 3
        dele([2, None, None]),                      # delete by key
        dele([3, "Bo", 7.0], tag=b"O"),             # delete with full old row
        upd([4, "Cy", 1.0], old=[4, "Cy", 0.5], tag=b"O"),  # full row, same key
        COMMIT,
    ])
    assert got == [
        (2, 0, "I", 1, "Ann", 10.5, ()),
        (3, 0, "I", 2, None, 3.0, ()),
        (4, 0, "U", 1, None, 11.0, ("name",)),
        (5, 0, "D", 1, None, None, ()),
        (5, 1, "I", 3, "Bo", 7.0, ()),
        (6, 0, "D", 2, None, None, ()),
        (7, 0, "D", 3, None, None, ()),
        (8, 0, "U", 4, "Cy", 1.0, ()),
    ]


def test_relation_in_force_at_position(spark):
    got = decoded(spark, [
        rel(["id", "name", "salary"], ["id"]),
        ins([1, "a", 1.0]),
        rel(["salary", "id", "name"], ["id"]),     # columns reordered
        ins([2.0, 2, "b"]),
        rel(["id", "name"], ["id"]),               # salary dropped
        ins([3, "c"]),
    ])
    assert [g[3:6] for g in got] == [(1, "a", 1.0), (2, "b", 2.0), (3, "c", None)]


def test_relation_fields(spark):
    rels = parse_relations(frame(spark, [rel(["id", "name"], ["id"], name="t1", ns="s")]))
    r = rels.collect()[0]
    assert (r.oid, r.namespace, r.name, r.identity, list(r.cols), list(r.keys)) == \
        (OID, "s", "t1", "d", ["id", "name"], ["id"])


def test_wide_relation(spark):
    cols = [f"c{i}" for i in range(40)]
    schema = StructType([StructField(c, LongType()) for c in cols])
    df = decode_messages(frame(spark, [rel(cols, ["c0"]), ins(list(range(40)))]), schema)
    r = df.collect()[0]
    assert [r[c] for c in cols] == list(range(40))


def test_disagreeing_keys_fail(spark):
    with pytest.raises(ValueError):
        decoded(spark, [rel(["id", "name", "salary"], ["id"]), ins([1, "a", 1.0]),
                        rel(["id", "name", "salary"], ["name"]), ins([2, "b", 1.0])])


def test_stream_rejects_unknown_table(spark, tmp):
    import os

    from keelson.sinks.target import FileTarget
    from keelson.streaming.messages import replicate_messages
    feed = os.path.join(tmp, "feed")
    frame(spark, [rel(["id", "name", "salary"], ["id"], name="emp"),
                  ins([1, "a", 1.0]),
                  rel(["x"], ["x"], name="other", oid=99)]).write.parquet(feed)
    t = FileTarget(spark, os.path.join(tmp, "t"), ["id"],
                   StructType([StructField("id", LongType(), False)] + SCHEMA.fields[1:]))
    s = spark.readStream.schema(MSG).parquet(feed)
    q = replicate_messages(s, t, ["id"], t.schema, table="emp",
                           checkpoint=os.path.join(tmp, "ck"),
                           trigger={"availableNow": True})
    with pytest.raises(Exception) as err:
        q.awaitTermination()
    assert "unknown table" in str(err.value)


def test_no_announced_key_uses_all_columns(spark):
    got = decoded(spark, [rel(["id", "name", "salary"], []), ins([1, "a", 1.0]),
                          dele([1, "a", 1.0], tag=b"O")])
    assert got == [(1, 0, "I", 1, "a", 1.0, ()), (2, 0, "D", 1, "a", 1.0, ())]
