"""A captured-message table derived from ``events`` (the test data has no
capture of its own).

Every event becomes one row message of the employee table
``(id int8 key, name text, salary float8)``; each calendar day of ``ts``
is one replication session that starts with ``B`` and a relation message
and ends with ``C``. On odd days the relation lists the columns in a
different order, so a row is readable only with the relation in force at
its position. Positions: a change at ``4 * event_id + 2``; a day's ``B`` at
``4 * first_id`` and ``R`` at ``4 * first_id + 1``; its ``C`` at
``4 * last_id + 3``.

Variations that exercise the decoder:

* update with ``event_id % 13 = 0``: the key moves to ``id + 1000000``
  (old key sent as ``K``);
* other updates with ``event_id % 11 = 0``: the full old row is sent (``O``),
  here with the values of the new one;
* updates of ``view`` events, moves too: ``name`` is sent as unchanged
  (``u``); beside ``O`` it can be read from the old row;
* delete with an even ``event_id``: the full old row is sent (``O``),
  otherwise the key only (``K``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.binary import (ascii_bytes, be_bytes, cstring_bytes,
                                int32_bytes, utf8_bytes)
from ..operators.partitioning import spread
from .feeds import employee_changes, table

# Fixed values of the derived capture (shared with the oracle SQL).
SYSTEM_ID = "7412345678901234567"
OID = 16385
NAMESPACE = "public"
TABLE = "employee"
KEY_MOVE_EVERY = 13
KEY_SHIFT = 1000000
OLD_ROW_EVERY = 11
UNCHANGED_EVENT = "view"
LSN_BASE = 94489280512   # position 16/0
LSN_STEP = 24
# Column order per relation version (day parity), with type oids.
TYPE_OIDS = {"id": 20, "name": 25, "salary": 701}
VERSION_COLUMNS = {0: ["id", "name", "salary"], 1: ["salary", "id", "name"]}
KEY_COLUMNS = ["id"]


def _day(ts: Column) -> Column:
    return F.datediff(F.to_date(ts), F.lit("1970-01-01").cast("date"))


def _text(c: Column) -> Column:
    return F.concat(ascii_bytes("t"), int32_bytes(F.octet_length(c)),
                    utf8_bytes(c))


def _tuple(order: list[str], values: dict[str, Column],
           unchanged: dict[str, Column] | None = None) -> Column:
    """Tuple bytes for the columns in ``order``. ``values``: column ->
    text (NULL is sent as 'n'); ``unchanged``: column -> flag, sent as 'u'."""
    parts = [be_bytes(F.lit(len(order)), 2)]
    for c in order:
        v = values[c]
        item = F.when(v.isNull(), ascii_bytes("n")).otherwise(_text(v))
        if unchanged and c in unchanged:
            item = F.when(unchanged[c], ascii_bytes("u")).otherwise(item)
        parts.append(item)
    return F.concat(*parts)


def _relation(order: list[str]) -> Column:
    parts = [ascii_bytes("R"), int32_bytes(F.lit(OID)),
             cstring_bytes(F.lit(NAMESPACE)), cstring_bytes(F.lit(TABLE)),
             ascii_bytes("d"), be_bytes(F.lit(len(order)), 2)]
    for c in order:
        parts += [F.unhex(F.lit("01" if c in KEY_COLUMNS else "00")),
                  cstring_bytes(F.lit(c)), int32_bytes(F.lit(TYPE_OIDS[c])),
                  F.unhex(F.lit("FFFFFFFF"))]
    return F.concat(*parts)


def captured_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events").select("event_id", "ts")
    ch = spread(employee_changes(spark, sf_dir, keep=("ts",)),
                spark.sparkContext.defaultParallelism)
    seq = F.col("_seq")
    op = F.col("_op")
    text = {"id": F.col("id").cast("string"), "name": F.col("name"),
            "salary": F.col("salary").cast("string")}
    moved = {**text, "id": (F.col("id") + KEY_SHIFT).cast("string")}
    key_only = {c: (text[c] if c in KEY_COLUMNS else F.lit(None).cast("string"))
                for c in text}
    key_move = (op == "U") & (seq % KEY_MOVE_EVERY == 0)
    old_row = (op == "U") & (seq % OLD_ROW_EVERY == 0)
    unchanged = {"name": F.col("name") == F.lit(UNCHANGED_EVENT)}
    oid = int32_bytes(F.lit(OID))
    N, K, O = ascii_bytes("N"), ascii_bytes("K"), ascii_bytes("O")

    def payload(order: list[str]) -> Column:
        return (
            F.when(op == "I", F.concat(ascii_bytes("I"), oid, N, _tuple(order, text)))
            .when(key_move, F.concat(ascii_bytes("U"), oid,
                                     K, _tuple(order, key_only),
                                     N, _tuple(order, moved, unchanged)))
            .when(old_row, F.concat(ascii_bytes("U"), oid, O, _tuple(order, text),
                                    N, _tuple(order, text, unchanged)))
            .when(op == "U", F.concat(ascii_bytes("U"), oid, N,
                                      _tuple(order, text, unchanged)))
            .when(seq % 2 == 0, F.concat(ascii_bytes("D"), oid, O,
                                         _tuple(order, text)))
            .otherwise(F.concat(ascii_bytes("D"), oid, K, _tuple(order, key_only))))

    # One projection per relation version: each row is encoded with the
    # column order of its day's relation (the branches stay small enough
    # to compile).
    version = _day(F.col("ts")) % 2
    rows = None
    for v, order in VERSION_COLUMNS.items():
        part = ch.where(version == v).select((seq * 4 + 2).alias("_seq"),
                                              payload(order).alias("payload"))
        rows = part if rows is None else rows.unionByName(part)

    days = (ev.groupBy(_day(F.col("ts")).alias("day"))
            .agg(F.min("event_id").alias("first"), F.max("event_id").alias("last")))
    dv = F.col("day") % 2
    rel = None
    for v, cols in VERSION_COLUMNS.items():
        rel = (F.when(dv == v, _relation(cols)) if rel is None
               else rel.when(dv == v, _relation(cols)))
    zero8 = F.unhex(F.lit("0" * 16))
    begin = F.concat(ascii_bytes("B"), zero8, zero8, int32_bytes(F.col("day")))
    commit = F.concat(ascii_bytes("C"), F.unhex(F.lit("00")), zero8, zero8, zero8)
    marks = days.select(F.inline(F.array(
        F.struct((F.col("first") * 4).alias("_seq"), begin.alias("payload")),
        F.struct((F.col("first") * 4 + 1).alias("_seq"),
                 rel.alias("payload")),
        F.struct((F.col("last") * 4 + 3).alias("_seq"), commit.alias("payload")))))
    allm = rows.unionByName(marks)
    return allm.select(F.lit(SYSTEM_ID).alias("system_id"), "_seq",
                       (F.lit(LSN_BASE) + F.col("_seq") * LSN_STEP).alias("_lsn"),
                       "payload")
