"""Named queries over the driver's tables, one per operator of the
inventory. Each takes (spark, sf_dir) and returns a DataFrame; the SQL
each must agree with is in ``oracles.py`` under the same name.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (DoubleType, LongType, StringType, StructField,
                               StructType)

from ..functions.copytext import encode_line
from ..functions.positions import (clock_to_timestamp, format_position,
                                   parse_position, timestamp_to_clock)
from ..functions.render import render_row
from ..operators import apply as A
from ..operators import rows as R
from ..operators.asof import carry_forward
from ..operators.batches import (SEGMENT_HEADER, batch_summary, fill_segments,
                                 plan_batches)
from ..operators.changes import net_changes, tombstones
from ..operators.chunks import interleave
from ..operators.route import (check_source_identity, read_from_position,
                               route_by_op, route_by_table)
from ..operators.partitioning import spread
from ..operators.unchanged import apply_with_unchanged
from ..session import scratch_path
from ..sinks.partitioned import RangeTarget, bucketed_table
from ..sinks.target import CsvTarget, FileTarget
from ..sources.feed import read_feed, stream_feed
from ..sources.messages import (collect_versions, decode_messages,
                                parse_relations, parse_rows, relation_as_of)
from ..sources.snapshot import (copy_lines_to_rows, read_snapshot, to_copy_lines,
                                write_copy_text)
from ..streaming.keyed import newest
from ..streaming.messages import replicate_messages
from ..streaming.replicate import run_available
from . import capture, feeds
from .feeds import EMPLOYEE_KEYS, table

EMPLOYEE = StructType([StructField("id", LongType(), True),
                       StructField("name", StringType(), True),
                       StructField("salary", DoubleType(), True)])
EMPLOYEE_KEYED = StructType([StructField("id", LongType(), False),
                             StructField("name", StringType(), True),
                             StructField("salary", DoubleType(), True)])
CHANGE_COLS = ["_seq", "_op", "id", "name", "salary"]
SEGMENT_CAP = 1024 * 1024  # batch cap used by segment_plan (bytes)
FILL_CAP = 64 * 1024       # cap used by segment_fill (bytes)
NAME_EVERY = 7             # key_lineage sends the name with every seventh event
CHUNKS = 4                 # chunks of bootstrap_chunked
RANGES = 16                # key ranges of the partitioned target
FLUSH_CAP = 64 * 1024      # bytes of a batch in stream_apply_buffered
BUCKETS = 16               # buckets of the bucketed target
STREAM_FILES = 10          # the landed feed is cut into this many files


def _ch(spark, sf):
    return feeds.employee_changes(spark, sf)


def _base(spark, sf):
    return feeds.employee_base(spark, sf)


def _max_seq(spark, sf):
    return table(spark, sf, "events").select(F.max("event_id")).scalar()


def _landed_capture(spark, sf) -> DataFrame:
    """The capture as it would arrive: written once to the shared folder,
    then read like any landed feed (the decoder reads it more than once)."""
    path = scratch_path(spark, "capture")
    capture.captured_messages(spark, sf).write.parquet(path)
    return spark.read.parquet(path)


def _decoded(spark, sf):
    return decode_messages(_landed_capture(spark, sf), EMPLOYEE)


def _decoded_out(df: DataFrame) -> DataFrame:
    return df.select("_seq", "_sub", "_lsn", "_op", "id", "name", "salary",
                     F.array_join("_unchanged", ",").alias("unchanged"))


# -- sources ----------------------------------------------------------------

def snapshot_scan(spark, sf):
    return read_snapshot(spark, os.path.join(sf, "orders.parquet"))


def _read_landed(spark, sf, after=None) -> DataFrame:
    """The feed as landed files, through the batch reader."""
    path = scratch_path(spark, "feed")
    _ch(spark, sf).write.parquet(path)
    return read_feed(spark, path, FEED_SCHEMA, after=after)


def feed_scan(spark, sf):
    return _read_landed(spark, sf).select(*CHANGE_COLS)


def feed_stream(spark, sf):
    """S3 as a stream: everything that has landed, appended to a table."""
    out = scratch_path(spark, "feed_copy")
    feed = stream_feed(spark, _landed_feed(spark, sf), FEED_SCHEMA, max_files=3)
    q = (feed.writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", scratch_path(spark, "ckpt"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception():
        raise RuntimeError(str(q.exception()))
    return spark.read.schema(FEED_SCHEMA).parquet(out).select(*CHANGE_COLS)


def route_by_op_q(spark, sf):
    appends, deletes = route_by_op(_read_landed(spark, sf))
    return (appends.withColumn("side", F.lit("append"))
            .unionByName(deletes.withColumn("side", F.lit("delete")))
            .select("side", *CHANGE_COLS))


def read_from_position_q(spark, sf):
    pos = table(spark, sf, "events").select(
        F.floor(F.max("event_id") / 2).cast("bigint")).scalar()
    whole = read_from_position(_ch(spark, sf), pos).select(*CHANGE_COLS)
    landed = _read_landed(spark, sf, after=pos).select(*CHANGE_COLS)
    return whole.intersectAll(landed)


def copy_text_decode(spark, sf):
    docs = table(spark, sf, "documents")
    schema = docs.schema
    lines = to_copy_lines(docs)
    return copy_lines_to_rows(lines, schema)


def snapshot_copy_dump(spark, sf):
    """A COPY text dump of ``documents`` landed as text files, read back
    as the snapshot of a table (S1 + S2 through files)."""
    docs = table(spark, sf, "documents")
    path = scratch_path(spark, "dump")
    write_copy_text(docs, path)
    return read_snapshot(spark, path, fmt="copy", schema=docs.schema)


def pgoutput_decode(spark, sf):
    return _decoded_out(_decoded(spark, sf))


def relation_as_of_q(spark, sf, carry=None):
    """Per row message: its position, and the position, table and column
    list of the relation version in force there."""
    msgs = _landed_capture(spark, sf)
    rels = parse_relations(msgs)
    vers = collect_versions(rels)
    width = vers.agg(F.max(F.size("cols"))).first()[0] or 0
    att = relation_as_of(parse_rows(msgs, width), rels, versions=vers, carry=carry)
    return att.select("_seq", F.col("_rel_seq").alias("rel_seq"), "table",
                      F.array_join("cols", ",").alias("cols"))


def relation_as_of_carry(spark, sf):
    """The same by carry-forward along the feed, as for a relation with many
    versions or more rows than one task should hold."""
    return relation_as_of_q(spark, sf, carry=True)


def value_as_of(spark, sf):
    """Each event with the newest signup up to it: one key holds all rows, a
    fifth of them versions."""
    ev = table(spark, sf, "events").withColumn("all", F.lit(0))
    signups = ev.where("event_type = 'signup'").select(
        "all", "event_id", F.struct(F.col("event_id").alias("signup"), "value").alias("last"))
    found = carry_forward(ev.select("all", "event_id", "user_id"), signups,
                          ["all"], ["event_id"], ["last"])
    return found.select("event_id", "user_id", "last.signup",
                        F.col("last.value").alias("signup_value"))


def lsn_parse(spark, sf):
    ev = table(spark, sf, "events").select("event_id")
    lsn = F.lit(capture.LSN_BASE) + F.col("event_id") * capture.LSN_STEP
    t = ev.select("event_id", format_position(lsn).alias("lsn_text"))
    return t.select("event_id", "lsn_text",
                    parse_position(F.col("lsn_text")).alias("lsn"))


def clock_parse(spark, sf):
    """The feed's clock (microseconds since 2000) there and back."""
    clock = timestamp_to_clock(F.col("ts").cast("timestamp"))
    ev = table(spark, sf, "events").select("event_id", clock.alias("clock"))
    return ev.select("event_id", "clock",
                     clock_to_timestamp(F.col("clock")).cast("timestamp_ntz").alias("ts"))


def positional_names_q(spark, sf):
    """A dump without names takes the target's, in order."""
    cu, lines = _customer_text(spark, sf)
    plain = lines.select(F.split("value", ",").alias("v")).select(
        *[F.get("v", F.lit(i)).alias(f"_c{i}") for i in range(len(cu.columns))])
    return R.conform(R.positional_names(plain, cu.schema), cu.schema, mode="strict")


def _customer_text(spark, sf):
    cu = table(spark, sf, "customer")
    return cu, cu.select(F.concat_ws(",", *[F.col(c).cast("string")
                                            for c in cu.columns]).alias("value"))


def typed_parse(spark, sf):
    cu, lines = _customer_text(spark, sf)
    return R.typed_parse(lines, cu.schema, "value", mode="FAILFAST")


def cast_to_target(spark, sf):
    cu = table(spark, sf, "customer")
    text = cu.select(*[F.col(c).cast("string").alias(c) for c in cu.columns])
    return R.conform(text, cu.schema, mode="strict")


def route_by_table_q(spark, sf):
    emp = _ch(spark, sf).select(F.lit("employee").alias("_table"), "_seq", "_op")
    orders = feeds.order_changes(spark, sf).select(
        F.lit("orders").alias("_table"), "_seq", "_op")
    routed = route_by_table(emp.unionByName(orders), ["employee", "orders"])
    return routed["employee"]


def _labelled(spark, sf):
    """Documents with their labels, NULL where there are none; the language
    is known for documents that are labelled or long."""
    docs = table(spark, sf, "documents").select("doc_id", "lang", "n_chars")
    both = docs.join(table(spark, sf, "labels"), "doc_id", "left")
    lang = F.when(F.col("quality").isNotNull() | (F.col("n_chars") > 1000), F.col("lang"))
    return both.select("doc_id", lang.alias("lang"), "quality", "toxic")


def required_any(spark, sf):
    return R.require(_labelled(spark, sf), ["lang", "quality"], "any")


def required_all(spark, sf):
    return R.require(_labelled(spark, sf), ["lang", "quality"], "all")


def required_default_keys(spark, sf):
    # No NOT NULL field in this schema, so the key fields are required.
    rows = _labelled(spark, sf)
    return R.require(rows, R.required_fields(rows.schema, keys=["doc_id", "quality"]), "all")


# -- net change and apply ------------------------------------------------------

def latest_change_per_key(spark, sf):
    return net_changes(_ch(spark, sf), EMPLOYEE_KEYS).select(*CHANGE_COLS)


def apply_in_order(spark, sf):
    return A.apply_changes(_base(spark, sf), _ch(spark, sf), EMPLOYEE_KEYS)


def apply_append_then_delete(spark, sf):
    return A.apply_changes(_base(spark, sf), _ch(spark, sf), EMPLOYEE_KEYS,
                           order="append_then_delete")


def apply_wide_keys(spark, sf):
    return A.apply_changes(feeds.order_base(spark, sf),
                           feeds.order_changes(spark, sf), feeds.ORDER_KEYS)


def upsert_by_key(spark, sf):
    ch = _ch(spark, sf)
    ups = net_changes(ch.where(F.col("_op") != "D"), EMPLOYEE_KEYS)
    return A.upsert(_base(spark, sf), ups.select("id", "name", "salary"),
                    EMPLOYEE_KEYS)


def _with_tombstones(spark, sf):
    ch = _ch(spark, sf)
    return (tombstones(ch, EMPLOYEE_KEYS)
            .unionByName(ch.where(F.col("_op") != "D")))


def insert_if_absent(spark, sf):
    src = (_with_tombstones(spark, sf).select("id", "name", "salary")
           .unionByName(_base(spark, sf)))
    return A.insert_if_absent(_base(spark, sf), src)


def delete_by_key(spark, sf):
    dels = _ch(spark, sf).where(F.col("_op") == "D")
    return A.delete(_base(spark, sf), dels, EMPLOYEE_KEYS)


def delete_by_composite_key(spark, sf):
    li = table(spark, sf, "lineitem")
    n = table(spark, sf, "orders").select(F.count(F.lit(1))).scalar()
    ev = table(spark, sf, "events")
    dels = ev.select(((F.col("event_id") * feeds.KEY_SPREAD) % n).alias("l_orderkey"),
                     ((F.col("event_id") % 7) + 1).cast("int").alias("l_linenumber"))
    return A.delete(li, dels, ["l_orderkey", "l_linenumber"])


def bootstrap_overlap(spark, sf):
    """Snapshot taken at half the feed, feed replayed from two fifths: the
    overlap is applied twice and must not matter."""
    ch = _ch(spark, sf)
    top = _max_seq(spark, sf)
    snap_pos = F.floor(top / 2)
    from_pos = F.floor(top * 2 / 5)
    snapshot = A.apply_changes(_base(spark, sf), ch.where(F.col("_seq") <= snap_pos),
                               EMPLOYEE_KEYS)
    return A.bootstrap(snapshot, ch.where(F.col("_seq") > from_pos), EMPLOYEE_KEYS)


def bootstrap_chunked(spark, sf):
    """J5 in chunks: four key ranges are read at four moments of the feed, each
    between two positions; one feed of chunks and changes fills an empty table."""
    ch, base = _ch(spark, sf), _base(spark, sf)
    top = _max_seq(spark, sf)
    chunks = None
    for k in range(CHUNKS):
        low, high = (F.floor(top * (2 * k + n) / (2 * CHUNKS + 1)).cast("bigint") for n in (1, 2))
        read = F.floor((low + high) / 2)
        state = A.apply_changes(base, ch.where(F.col("_seq") <= read), EMPLOYEE_KEYS)
        part = state.where(F.pmod("id", F.lit(CHUNKS)) == k).select(
            "*", low.alias("_low"), high.alias("_high"))
        chunks = part if chunks is None else chunks.unionByName(part)
    feed = interleave(chunks, ch, EMPLOYEE_KEYS)
    return A.apply_changes(base.limit(0), feed, EMPLOYEE_KEYS)


def duplicate_keys(spark, sf):
    return R.duplicate_keys(_ch(spark, sf), EMPLOYEE_KEYS)


def _doc_lines(spark, sf):
    docs = spread(table(spark, sf, "documents"), spark.sparkContext.defaultParallelism)
    line = encode_line([F.col(c) for c in docs.columns])
    return docs.select(F.col("doc_id").alias("_seq"),
                       (F.octet_length(line) + 1).cast("bigint").alias("_bytes"))


def segment_plan(spark, sf):
    planned = plan_batches(_doc_lines(spark, sf), "_bytes", SEGMENT_CAP)
    return batch_summary(planned, "_bytes").withColumnRenamed("_batch", "segment_id")


def segment_rows(spark, sf):
    planned = plan_batches(_doc_lines(spark, sf), "_bytes", SEGMENT_CAP)
    return planned.select("_seq", "_bytes", "_running",
                          F.col("_batch").alias("segment_id"))


def _filled(spark, sf):
    return fill_segments(_doc_lines(spark, sf), "_bytes", FILL_CAP, header=SEGMENT_HEADER)


def segment_fill(spark, sf):
    """O5 by sequential fill: a segment rolls before the cap is passed."""
    return batch_summary(_filled(spark, sf), "_bytes").withColumnRenamed("_batch", "segment_id")


def segment_fill_rows(spark, sf):
    return _filled(spark, sf).select("_seq", "_bytes", "_running",
                                     F.col("_batch").alias("segment_id"))


def tombstone_rows(spark, sf):
    return tombstones(_ch(spark, sf), EMPLOYEE_KEYS).select(*CHANGE_COLS)


def key_change_update(spark, sf):
    return net_changes(_decoded(spark, sf), EMPLOYEE_KEYS).select(
        "_seq", "_sub", "_op", "id", "name", "salary")


def unchanged_fill(spark, sf):
    return apply_with_unchanged(_base(spark, sf), _decoded(spark, sf), EMPLOYEE_KEYS)


def key_lineage(spark, sf):
    """X1 in long chains: each event moves its user's row to a key of its own
    and sends the name every seventh time only."""
    ev = table(spark, sf, "events")
    before = carry_forward(ev, ev.select("user_id", "event_id", F.col("event_id").alias("prior")),
                           ["user_id"], ["event_id"], ["prior"], inclusive=False)
    key = F.col("event_id") + feeds.NEW_KEY
    old = F.coalesce(F.col("prior") + feeds.NEW_KEY, F.col("user_id"))
    sent = F.col("event_id") % NAME_EVERY == 0
    none = F.array().cast("array<string>")
    nothing = F.lit(None).cast("struct<id: long>")
    names = ["_sub", "_op", "id", "name", "salary", "_unchanged", "_from"]

    def change(*values):
        return F.struct(*[v.alias(n) for v, n in zip(values, names)])

    moves = before.select(F.col("event_id").alias("_seq"), F.inline(F.array(
        change(F.lit(0), F.lit("D"), old, F.lit(None).cast("string"),
               F.lit(None).cast("double"), none, nothing),
        change(F.lit(1), F.lit("I"), key, F.when(sent, F.col("event_type")), F.col("value"),
               F.when(sent, none).otherwise(F.array(F.lit("name"))),
               F.struct(old.alias("id"))))))
    return apply_with_unchanged(_base(spark, sf), moves, EMPLOYEE_KEYS)


# -- sinks, targets, client ---------------------------------------------------

def file_sink_rows(spark, sf):
    ch = _ch(spark, sf).select("_seq", "_op", "id", "name")
    target = CsvTarget(spark, scratch_path(spark, "csv_sink"))
    target.write_batch(ch)
    return target.read(StructType([StructField("_seq", LongType()),
                                   StructField("_op", StringType()),
                                   StructField("id", LongType()),
                                   StructField("name", StringType())]))


def file_sink_deletes(spark, sf):
    """K2: deletes go to the file sink as their key only."""
    ch = _ch(spark, sf).select("_seq", "_op", "id", "name", "salary")
    target = CsvTarget(spark, scratch_path(spark, "csv_sink"), keys=EMPLOYEE_KEYS)
    target.write_batch(ch)
    return target.read(StructType([f for f in FEED_SCHEMA.fields if f.name != "_sub"]))


def file_sink_text(spark, sf):
    """K1 with any text: commas, quotes, line feeds, empty values."""
    docs = table(spark, sf, "documents")
    target = CsvTarget(spark, scratch_path(spark, "csv_sink"))
    target.write_batch(docs)
    return target.read(docs.schema)


def stream_csv_sink(spark, sf):
    """K1 in a stream: the landed feed appended to CSV through the file
    sink, whose own log makes a replayed micro-batch write once."""
    path = _landed_feed(spark, sf)
    target = CsvTarget(spark, scratch_path(spark, "csv_stream"))
    cols = _stream(spark, path).select("_seq", "_op", "id", "name")
    q = (target.stream_sink(cols, scratch_path(spark, "ckpt"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception():
        raise RuntimeError(str(q.exception()))
    return target.read(StructType([StructField("_seq", LongType()),
                                   StructField("_op", StringType()),
                                   StructField("id", LongType()),
                                   StructField("name", StringType())]))


def _range_target(spark, sf) -> RangeTarget:
    loc = scratch_path(spark, "tables")
    return RangeTarget.create(f"ranges_{os.path.basename(loc)}", _base(spark, sf),
                              EMPLOYEE_KEYS, RANGES, loc)


def catalog_apply(spark, sf):
    """K3, K4 on a plain catalog table: the feed in one batch, only the touched
    key ranges are read and written."""
    t = _range_target(spark, sf)
    t.write_batch(_ch(spark, sf))
    return t.current()


def catalog_apply_stream(spark, sf):
    """The same through a stream, a batch a file, whose files come in any order:
    keyed state keeps late older changes out."""
    path = _landed_feed(spark, sf)
    t = _range_target(spark, sf)
    run_available(newest(_stream(spark, path), EMPLOYEE_KEYS), t, EMPLOYEE_KEYS,
                  checkpoint=scratch_path(spark, "ckpt"), output_mode="update")
    return t.current()


def catalog_key_scan(spark, sf):
    """The row of one key, from the partition that can hold it."""
    t = _range_target(spark, sf)
    t.write_batch(_ch(spark, sf))
    return t.where_key(2)


def catalog_unchanged_moves(spark, sf):
    """X1 and X3 on a catalog table: decoded messages with moves between key
    ranges and values that were not sent."""
    t = _range_target(spark, sf)
    t.write_batch(_decoded(spark, sf))
    return t.current()


def apply_bucketed(spark, sf):
    """J1, J3 on a table bucketed by its key, which is joined in place."""
    loc = scratch_path(spark, "tables")
    base = bucketed_table(f"buckets_{os.path.basename(loc)}", feeds.order_base(spark, sf),
                          feeds.ORDER_KEYS, BUCKETS, loc)
    return A.apply_changes(base, feeds.order_changes(spark, sf), feeds.ORDER_KEYS)


def source_identity_feeds(spark, sf):
    """Two feeds, the second from another system: what each would change
    and whether the target took it."""
    t = _range_target(spark, sf)
    ch = _ch(spark, sf)
    half = F.floor(F.lit(_max_seq(spark, sf)) / 2)
    out = []
    for name, cond in (("first", F.col("_seq") <= half), ("second", F.col("_seq") > half)):
        feed = ch.where(cond).withColumn("system_id", F.lit(name))
        try:
            t.write_batch(feed)
            taken = True
        except ValueError:
            taken = False
        out.append(feed.groupBy(F.col("system_id").alias("feed")).agg(
            F.count(F.lit(1)).alias("n_changes")).withColumn("taken", F.lit(taken)))
    return out[0].unionByName(out[1]).withColumn("n_rows", F.lit(t.current().count()))


def _landed_feed(spark, sf) -> str:
    """Write the derived feed as STREAM_FILES files cut by position."""
    ch = _ch(spark, sf)
    top = _max_seq(spark, sf)
    part = F.floor(F.col("_seq") * STREAM_FILES / (top + 1)).cast("int")
    path = scratch_path(spark, "feed")
    (ch.withColumn("_part", part).repartition(STREAM_FILES, "_part")
     .write.partitionBy("_part").parquet(path))
    return path


FEED_SCHEMA = StructType([StructField("_seq", LongType()),
                          StructField("_sub", LongType()),
                          StructField("_op", StringType()),
                          StructField("id", LongType()),
                          StructField("name", StringType()),
                          StructField("salary", DoubleType())])


def _stream(spark, path, max_files=1):
    return (spark.readStream.schema(FEED_SCHEMA)
            .option("maxFilesPerTrigger", max_files)
            .option("recursiveFileLookup", "true").parquet(path))


def _seeded_target(spark, sf) -> FileTarget:
    t = FileTarget(spark, scratch_path(spark, "target"), EMPLOYEE_KEYS,
                   EMPLOYEE_KEYED)
    t.seed(_base(spark, sf))
    return t


def stream_apply(spark, sf):
    path = _landed_feed(spark, sf)
    t = _seeded_target(spark, sf)
    run_available(_stream(spark, path), t, EMPLOYEE_KEYS,
                  checkpoint=scratch_path(spark, "ckpt"))
    return t.current()


def stream_apply_buffered(spark, sf):
    """Buffered flush (T2): micro-batches bounded by bytes rather than by file
    count; the cap is far below the feed's size, so it cuts."""
    path = _landed_feed(spark, sf)
    t = _seeded_target(spark, sf)
    feed = (spark.readStream.schema(FEED_SCHEMA)
            .option("maxBytesPerTrigger", FLUSH_CAP)
            .option("recursiveFileLookup", "true").parquet(path))
    run_available(feed, t, EMPLOYEE_KEYS, checkpoint=scratch_path(spark, "ckpt"))
    return t.current()


def stream_compact_vacuum(spark, sf):
    """The 10-file stream with a compaction every 3 batches, then a vacuum
    of folded logs and old generations; the table must be unchanged."""
    path = _landed_feed(spark, sf)
    t = _seeded_target(spark, sf)
    run_available(_stream(spark, path), t, EMPLOYEE_KEYS,
                  checkpoint=scratch_path(spark, "ckpt"), compact_every=3)
    t.vacuum()
    return t.current()


def stream_apply_direct(spark, sf):
    path = _landed_feed(spark, sf)
    t = _seeded_target(spark, sf)
    run_available(_stream(spark, path), t, EMPLOYEE_KEYS,
                  checkpoint=scratch_path(spark, "ckpt"), direct=True)
    return t.current()


def stream_direct_batches(spark, sf):
    """Each landed file is a batch of its own, applied as it comes: rows and
    positions of every batch's net change."""
    path = _landed_feed(spark, sf)
    t = _seeded_target(spark, sf)
    run_available(_stream(spark, path), t, EMPLOYEE_KEYS,
                  checkpoint=scratch_path(spark, "ckpt"), direct=True)
    log = spark.read.parquet(os.path.join(t.path, "log"))
    batches = log.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("_seq").alias("first_seq"),
        F.max("_seq").alias("last_seq"))
    return batches.select("n_rows", "first_seq", "last_seq")


def stream_reused_checkpoint(spark, sf):
    """T5: half the feed, then the checkpoint folder is emptied and used again
    for the rest, whose batches are numbered from 0 again; none may be lost."""
    ch = _ch(spark, sf)
    half = F.floor(F.lit(_max_seq(spark, sf)) / 2)
    t = _seeded_target(spark, sf)
    ckpt = scratch_path(spark, "ckpt")
    for cond in (F.col("_seq") <= half, F.col("_seq") > half):
        path = scratch_path(spark, "feed")
        ch.where(cond).write.parquet(path)
        run_available(_stream(spark, path), t, EMPLOYEE_KEYS, checkpoint=ckpt)
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(ckpt)
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
    return t.current()


def file_sink_replay(spark, sf):
    """K1: a batch that is written again is there once."""
    ch = _ch(spark, sf).select("_seq", "_op", "id", "name")
    target = CsvTarget(spark, scratch_path(spark, "csv_sink"))
    half = F.floor(F.lit(_max_seq(spark, sf)) / 2)
    for batch, cond in ((0, F.col("_seq") <= half), (1, F.col("_seq") > half),
                        (1, F.col("_seq") > half), (0, F.col("_seq") <= half)):
        target.write_batch(ch.where(cond), batch)
    return target.read(StructType([f for f in FEED_SCHEMA.fields
                                   if f.name not in ("_sub", "salary")]))


def staged_log(spark, sf):
    path = _landed_feed(spark, sf)
    t = _seeded_target(spark, sf)
    run_available(_stream(spark, path), t, EMPLOYEE_KEYS,
                  checkpoint=scratch_path(spark, "ckpt"))
    return spark.read.parquet(os.path.join(t.path, "log")).select(*CHANGE_COLS)


def stream_resume(spark, sf):
    """Land half the files, run, stop; land the rest, restart on the same
    checkpoint; then compact. The result must equal one pass."""
    ch = _ch(spark, sf)
    top = _max_seq(spark, sf)
    half = F.floor(F.lit(top) / 2)
    path = scratch_path(spark, "feed")
    ckpt = scratch_path(spark, "ckpt")
    t = _seeded_target(spark, sf)
    ch.where(F.col("_seq") <= half).write.parquet(os.path.join(path, "part=0"))
    run_available(_stream(spark, path), t, EMPLOYEE_KEYS, checkpoint=ckpt)
    ch.where(F.col("_seq") > half).write.parquet(os.path.join(path, "part=1"))
    run_available(_stream(spark, path), t, EMPLOYEE_KEYS, checkpoint=ckpt)
    t.compact()
    return t.current()


def stream_new_checkpoint(spark, sf):
    """Half the feed through one stream, a compaction, then the rest through
    another stream with a checkpoint of its own."""
    ch = _ch(spark, sf)
    half = F.floor(F.lit(_max_seq(spark, sf)) / 2)
    t = _seeded_target(spark, sf)
    for cond in (F.col("_seq") <= half, F.col("_seq") > half):
        path = scratch_path(spark, "feed")
        ch.where(cond).write.parquet(path)
        run_available(_stream(spark, path), t, EMPLOYEE_KEYS,
                      checkpoint=scratch_path(spark, "ckpt"))
        t.compact()
    return t.current()


def snapshot_once(spark, sf):
    """A second snapshot of a seeded target changes nothing."""
    t = _seeded_target(spark, sf)
    again = t.seed(_base(spark, sf).withColumn("salary", F.lit(0.0)))
    return t.current().withColumn("seeded_again", F.lit(again))


def stream_decode_apply(spark, sf):
    """Captured messages landed in STREAM_FILES parts in position order, each
    streamed as one batch through decode into a file target seeded from
    ``customer``; unchanged columns keep their last value."""
    msgs = capture.captured_messages(spark, sf)
    top = table(spark, sf, "events").select(F.max("event_id")).first()[0]
    part = F.floor(F.col("_seq") * STREAM_FILES / (top * 4 + 4)).cast("int")
    path = scratch_path(spark, "capture_feed")
    stage = scratch_path(spark, "capture_stage")
    ckpt = scratch_path(spark, "ckpt")
    msgs.withColumn("_part", part).write.partitionBy("_part").parquet(stage)
    t = FileTarget(spark, scratch_path(spark, "target"), EMPLOYEE_KEYS,
                   EMPLOYEE_KEYED, unchanged=True)
    t.seed(_base(spark, sf))
    # A part lands as files of at most ~1M messages, written side by side, and
    # is drained before the next one lands: so a row never comes in an earlier
    # batch than its relation, and the number of batches does not grow.
    files = 1 + top // (STREAM_FILES * 1_000_000)
    for i in range(STREAM_FILES):
        src = spark.read.schema(msgs.schema).parquet(os.path.join(stage, f"_part={i}"))
        (src.repartitionByRange(files, "_seq").sortWithinPartitions("_seq")
         .write.parquet(os.path.join(path, f"part={i:03d}")))
        feed = (spark.readStream.schema(msgs.schema)
                .option("recursiveFileLookup", "true").parquet(path))
        q = replicate_messages(feed, t, EMPLOYEE_KEYS, EMPLOYEE_KEYED, checkpoint=ckpt,
                               trigger={"availableNow": True})
        q.awaitTermination()
        if q.exception():
            raise RuntimeError(str(q.exception()))
    return t.current()


def source_identity(spark, sf):
    msgs = _landed_capture(spark, sf)
    sid = check_source_identity(msgs, None)
    return msgs.select("system_id").distinct().where(F.col("system_id") == sid)


def target_filter_scan(spark, sf):
    t = _seeded_target(spark, sf)
    t.write_batch(_ch(spark, sf), 0)
    return t.current().where(F.col("name") == "purchase")


def select_where_limit(spark, sf):
    view = f"orders_{os.getpid()}"
    table(spark, sf, "orders").createOrReplaceTempView(view)
    return spark.sql(f"SELECT * FROM {view} WHERE o_orderstatus = 'O' "
                     f"ORDER BY o_totalprice DESC, o_orderkey LIMIT 100")


def insert_from_range(spark, sf):
    """CREATE TABLE, then INSERT a generated series for every order: the
    numbers 1 to its last line."""
    last = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(
        F.max("l_linenumber").alias("n"))
    loc = scratch_path(spark, "tables")
    name = f"foo_{os.path.basename(loc)}"
    spark.sql(f"CREATE TABLE {name} (id BIGINT, k BIGINT) USING parquet "
              f"LOCATION '{loc}'")
    series = last.select(F.col("l_orderkey").alias("id"), F.explode(
        F.sequence(F.lit(1).cast("bigint"), F.col("n").cast("bigint"))).alias("k"))
    series.write.insertInto(name)
    return spark.table(name)


def render_rows(spark, sf):
    cu = table(spark, sf, "customer")
    return cu.select(render_row([F.col("c_custkey"), F.col("c_name"),
                                 F.col("c_mktsegment")]).alias("line"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "snapshot_scan": snapshot_scan,
    "feed_scan": feed_scan,
    "feed_stream": feed_stream,
    "clock_parse": clock_parse,
    "positional_names": positional_names_q,
    "file_sink_deletes": file_sink_deletes,
    "file_sink_text": file_sink_text,
    "stream_new_checkpoint": stream_new_checkpoint,
    "snapshot_once": snapshot_once,
    "route_by_op": route_by_op_q,
    "read_from_position": read_from_position_q,
    "copy_text_decode": copy_text_decode,
    "snapshot_copy_dump": snapshot_copy_dump,
    "pgoutput_decode": pgoutput_decode,
    "relation_as_of": relation_as_of_q,
    "relation_as_of_carry": relation_as_of_carry,
    "value_as_of": value_as_of,
    "lsn_parse": lsn_parse,
    "typed_parse": typed_parse,
    "cast_to_target": cast_to_target,
    "route_by_table": route_by_table_q,
    "required_any": required_any,
    "required_all": required_all,
    "required_default_keys": required_default_keys,
    "latest_change_per_key": latest_change_per_key,
    "apply_in_order": apply_in_order,
    "apply_append_then_delete": apply_append_then_delete,
    "apply_wide_keys": apply_wide_keys,
    "upsert_by_key": upsert_by_key,
    "insert_if_absent": insert_if_absent,
    "delete_by_key": delete_by_key,
    "delete_by_composite_key": delete_by_composite_key,
    "bootstrap_overlap": bootstrap_overlap,
    "bootstrap_chunked": bootstrap_chunked,
    "duplicate_keys": duplicate_keys,
    "segment_plan": segment_plan,
    "segment_rows": segment_rows,
    "segment_fill": segment_fill,
    "segment_fill_rows": segment_fill_rows,
    "tombstone_rows": tombstone_rows,
    "key_change_update": key_change_update,
    "unchanged_fill": unchanged_fill,
    "key_lineage": key_lineage,
    "file_sink_rows": file_sink_rows,
    "stream_csv_sink": stream_csv_sink,
    "staged_log": staged_log,
    "stream_apply": stream_apply,
    "stream_apply_direct": stream_apply_direct,
    "stream_apply_buffered": stream_apply_buffered,
    "stream_compact_vacuum": stream_compact_vacuum,
    "stream_resume": stream_resume,
    "catalog_apply": catalog_apply,
    "catalog_apply_stream": catalog_apply_stream,
    "catalog_key_scan": catalog_key_scan,
    "catalog_unchanged_moves": catalog_unchanged_moves,
    "apply_bucketed": apply_bucketed,
    "source_identity_feeds": source_identity_feeds,
    "stream_direct_batches": stream_direct_batches,
    "stream_reused_checkpoint": stream_reused_checkpoint,
    "file_sink_replay": file_sink_replay,
    "stream_decode_apply": stream_decode_apply,
    "source_identity": source_identity,
    "target_filter_scan": target_filter_scan,
    "select_where_limit": select_where_limit,
    "insert_from_range": insert_from_range,
    "render_rows": render_rows,
}
