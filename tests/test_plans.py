"""Plan properties the design relies on at scale."""

import contextlib
import io
import os

from pyspark.sql import functions as F

from keelson.operators.apply import apply_changes
from keelson.operators.changes import net_changes
from keelson.operators.unchanged import net_with_unchanged
from keelson.plans import capture, feeds
from keelson.plans.queries import EMPLOYEE
from keelson.sources.feed import read_feed
from keelson.sources.messages import decode_messages

SMOKE = "/root/testdata/sf0.001"


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_net_change_limits_before_shuffle(spark):
    p = plan(net_changes(feeds.employee_changes(spark, SMOKE), ["id"]))
    tree = p.split("\n\n")[0]
    # partial limit sits below the exchange, final limit above it
    lines = [ln for ln in tree.splitlines() if "WindowGroupLimit" in ln or "Exchange" in ln]
    assert "WindowGroupLimit" in lines[-1] and "Exchange" in lines[-2]
    assert "Partial" in p and "Final" in p


def test_unchanged_net_aggregates_partially(spark):
    df = feeds.employee_changes(spark, SMOKE).withColumn(
        "_unchanged", F.array().cast("array<string>"))
    p = plan(net_with_unchanged(df, ["id"], ["name", "salary"]))
    assert p.count("SortAggregate") + p.count("HashAggregate") >= 2  # partial + final


def test_position_filter_reaches_scan(spark, tmp):
    path = os.path.join(tmp, "feed")
    feeds.employee_changes(spark, SMOKE).write.parquet(path)
    df = read_feed(spark, path, feeds.employee_changes(spark, SMOKE).schema, after=500)
    assert "GreaterThan(_seq,500)" in plan(df)


def test_apply_reads_only_needed_columns(spark):
    p = plan(apply_changes(feeds.employee_base(spark, SMOKE),
                           feeds.employee_changes(spark, SMOKE), ["id"]))
    assert "ReadSchema: struct<c_custkey:bigint,c_name:string,c_acctbal:double>" in p
    assert "c_mktsegment" not in p and "props" not in p


def test_decode_is_jvm_only_and_broadcasts_relations(spark, tmp):
    path = os.path.join(tmp, "cap")
    capture.captured_messages(spark, SMOKE).write.parquet(path)
    p = plan(decode_messages(spark.read.parquet(path), EMPLOYEE))
    assert "BroadcastHashJoin" in p
    assert "Python" not in p and "ArrowEval" not in p and "BatchEval" not in p


def test_hot_key_is_correct(spark):
    # one key carries a third of all changes
    rows = [(i, "U", 0 if i % 3 == 0 else i % 50, f"v{i}") for i in range(3000)]
    ch = spark.createDataFrame(rows, "_seq long, _op string, id long, name string")
    base = spark.createDataFrame([(k, "b") for k in range(60)], "id long, name string")
    got = dict(map(tuple, apply_changes(base, ch, ["id"]).collect()))
    want = {k: "b" for k in range(60)}
    for seq, _, k, v in rows:
        want[k] = v
    assert got == want


def _executed(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    return plan(df)


def test_change_side_join_follows_its_bytes(spark):
    """Staged, the change side has a known size: below the planner's byte
    threshold it is broadcast and the target is not shuffled, above it the
    join is shuffled."""
    from keelson.operators.apply import delete, insert_if_absent
    base = feeds.employee_base(spark, SMOKE)
    ch = feeds.employee_changes(spark, SMOKE)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for limit, wanted, unwanted in (("10m", "BroadcastHashJoin", "SortMergeJoin"),
                                        ("-1", "SortMergeJoin", "BroadcastHashJoin")):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
            for df in (apply_changes(base, ch, ["id"]),
                       delete(base, ch.where("_op = 'D'"), ["id"])):
                p = _executed(df)
                assert wanted in p and unwanted not in p
            # the target is only in the first of these two joins
            p = _executed(insert_if_absent(base, ch.select("id", "name", "salary")))
            assert wanted in p
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_key_filter_reaches_base_and_log(spark, tmp):
    from keelson.sinks.target import FileTarget
    t = FileTarget(spark, tmp + "/t", ["id"], feeds.employee_base(spark, SMOKE).schema)
    t.seed(feeds.employee_base(spark, SMOKE))
    t.write_batch(feeds.employee_changes(spark, SMOKE), 0)
    old = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    try:
        plan = t.current().where("id = 2")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.maxMetadataStringLength", old)
    scans = plan.split("FileScan")[1:]
    found = {part: ["EqualTo(id,2)" in x for x in scans if f"/t/{part}" in x]
             for part in ("base", "log")}
    assert found["base"] and all(found["base"]) and sum(found["log"]) >= 2
