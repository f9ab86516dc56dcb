"""Targets as plain catalog tables: touched ranges only, buckets in place."""

import os
import random
import uuid

import pytest
from pyspark.sql import functions as F

from keelson.operators import apply as A
from keelson.sinks.partitioned import RangeTarget, bucketed_table
from keelson.streaming.replicate import run_available

FEED = "_seq long, _op string, id long, name string"


def fresh(spark, tmp, n=1000, parts=10):
    base = spark.range(n).select("id", F.concat(F.lit("n"), "id").alias("name"))
    return RangeTarget.create(f"t_{uuid.uuid4().hex}", base, ["id"], parts, f"{tmp}/t")


def files(tmp):
    out = {}
    for folder, _, names in os.walk(f"{tmp}/t"):
        for x in names:
            if x.endswith(".parquet"):
                out[os.path.join(folder, x)] = os.stat(os.path.join(folder, x)).st_mtime_ns
    return out


def rows(t):
    return {r.id: r.name for r in t.current().collect()}


def test_untouched_files_keep_name_and_time(spark, tmp):
    t = fresh(spark, tmp)
    before, want = files(tmp), rows(t)
    assert len(t.bounds) == 9 and len({os.path.dirname(f) for f in before}) == 10
    low = t.bounds[0]
    ch = spark.createDataFrame([(1, "U", 0, "x"), (2, "D", 1, None), (3, "I", -5, "new"),
                                (4, "D", 2, None), (5, "I", 2, "again")], FEED)
    done = t.write_batch(ch)
    assert done == {"touched": [0], "emptied": []}
    after = files(tmp)
    kept = {f for f in before if "_part=0" not in f}
    assert {f: after[f] for f in kept} == {f: before[f] for f in kept}
    assert not {f for f in before if "_part=0" in f} & set(after)
    want.update({0: "x", -5: "new", 2: "again"})
    del want[1]
    assert rows(t) == want and low > 2
    assert t.write_batch(ch)["touched"] == [0]  # a replay
    assert rows(t) == want


def test_emptied_range_is_dropped(spark, tmp):
    t = fresh(spark, tmp, n=20, parts=4)
    gone = [k for k in range(20) if k >= t.bounds[-1]]
    ch = spark.createDataFrame([(k, "D", k, None) for k in gone], FEED)
    assert t.write_batch(ch) == {"touched": [3], "emptied": [3]}
    assert sorted(rows(t)) == [k for k in range(20) if k not in gone]
    t.write_batch(spark.createDataFrame([(99, "I", 10 ** 6, "z")], FEED))
    assert rows(t)[10 ** 6] == "z"
    assert t.write_batch(spark.createDataFrame([], FEED)) == {"touched": [], "emptied": []}


@pytest.mark.parametrize("seed", range(2))
def test_random_batches_match_replay(spark, tmp, seed):
    rnd = random.Random(seed)
    t, state = fresh(spark, tmp, 60, 5), {k: f"n{k}" for k in range(60)}
    seq = 0
    for batch in range(4):
        out = []
        for _ in range(rnd.randint(0, 30)):
            seq += 1
            key, op = rnd.randint(-10, 80), rnd.choice("IUD")
            out.append((seq, op, key, None if op == "D" else f"v{seq}"))
            state.pop(key, None)
            if op != "D":
                state[key] = f"v{seq}"
        t.write_batch(spark.createDataFrame(out, FEED), batch)
    assert rows(t) == state


def test_moves_between_ranges_keep_unsent_values(spark, tmp):
    t = fresh(spark, tmp, 100, 4)
    ch = spark.createDataFrame(
        [(7, 0, "D", 3, None, [], None), (7, 1, "I", 95000, None, ["name"], (3,)),
         (8, 0, "U", 50, None, ["name"], None)],
        "_seq long, _sub int, _op string, id long, name string, _unchanged array<string>, "
        "_from struct<id: long>")
    t.write_batch(ch)
    got = rows(t)
    assert got[95000] == "n3" and 3 not in got and got[50] == "n50" and len(got) == 100


def test_identity_is_checked_before_anything_is_written(spark, tmp):
    t = fresh(spark, tmp, 20, 2)
    feed = f"system_id string, {FEED}"
    t.write_batch(spark.createDataFrame([("a", 1, "U", 1, "x")], feed))
    before = files(tmp)
    with pytest.raises(ValueError, match="mixes"):
        t.write_batch(spark.createDataFrame([("a", 2, "U", 1, "y"), ("b", 3, "U", 2, "y")], feed))
    with pytest.raises(ValueError, match="changed"):
        t.write_batch(spark.createDataFrame([("b", 2, "U", 1, "y")], feed))
    assert files(tmp) == before and rows(t)[1] == "x"


def test_one_key_reads_one_partition(spark, tmp):
    t = fresh(spark, tmp)
    found = t.where_key(777)
    assert [tuple(r) for r in found.collect()] == [(777, "n777")]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(id), EqualTo(id,777)]" in plan
    assert len({os.path.dirname(f) for f in found.inputFiles()}) == 1
    assert "PartitionFilters: [isnotnull(_part" in plan
    with pytest.raises(ValueError, match="does not exist"):
        RangeTarget(spark, "no_such_table")


def test_bucketed_target_is_not_moved(spark, tmp):
    """Changes beyond the broadcast threshold are dealt into the table's buckets:
    no exchange stands above the base scan."""
    base = spark.range(5000).select(F.col("id").alias("k"), F.col("id").cast("string").alias("v"))
    name = f"b_{uuid.uuid4().hex}"
    table = bucketed_table(name, base, ["k"], 8, f"{tmp}/b")
    ch = spark.range(3000).select((F.col("id") + 1).alias("_seq"), F.when(
        F.col("id") % 3 == 0, "D").otherwise("U").alias("_op"), (F.col("id") * 2).alias("k"),
        F.lit("new").alias("v"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        for got in (A.apply_changes(table, ch, ["k"]), A.delete(table, ch, ["k"])):
            got.count()
            lines = got._jdf.queryExecution().executedPlan().toString().splitlines()
            at = next(i for i, x in enumerate(lines) if "Bucketed: true" in x)
            depth = lines[at].index("Scan") if "Scan" in lines[at] else 0
            above = []
            for x in reversed(lines[:at]):
                here = len(x) - len(x.lstrip(" :+-"))
                if here < depth:
                    above.append(x.strip(" :+-"))
                    depth = here
            assert any("Join" in x for x in above)
            assert not any(x.startswith("Exchange") for x in above), above
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    want = A.apply_changes(base, ch, ["k"])
    assert sorted(map(tuple, A.apply_changes(table, ch, ["k"]).collect())) == \
        sorted(map(tuple, want.collect()))


def test_stream_into_ranges(spark, tmp):
    t = fresh(spark, tmp, 50, 5)
    for k in range(3):
        spark.createDataFrame([(k * 10 + 1, "U", k, f"s{k}"), (k * 10 + 2, "D", 40 + k, None)],
                              FEED).coalesce(1).write.mode("append").parquet(f"{tmp}/f")
    feed = spark.readStream.schema(FEED).option("maxFilesPerTrigger", 1).parquet(f"{tmp}/f")
    run_available(feed, t, ["id"], checkpoint=f"{tmp}/c")
    got = rows(t)
    assert [got[k] for k in range(3)] == ["s0", "s1", "s2"] and not {40, 41, 42} & set(got)
