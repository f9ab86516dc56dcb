"""Model test: a plain dict replay of random inserts, updates and deletes
equals the Spark result - for one pass, for any split into batches through
the file target, and with a batch replayed."""

import random

import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

from keelson.operators.apply import apply_changes
from keelson.sinks.target import FileTarget

SCHEMA = StructType([StructField("id", LongType(), False),
                     StructField("v", StringType(), True)])


def feed(seed, n=400, keys=25):
    rnd = random.Random(seed)
    out = []
    for seq in range(n):
        op = rnd.choice("IUUD")
        k = rnd.randrange(keys)
        out.append((seq, op, k, None if op == "D" else f"v{seq}"))
    rnd.shuffle(out)  # arrival order must not matter
    return out


def replay(base, changes):
    state = dict(base)
    for seq, op, k, v in sorted(changes):
        if op == "D":
            state.pop(k, None)
        else:
            state[k] = v
    return sorted(state.items())


BASE = [(k, f"b{k}") for k in range(0, 30, 2)]


@pytest.mark.parametrize("seed", [1, 2])
def test_one_pass(spark, seed):
    ch = feed(seed)
    base = spark.createDataFrame(BASE, SCHEMA)
    changes = spark.createDataFrame(ch, "_seq long, _op string, id long, v string")
    got = sorted(map(tuple, apply_changes(base, changes, ["id"]).collect()))
    assert got == replay(BASE, ch)


@pytest.mark.parametrize("seed", [3])
def test_batches_with_replay(spark, tmp, seed):
    ch = feed(seed)
    rnd = random.Random(seed)
    cuts = sorted(rnd.sample(range(1, len(ch)), 3))
    parts = [ch[a:b] for a, b in zip([0] + cuts, cuts + [len(ch)])]
    t = FileTarget(spark, tmp, ["id"], SCHEMA)
    t.seed(spark.createDataFrame(BASE, SCHEMA))
    for i, part in enumerate(parts):
        df = spark.createDataFrame(part, "_seq long, _op string, id long, v string")
        t.write_batch(df, i)
        if i == 1:
            t.write_batch(df, i)  # a retried batch must not change anything
        if i == 2:
            t.compact()
    got = sorted(map(tuple, t.current().collect()))
    assert got == replay(BASE, ch)


def test_late_older_change_loses(spark, tmp):
    t = FileTarget(spark, tmp, ["id"], SCHEMA)
    t.seed(spark.createDataFrame([], SCHEMA))
    mk = lambda rows: spark.createDataFrame(rows, "_seq long, _op string, id long, v string")
    t.write_batch(mk([(10, "U", 1, "new")]), 0)
    t.compact()
    t.write_batch(mk([(5, "U", 1, "old"), (6, "I", 2, "x")]), 1)  # arrives late
    assert sorted(map(tuple, t.current().collect())) == [(1, "new"), (2, "x")]


def test_purged_tombstone_is_gone(spark, tmp):
    t = FileTarget(spark, tmp, ["id"], SCHEMA)
    t.seed(spark.createDataFrame([(1, "a")], SCHEMA))
    mk = lambda rows: spark.createDataFrame(rows, "_seq long, _op string, id long, v string")
    t.write_batch(mk([(10, "D", 1, None)]), 0)
    t.compact(purge_tombstones_through=10)
    assert spark.read.parquet(t._p("base", "gen=1")).count() == 0


def test_shuffled_apply_matches(spark):
    ch = feed(5)
    base = spark.createDataFrame(BASE, SCHEMA)
    changes = spark.createDataFrame(ch, "_seq long, _op string, id long, v string")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = sorted(map(tuple, apply_changes(base, changes, ["id"], once=False).collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert got == replay(BASE, ch)
