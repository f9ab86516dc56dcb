"""A batch looks up the rows that its moves ask for, not the whole target."""

import os

import pytest
from pyspark.sql import functions as F

from keelson.operators.unchanged import fill_moved
from keelson.plans import queries
from keelson.plans.queries import EMPLOYEE, EMPLOYEE_KEYED
from keelson.sinks.target import FileTarget

CHANGE = ("_seq long, _sub int, _op string, id long, name string, salary double, "
          "_unchanged array<string>, _from struct<id: long>")


def changes(spark, rows):
    return spark.createDataFrame(rows, CHANGE)


def move(seq, old, new, left=("name",)):
    return [(seq, 0, "D", old, None, None, [], None),
            (seq, 1, "I", new, None, 1.0, list(left), (old,))]


def target(spark, tmp):
    t = FileTarget(spark, os.path.join(tmp, "t"), ["id"], EMPLOYEE_KEYED, unchanged=True)
    t.seed(spark.createDataFrame([(i, f"n{i}", 0.5) for i in range(20)], EMPLOYEE))
    return t


def test_only_keys_moved_from_are_looked_up(spark, tmp):
    t = target(spark, tmp)
    t.write_batch(changes(spark, [(1, 0, "U", 3, "x", 2.0, [], None),
                                  (2, 0, "D", 4, None, None, [], None)]), 0)
    asked = []
    of = t.rows_of
    t.rows_of = lambda keys: asked.append(sorted(r.id for r in keys.collect())) or of(keys)
    # 3 was changed in the log, 4 deleted there, 5 stands in the base and moves on
    t.write_batch(changes(spark, [*move(11, 3, 103), *move(12, 4, 104), *move(13, 5, 105),
                                  *move(14, 105, 106), (15, 0, "U", 9, "y", 1.0, [], None)]), 1)
    assert asked == [[3, 4, 5]]
    got = {r.id: r.name for r in t.current().where("id > 100 or id = 9").collect()}
    assert got == {103: "x", 104: None, 106: "n5", 9: "y"}


def test_no_lookup_without_a_pointer_at_the_base(spark, tmp):
    t = target(spark, tmp)
    t.rows_of = lambda keys: pytest.fail("the target was read")
    t.write_batch(changes(spark, [(1, 0, "U", 3, "x", 2.0, [], None), *move(2, 3, 103)]), 0)
    assert [r.name for r in t.current().where("id = 103").collect()] == ["x"]


def test_rows_of_are_those_of_current(spark, tmp):
    t = target(spark, tmp)
    t.write_batch(changes(spark, [(1, 0, "U", 3, "x", 2.0, ["name"], None),
                                  (2, 0, "D", 4, None, None, [], None),
                                  (3, 0, "I", 50, "new", 1.0, [], None)]), 0)
    keys = spark.createDataFrame([(3,), (4,), (5,), (50,), (51,), (None,)], "id long")
    assert sorted(t.rows_of(keys).collect()) == sorted(
        t.current().where("id in (3, 4, 5, 50, 51)").collect())


def test_frame_and_function_give_the_same(spark):
    base = spark.createDataFrame([(1, "a", 0.0), (2, None, 0.0)], EMPLOYEE)
    cur = changes(spark, [*move(1, 1, 11), *move(2, 2, 12), *move(3, 30, 13)])
    out = [sorted(map(str, df.collect())) for df in (
        fill_moved(base, cur, ["id"]),
        fill_moved(lambda asked: base.join(asked, "id", "left_semi"), cur, ["id"], base.columns))]
    assert out[0] == out[1] and len(out[0]) == 6


def test_batches_do_not_grow_with_the_feed(spark, tmp, monkeypatch):
    """Positions above ten million gave a batch for each further million."""
    os.makedirs(f"{tmp}/sf")
    n, step = 60, 400_000
    (spark.range(n).select((F.col("id") * step).alias("event_id"),
                           F.expr("timestamp'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, int(id))")
                           .alias("ts"), (F.col("id") % 7).alias("user_id"),
                           F.lit("view").alias("event_type"), F.lit(1.0).alias("value"))
     .write.parquet(f"{tmp}/sf/events.parquet"))
    spark.range(5).selectExpr("id as c_custkey", "'c' as c_name", "0.5D as c_acctbal") \
        .write.parquet(f"{tmp}/sf/customer.parquet")
    drained = []

    class Query:
        def awaitTermination(self):
            pass

        def exception(self):
            return None

    def drain(feed, target, *args, **kwargs):
        drained.append(kwargs["checkpoint"])
        return Query()

    monkeypatch.setattr(queries, "replicate_messages", drain)
    queries.stream_decode_apply(spark, f"{tmp}/sf")
    assert len(drained) == queries.STREAM_FILES and len(set(drained)) == 1
