"""Insert if absent by row fingerprints."""

import random

import pytest
from pyspark.sql import functions as F

from keelson.operators import apply as A

SCHEMA = "a long, b string, c double"


@pytest.fixture
def small_threshold(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(name)
    spark.conf.set(name, "2000")
    yield
    spark.conf.set(name, old)


def rows(rnd, n):
    return [(rnd.choice([None, 1, 2, 3]), rnd.choice([None, "", "x", "y" * 20]),
             rnd.choice([None, 0.0, -0.0, float("nan"), 1.5])) for _ in range(n)]


def plain(found):
    return sorted(str((r.a, r.b, None if r.c is None else r.c + 0.0)) for r in found)


@pytest.mark.parametrize("seed", range(2))
def test_both_ways_agree(spark, seed, monkeypatch):
    rnd = random.Random(seed)
    base = spark.createDataFrame(rows(rnd, 12), SCHEMA)
    src = spark.createDataFrame(rows(rnd, 60), SCHEMA)
    one = A.insert_if_absent(base, src).collect()
    monkeypatch.setattr(A, "fits_broadcast", lambda df: False)
    assert plain(A.insert_if_absent(base, src).collect()) == plain(one)
    assert plain(A.insert_if_absent(base.limit(0), src).collect()) == \
        plain(src.distinct().collect())


def test_equal_fingerprints_are_compared(spark, monkeypatch):
    monkeypatch.setattr(A, "fits_broadcast", lambda df: False)
    monkeypatch.setattr(A, "fingerprint", lambda cols: [F.lit(1).alias("_f1"), F.lit(2).alias("_f2")])
    base = spark.createDataFrame([(1, "x", None), (2, None, 0.5)], SCHEMA)
    src = spark.createDataFrame([(1, "x", None), (1, None, None), (2, None, 0.5), (3, "x", None)], SCHEMA)
    assert sorted((r.a, r.b or "") for r in A.insert_if_absent(base, src).collect()) == \
        [(1, ""), (1, "x"), (2, ""), (3, "x")]


def test_wide_columns_of_the_target_stay(spark, tmp, small_threshold):
    """A source beyond the threshold of which few rows are there: below the
    target's exchange only fingerprints are left."""
    spark.range(20_000).select(F.col("id").alias("a"), F.repeat(F.lit("wide"), 50).alias("b"),
                               F.lit(1.0).alias("c")).write.parquet(f"{tmp}/base")
    base = spark.read.parquet(f"{tmp}/base")
    src = spark.range(19_990, 40_000).select(F.col("id").alias("a"), F.repeat(F.lit("wide"), 50).alias("b"),
                                             F.lit(1.0).alias("c"))
    got = A.insert_if_absent(base, src)
    assert got.count() == 40_000
    text = got._jdf.queryExecution().executedPlan().toString()
    assert "LeftSemi, BuildRight" in text  # the hits are broadcast to the target
