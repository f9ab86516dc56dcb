"""Sequential fill of segments (O5) against a plain replay."""

import random

import pytest
from pyspark.sql import functions as F

from keelson.operators.batches import fill_segments


def replay(sizes, cap, header=0):
    out, segment, used = [], 0, header
    for k, n in enumerate(sizes):
        if used > header and used + n > cap:
            segment, used = segment + 1, header
        used += n
        out.append(segment)
    return out


def filled(spark, sizes, cap, **kw):
    rows = spark.createDataFrame([(k * 3, n) for k, n in enumerate(sizes)], "_seq long, b long")
    got = fill_segments(rows, "b", cap, **kw).orderBy("_seq").collect()
    assert [r._seq for r in got] == [k * 3 for k in range(len(sizes))]
    total = 0
    for r, n in zip(got, sizes):
        total += n
        assert r._running == total
    return [r._batch for r in got]


@pytest.mark.parametrize("seed", range(3))
def test_sequential_fill_matches_replay(spark, seed):
    rnd = random.Random(seed)
    cap = rnd.choice([30, 100, 1000])
    # small rows, rows of about the cap, and rows far larger than several ranges
    sizes = [rnd.choice([rnd.randint(1, 9), rnd.randint(1, 2 * cap), rnd.choice([1, cap, 20 * cap])])
             if rnd.random() < 0.3 else rnd.randint(1, 12) for _ in range(700)]
    assert filled(spark, sizes, cap, buckets=5) == replay(sizes, cap)
    assert filled(spark, sizes, cap, header=cap // 4, grid=1) == replay(sizes, cap, cap // 4)


def test_edges(spark):
    assert filled(spark, [5], 3) == [0]
    assert filled(spark, [3, 3, 3], 3) == [0, 1, 2]
    assert filled(spark, [1, 2, 3], 6) == [0, 0, 0]
    assert filled(spark, [1, 2, 3], 5) == [0, 0, 1]
    none = spark.createDataFrame([], "_seq long, b long")
    assert fill_segments(none, "b", 5).collect() == []
    with pytest.raises(Exception, match="positive size"):
        fill_segments(spark.createDataFrame([(1, 0)], "_seq long, b long"), "b", 5).collect()


def test_rounds_grow_with_the_logarithm(spark):
    """100,000 rows of 10 bytes in ranges of 4 x 100 bytes: 2,500 ranges, and
    at most 13 rounds."""
    rounds = []
    rows = spark.range(100_000).select(F.col("id").alias("_seq"), F.lit(10).cast("long").alias("b"))
    got = fill_segments(rows, "b", 100, on_round=rounds.append)
    assert got.where(F.col("_batch") != F.floor(F.col("_seq") / 10)).count() == 0
    assert len(rounds) <= 13
