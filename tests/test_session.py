from keelson.operators.partitioning import spread
from keelson.session import scratch_path, shared_dir


def test_shared_dir_reads_the_session(spark):
    before = spark.sparkContext.getCheckpointDir()
    assert before
    assert shared_dir(spark) == before          # never replaced when set
    p = scratch_path(spark, "x")
    assert p.startswith(before) and "/keelson/x/" in p
    assert scratch_path(spark, "x") != p        # fresh per call


def test_spread_moves_rows_only_when_told(spark):
    one = spark.range(0, 1000, numPartitions=1)
    assert spread(one).rdd.getNumPartitions() == 1
    assert spread(one, 5).rdd.getNumPartitions() == 5
