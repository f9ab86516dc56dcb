import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from keelson.functions.positions import (clock_to_timestamp, format_position,
                                         parse_position)
from keelson.operators.batches import batch_summary, plan_batches
from keelson.operators.route import route_by_table, unknown_tables
from keelson.operators.rows import (check_duplicates, conform, positional_names,
                                    require, required_fields, typed_parse)
from keelson.sinks.target import CatalogTarget, CsvTarget

SCHEMA = StructType([StructField("id", LongType(), True),
                     StructField("name", StringType(), True),
                     StructField("salary", DoubleType(), True)])


def test_require_modes(spark):
    df = spark.createDataFrame([(1, None, None), (2, "a", None), (3, "b", 1.0)], SCHEMA)
    assert require(df, ["name", "salary"], "any").count() == 2
    assert require(df, ["name", "salary"], "all").count() == 1


def test_required_default_is_keys():
    assert required_fields(SCHEMA, ["id"]) == ["id"]
    strict = StructType([StructField("id", LongType(), False)] + SCHEMA.fields[1:])
    assert required_fields(strict, ["name"]) == ["id"]


def test_conform_strict_and_try(spark):
    df = spark.createDataFrame([("1", "a", "2.5"), ("x", "b", "3")],
                               "id string, name string, salary string")
    tried = conform(df, SCHEMA, mode="try").orderBy("name").collect()
    assert [r._rejected for r in tried] == [False, True]
    with pytest.raises(Exception):
        conform(df, SCHEMA, mode="strict").collect()


def test_duplicates(spark):
    df = spark.createDataFrame([(1, "I", 5), (2, "U", 5), (3, "U", 6)],
                               "_seq long, _op string, id long")
    with pytest.raises(ValueError):
        check_duplicates(df, ["id"], "error")
    latest = check_duplicates(df, ["id"], "latest").orderBy("id").collect()
    assert [(r.id, r._seq) for r in latest] == [(5, 2), (6, 3)]


def test_typed_parse_names_and_modes(spark):
    lines = spark.createDataFrame([("1,Ann,2.5",), ("zz,Bo,1",)], "value string")
    ok = typed_parse(lines, SCHEMA).orderBy("name").collect()
    assert [(r.id, r.name, r.salary) for r in ok] == [(1, "Ann", 2.5), (None, "Bo", 1.0)]
    reordered = typed_parse(spark.createDataFrame([("2.5,Ann,1",)], "value string"),
                            SCHEMA, names=["salary", "name", "id"]).collect()[0]
    assert (reordered.id, reordered.salary) == (1, 2.5)
    with pytest.raises(Exception):
        typed_parse(lines, SCHEMA, mode="FAILFAST").collect()


def test_positional_names(spark):
    df = spark.createDataFrame([(1, "a", 2.0)], "_c0 long, _c1 string, _c2 double")
    assert positional_names(df, SCHEMA).columns == ["id", "name", "salary"]


def test_positions():
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    r = spark.range(1).select(
        parse_position(F.lit("16/B374D848")).alias("p"),
        format_position(F.lit(97500059720)).alias("t"),
        clock_to_timestamp(F.lit(0)).cast("string").alias("c")).first()
    assert (r.p, r.t, r.c) == (97500059720, "16/B374D848", "2000-01-01 00:00:00")


def test_plan_batches_matches_sequential(spark):
    import random
    rnd = random.Random(7)
    rows = [(i * 3 + rnd.randrange(3), rnd.randrange(1, 500)) for i in range(2000)]
    df = spark.createDataFrame(rows, "_seq long, b long")
    got = {r._seq: r._batch for r in plan_batches(df, "b", 10_000, buckets=7).collect()}
    run, want = 0, {}
    for seq, b in sorted(rows):
        run += b
        want[seq] = (run - b) // 10_000
    assert got == want
    summ = batch_summary(plan_batches(df, "b", 10_000, buckets=3), "b").collect()
    assert sum(r.n_rows for r in summ) == 2000


def test_route_by_table(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "_table string, _seq long")
    assert [r[0] for r in unknown_tables(df, ["a", "b"]).collect()] == ["c"]
    with pytest.raises(ValueError):
        route_by_table(df, ["a", "b"])
    assert route_by_table(df, ["a", "b", "c"])["b"].count() == 1


def test_catalog_target_must_exist(spark):
    with pytest.raises(ValueError):
        CatalogTarget(spark, "no_such_table_here", ["id"])


def test_csv_target_round_trip(spark, tmp):
    t = CsvTarget(spark, tmp + "/csv")
    df = spark.createDataFrame([(1, "I", 7, "a,b"), (2, "D", 8, None)],
                               "_seq long, _op string, id long, name string")
    t.write_batch(df)
    back = t.read(StructType([StructField("_seq", LongType()), StructField("_op", StringType()),
                              StructField("id", LongType()), StructField("name", StringType())]))
    assert sorted(map(tuple, back.collect())) == [(1, "I", 7, "a,b"), (2, "D", 8, None)]


def test_catalog_target_builds_merge(spark, tmp):
    """No catalog with row-level operations is installed here; the MERGE is
    built and submitted, and Spark's own capability check refuses a plain
    parquet table - the error must come from Spark, not from our code."""
    name = "keelson_merge_probe"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} (id BIGINT, name STRING) USING parquet "
              f"LOCATION '{tmp}/t'")
    target = CatalogTarget(spark, name, ["id"])
    ch = spark.createDataFrame([(1, "I", 1, "a"), (2, "D", 2, None)],
                               "_seq long, _op string, id long, name string")
    with pytest.raises(Exception) as err:
        target.write_batch(ch, 0)
    assert "MERGE" in str(err.value).upper()


def test_catalog_target_seed_once(spark, tmp):
    name = "keelson_seed_probe"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} (id BIGINT, name STRING) USING parquet "
              f"LOCATION '{tmp}/s'")
    t = CatalogTarget(spark, name, ["id"])
    snap = spark.createDataFrame([(1, "a"), (2, "b")], "id long, name string")
    assert t.seed(snap) is True
    assert t.seed(snap) is False
    assert t.current().count() == 2
    assert [f.name for f in t.schema.fields] == ["id", "name"]
