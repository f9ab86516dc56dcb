import os

from pyspark.sql.types import LongType, StringType, StructField, StructType

from keelson.sources.snapshot import (copy_lines_to_rows, read_copy_text,
                                      to_copy_lines, write_copy_text)

NASTY = [None, "", "\\N", "\\", "a\\", "\\\\", "a,b", "a\\,b", "x\ny", "t\tab",
         "cr\rlf\n", "\x01", "\x02", "\x02a\x02b\x02c\x01", "\\x02c", "\b\f\v",
         ",,,", "é中文", "\\n literal"]
SCHEMA = StructType([StructField("k", LongType()), StructField("s", StringType())])


def _rows(spark):
    return spark.createDataFrame([(i, s) for i, s in enumerate(NASTY)], SCHEMA)


def test_round_trip_in_memory(spark):
    df = _rows(spark)
    back = copy_lines_to_rows(to_copy_lines(df), SCHEMA)
    assert sorted(map(tuple, back.collect()), key=lambda r: r[0]) == \
        [(i, s) for i, s in enumerate(NASTY)]


def test_round_trip_through_files(spark, tmp):
    path = os.path.join(tmp, "dump")
    write_copy_text(_rows(spark), path)
    back = read_copy_text(spark, path, SCHEMA)
    assert sorted(map(tuple, back.collect()), key=lambda r: r[0]) == \
        [(i, s) for i, s in enumerate(NASTY)]


def test_encoding_matches_copy_format(spark):
    df = spark.createDataFrame([(1, "a,b\\c\nd"), (2, None)], SCHEMA)
    lines = sorted(r[0] for r in to_copy_lines(df).collect())
    assert lines == ["1,a\\,b\\\\c\\nd", "2,\\N"]


def test_documents_round_trip(spark, tmp):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    path = os.path.join(tmp, "docs")
    write_copy_text(docs, path)
    back = read_copy_text(spark, path, docs.schema)
    assert back.exceptAll(docs).count() == 0 and docs.exceptAll(back).count() == 0
