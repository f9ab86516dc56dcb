"""Snapshot readers.

A snapshot seeds the target once. Sources: any Spark reader (parquet, orc,
csv, a catalog table), a JDBC table split by a numeric column, or a dump
in COPY text format.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.copytext import decode_fields, encode_line, field_count
from ..operators.partitioning import spread


def read_snapshot(spark: SparkSession, source: str, fmt: str = "parquet",
                  schema: StructType | None = None, **options) -> DataFrame:
    """Read a whole table once.

    ``fmt='table'`` reads a catalog table, ``fmt='copy'`` a COPY text dump,
    ``fmt='jdbc'`` a database table - pass ``partitionColumn``,
    ``lowerBound``, ``upperBound`` and ``numPartitions`` so the read is
    split across tasks instead of one connection pulling everything.
    """
    if fmt == "table":
        return spark.table(source)
    if fmt == "copy":
        if schema is None:
            raise ValueError("a COPY text snapshot needs the target schema")
        return read_copy_text(spark, source, schema, **options)
    if fmt == "jdbc":
        reader = spark.read.format("jdbc").option("dbtable", source)
        for k, v in options.items():
            reader = reader.option(k, v)
        return reader.load()
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load(source)


def copy_lines_to_rows(lines: DataFrame, schema: StructType,
                       line_col: str = "value", delimiter: str = ",",
                       strict: bool = True, partitions: int | None = None) -> DataFrame:
    """COPY text lines -> typed rows, columns in the target's order.

    ``strict`` casts with ``CAST`` (bad text fails the job) and fails on a
    line with more or fewer fields than the schema; otherwise ``try_cast``
    (bad text becomes NULL), and such lines are dropped - ``rejected_lines``
    returns them. ``partitions``: deal the lines over so many tasks first.
    """
    n = len(schema.fields)
    line = F.col(line_col)
    fits = field_count(line, delimiter) == n
    source = spread(lines, partitions)
    if strict:
        line = F.when(fits, line).when(line.isNotNull(), F.raise_error(F.concat(
            F.lit(f"COPY line without {n} fields: "), F.substring(line, 1, 200))))
    else:
        source = source.where(fits)
    out = []
    for f, c in zip(schema.fields, decode_fields(line, n, delimiter)):
        typed = c.cast(f.dataType) if strict else c.try_cast(f.dataType)
        out.append(typed.alias(f.name))
    keep = [c for c in lines.columns if c != line_col]
    return source.select(*keep, *out)


def rejected_lines(lines: DataFrame, schema: StructType, line_col: str = "value",
                   delimiter: str = ",") -> DataFrame:
    """The lines whose number of fields is not the schema's."""
    return lines.where(field_count(F.col(line_col), delimiter) != len(schema.fields))


def read_copy_text(spark: SparkSession, path: str, schema: StructType,
                   delimiter: str = ",", strict: bool = True,
                   partitions: int | None = None) -> DataFrame:
    """Read a COPY text dump. Lines end with ``\\n`` only; embedded newlines
    are escaped, so a split file is still cut at row boundaries."""
    lines = spark.read.option("lineSep", "\n").text(path)
    return copy_lines_to_rows(lines, schema, "value", delimiter, strict, partitions)


def to_copy_lines(df: DataFrame, delimiter: str = ",", name: str = "value"
                  ) -> DataFrame:
    """Rows -> COPY text lines (the inverse of ``copy_lines_to_rows``)."""
    return df.select(encode_line([F.col(c) for c in df.columns], delimiter)
                             .alias(name))


def write_copy_text(df: DataFrame, path: str, delimiter: str = ",",
                    mode: str = "errorifexists") -> None:
    to_copy_lines(df, delimiter).write.mode(mode).option("lineSep", "\n").text(path)
