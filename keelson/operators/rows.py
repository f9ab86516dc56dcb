"""Row cleaning before an apply: required fields, cast to the target
schema, duplicate keys, typed parse (F3 F4 F5 F6 O4 S7 S8)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .changes import META, net_changes

UNCHANGED = "_unchanged"
MOVED_FROM = "_from"


def ddl(schema: StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}"
                     for f in schema.fields)


def required_fields(schema: StructType, keys: Sequence[str] | None = None
                    ) -> list[str]:
    """Fields the target marks NOT NULL; with none, the key fields."""
    req = [f.name for f in schema.fields if not f.nullable]
    return req if req else list(keys or [])


def required_condition(rows: DataFrame, fields: Sequence[str],
                       mode: str = "all", unchanged_ok: bool = False) -> Column:
    """The row condition ``require`` filters on."""
    fields = list(fields)
    if not fields:
        return F.lit(True)
    if unchanged_ok and UNCHANGED in rows.columns:
        checks = [F.col(f).isNotNull() |
                  F.coalesce(F.array_contains(F.col(UNCHANGED), F.lit(f)),
                             F.lit(False)) for f in fields]
    else:
        checks = [F.col(f).isNotNull() for f in fields]
    if mode == "all":
        return reduce(lambda a, b: a & b, checks)
    if mode == "any":
        return reduce(lambda a, b: a | b, checks)
    raise ValueError(f"unknown mode {mode!r}")


def require(rows: DataFrame, fields: Sequence[str], mode: str = "all",
            unchanged_ok: bool = False) -> DataFrame:
    """Drop rows missing required fields.

    ``mode='all'``: every required field must be set (what a NOT NULL
    column needs). ``mode='any'``: keep a row when at least one is set,
    which is what the reference's filter does. With ``unchanged_ok``, a
    field the change marks unchanged (``_unchanged``) keeps its earlier
    value and so counts as set.
    """
    if not list(fields):
        return rows
    return rows.where(required_condition(rows, fields, mode, unchanged_ok))


def conform(rows: DataFrame, schema: StructType, mode: str = "strict",
            keep_meta: bool = True) -> DataFrame:
    """Cast every target column to the target type.

    ``strict`` uses ``CAST`` (ANSI: bad text fails the job). ``try`` uses
    ``try_cast`` and adds ``_rejected`` - true when a non-NULL input
    became NULL - so the caller can split off a rejects table with one
    filter instead of a second pass. Columns the rows lack become NULL.
    """
    have = set(rows.columns)
    cols: list[Column] = []
    if keep_meta:
        cols += [F.col(c) for c in (*META, UNCHANGED, MOVED_FROM) if c in have]
    bad: list[Column] = []
    for f in schema.fields:
        if f.name not in have:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        src = F.col(f.name)
        if mode == "strict":
            cols.append(src.cast(f.dataType).alias(f.name))
        elif mode == "try":
            cast = src.try_cast(f.dataType)
            cols.append(cast.alias(f.name))
            bad.append(src.isNotNull() & cast.isNull())
        else:
            raise ValueError(f"unknown mode {mode!r}")
    if mode == "try":
        flag = reduce(lambda a, b: a | b, bad) if bad else F.lit(False)
        cols.append(flag.alias("_rejected"))
    return rows.select(*cols)


def duplicate_keys(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    keys = list(keys)
    return (rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") > 1))


def check_duplicates(rows: DataFrame, keys: Sequence[str], mode: str = "error"
                     ) -> DataFrame:
    """Make a batch safe for an upsert: one row per key.

    ``error`` raises when a key repeats (one bounded probe job: stops at
    the first duplicate); ``latest`` keeps the last change per key.
    """
    if mode == "latest":
        return net_changes(rows, keys)
    if mode == "error":
        dup = duplicate_keys(rows, keys).limit(1).collect()
        if dup:
            raise ValueError(f"duplicate key in batch: {dup[0].asDict()}")
        return rows
    raise ValueError(f"unknown mode {mode!r}")


def typed_parse(lines: DataFrame, schema: StructType, line_col: str = "value",
                names: Sequence[str] | None = None, mode: str = "PERMISSIVE",
                sep: str = ",") -> DataFrame:
    """Parse delimited text with an explicit schema - never inferred.

    ``names`` are the announced column names; without them the target's
    names are used in order (S8). ``PERMISSIVE`` turns unparsable values
    into NULL (then dropped by ``require``); ``FAILFAST`` raises.
    """
    target_names = [f.name for f in schema.fields]
    names = list(names) if names else target_names
    by_name = {f.name: f for f in schema.fields}
    text_schema = StructType([by_name.get(n, StructField(n, StringType()))
                              for n in names])
    parsed = F.from_csv(F.col(line_col), ddl(text_schema),
                        {"sep": sep, "mode": mode})
    keep = [c for c in lines.columns if c in META]
    out = lines.select(*keep, parsed.alias("_r"))
    return out.select(*keep, *[F.col(f"_r.{n}").alias(n) for n in names])


def positional_names(df: DataFrame, schema: StructType, skip: Sequence[str] = ()
                     ) -> DataFrame:
    """Rename unnamed columns to the target's names in order."""
    data = [c for c in df.columns if c not in skip]
    names = [f.name for f in schema.fields]
    if len(data) != len(names):
        raise ValueError(f"{len(data)} columns for a {len(names)}-column target")
    return df.select(*[F.col(c) for c in skip],
                     *[F.col(a).alias(b) for a, b in zip(data, names)])
