"""Routing a change feed."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .changes import DELETE, INSERT, OP, SEQ, UPDATE


def route_by_op(changes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(append side, delete side): I/U rows and D rows (F1).

    Anything else in ``_op`` (transaction markers, keep-alives) belongs to
    neither side.
    """
    appends = changes.where(F.col(OP).isin(INSERT, UPDATE))
    deletes = changes.where(F.col(OP) == DELETE)
    return appends, deletes


def read_from_position(changes: DataFrame, position: int) -> DataFrame:
    """Changes strictly after a feed position (S10); pushed to the scan."""
    return changes.where(F.col(SEQ) > F.lit(position))


def unknown_tables(changes: DataFrame, tables: Iterable[str],
                   table_col: str = "_table") -> DataFrame:
    """Distinct table names in the feed that are not being replicated. The
    table list is the job's configuration, so it is a literal ``IN`` list;
    distinct aggregates partially, so the probe moves one row per name and
    input split."""
    known = F.col(table_col).isin(list(tables))
    return (changes.select(table_col).where(~known | F.col(table_col).isNull())
            .distinct())


def route_by_table(changes: DataFrame, tables: Iterable[str],
                   table_col: str = "_table", strict: bool = True
                   ) -> dict[str, DataFrame]:
    """Split a multi-table feed by table (F2).

    ``strict`` fails when the feed names a table outside the list; the
    probe reads the distinct table names only, never the rows.
    """
    tables = list(tables)
    if strict:  # one bounded probe job
        bad = unknown_tables(changes, tables, table_col).limit(5).collect()
        if bad:
            raise ValueError(f"feed names unknown tables: "
                             f"{[r[0] for r in bad]}")
    return {t: changes.where(F.col(table_col) == F.lit(t)) for t in tables}


def check_source_identity(feed: DataFrame, expected: str | None,
                          col: str = "system_id") -> str:
    """The feed must come from one source system, the one resumed from.

    Returns the system id. Raises when the feed mixes systems or the id
    differs from ``expected`` (the id kept in the ledger).
    """
    ids = [r[0] for r in feed.select(col).distinct().limit(2).collect()]
    if len(ids) > 1:
        raise ValueError(f"feed mixes source systems: {ids}")
    if not ids:
        return expected or ""
    if expected is not None and ids[0] != expected:
        raise ValueError(f"source system changed: {expected!r} -> {ids[0]!r}")
    return ids[0]
