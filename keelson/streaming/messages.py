"""Replicate from captured messages (S4 + T1): a stream of landed message
files decoded and applied batch by batch.

A relation message can arrive many batches before the rows that need it,
so each batch first appends its relation messages to a relation table
(``<relations>/batch_id=N``, overwritten on replay), and rows are decoded
against every relation seen so far.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType
from pyspark.sql.utils import AnalysisException

from ..sources.messages import (collect_versions, decode_messages,
                                parse_relations)
from ..session import scratch_path
from .replicate import replicate


class RelationTable:
    """Relation messages seen so far, stored under ``path`` (one directory
    per batch that carried any) and kept, as materialised versions, in
    the driver between batches. A restarted driver rebuilds them from the
    stored table on its first batch."""

    def __init__(self, path: str, tables: list[str] | None = None):
        self.path = path
        self.tables = tables
        self.versions: DataFrame | None = None

    def update(self, batch: DataFrame, batch_id: int) -> DataFrame:
        spark = batch.sparkSession
        new = parse_relations(batch)
        if self.tables is not None:
            known = (F.col("name").isin(self.tables)
                     | F.concat_ws(".", "namespace", "name").isin(self.tables))
            bad = [f"{r.namespace}.{r.name}" for r in
                   new.where(~known).select("namespace", "name").distinct().limit(5).collect()]
            if bad:
                raise ValueError(f"relation for an unknown table: {bad}")
        announced = not new.isEmpty()
        if announced:
            # Replays overwrite the same directory.
            new.write.mode("overwrite").parquet(
                os.path.join(self.path, f"batch_id={batch_id}"))
        try:
            rels = spark.read.parquet(self.path).drop("batch_id")
        except AnalysisException:
            rels = new.limit(0)
        if announced or self.versions is None:
            self.versions = collect_versions(rels)
        return rels


def decode_batch(batch: DataFrame, batch_id: int, schema: StructType,
                 relations: RelationTable, table: str | None = None,
                 keys: list[str] | None = None, namespace: str | None = None) -> DataFrame:
    """Decode one micro-batch against every relation seen so far."""
    rels = relations.update(batch, batch_id)
    return decode_messages(batch, schema, table=table, keys=keys, relations=rels,
                           versions=relations.versions, namespace=namespace)


def replicate_messages(feed: DataFrame, target, keys: list[str],
                       schema: StructType, table: str | None = None,
                       relations_path: str | None = None,
                       tables: list[str] | None = None,
                       namespace: str | None = None, **kwargs) -> StreamingQuery:
    """``feed``: a stream of (system_id, _seq, _lsn, payload) rows.
    ``table`` (and ``namespace``): the relation whose rows go to ``target``;
    ``tables``: every table the feed may name, as ``name`` or
    ``namespace.name`` (others fail the batch). ``relations_path``: where
    relation messages are kept; by default beside a file target, or below
    the stream's checkpoint."""
    checkpoint = kwargs.pop("checkpoint", None) or scratch_path(feed.sparkSession, "streams")
    relations_path = relations_path or os.path.join(
        getattr(target, "path", checkpoint), "relations")
    if tables is None and table is not None:
        tables = [f"{namespace}.{table}" if namespace else table]
    rel_table = RelationTable(relations_path, tables)
    return replicate(
        feed, target, keys, schema=schema, checkpoint=checkpoint,
        transform=lambda b, i: decode_batch(b, i, schema, rel_table, table, keys, namespace),
        **kwargs)
