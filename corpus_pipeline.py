"""Corpus pipeline: five stages over ``documents``, each one text operator.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet in the shared folder and read again as the next stage's
``docs``. All but the last return the columns of ``documents`` (and any other
column that ``docs`` has); ``n_chars`` follows the text where a stage edits it.

toxicity            documents with a score of 0.5 or more go
line_dedup          lines that repeat an earlier line go; a document whose
                    every line went, goes
near_dedup          of each group of near-duplicates one document stays
decontamination     documents with a passage of a benchmark item go
sentencepiece       ids and decoded text of what is left, as digests
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keelson.llm import leaks, lines, near, pieces, toxicity
from keelson.llm.common import free_name, persisted, table

TOXIC = 0.5


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below ``TOXIC``. NULL and empty texts stay.

    The model learns from the labelled rows of the stored table.
    """
    model = toxicity.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    score = free_name(docs.columns, "__toxicity")
    return toxicity.scored(docs, model, score).where(
        (F.col(score) < TOXIC) | (F.length(F.coalesce("text", F.lit(""))) == 0)).drop(score)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without their repeated lines; documents left without a line go."""
    own = {c: free_name(docs.columns, f"__{c}") for c in ("n_lines", "n_removed", "n_near")
           if c in docs.columns}
    docs = docs.withColumnsRenamed(own)
    out = lines.remove(docs, bounds=lines.BOUNDS)
    empty = (F.col("n_removed") > 0) & (F.trim("text", F.lit(" \t\n\x0b\x0c\r")) == "")
    out = out.where(~F.coalesce(empty, F.lit(False)))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(
            F.col("n_removed") > 0, F.char_length("text").cast(kind)).otherwise(F.col("n_chars")))
    out = out.drop("n_lines", "n_removed", "n_near")
    return out.withColumnsRenamed({new: c for c, new in own.items()})


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates."""
    return near.keep_one(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of a benchmark item."""
    return leaks.clean(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and the digests of the ids and of the decoded text."""
    model = pieces.PieceModel(public_tokenizers.path("piece_bpe_32k.model"))
    return pieces.digests(docs, model)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", dedup_lines),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_leaks),
    ("sentencepiece", encode),
]

#: The stages that score, link and encode cannot be said in SQL; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = persisted(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
