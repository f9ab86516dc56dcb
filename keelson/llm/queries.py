"""Registered queries of the text operators, one for each operator.

Each applies its operator to the whole ``documents`` table and derives the
digest columns of its result from the operator's real output.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keelson.llm import (byte_bpe, leaks, licenses, lines, merge_replay, near, phrases, pieces,
                         quality, runs, substrings, token_count, toxicity, wavelet)
from keelson.llm.common import id_text, table

MAX_TOKENS = 2048


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = pieces.PieceModel(public_tokenizers.path("piece_bpe_32k.model"))
    return pieces.digests(table(spark, sf_dir, "documents"), model)


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = token_count.WholeTokens(public_tokenizers.path("word_bpe_49k.json"))
    docs = id_text(table(spark, sf_dir, "documents"))
    docs = docs.withColumn("n_bytes", F.octet_length("text").cast("long"))
    out = token_count.count_tokens(docs, facts)
    return out.select("doc_id", "n_bytes", "n_tokens",
                      (F.col("n_tokens") > MAX_TOKENS).alias("over_limit"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substrings.remove_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


OP4_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
                  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws
           FROM documents),
w AS (SELECT r, doc_id, i, array_to_string(ws[i:i + 12], ' ') AS s
      FROM (SELECT r, doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM d)),
m AS (SELECT s, min(doc_id) AS least FROM w GROUP BY s),
gone AS (SELECT DISTINCT r, unnest(range(i, i + 13)) AS i FROM w JOIN m USING (s)
         WHERE doc_id > least),
word AS (SELECT r, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS i FROM d),
kept AS (SELECT r, string_agg(word, ' ' ORDER BY i) AS t, count(*) AS n
         FROM word ANTI JOIN gone USING (r, i) GROUP BY r)
SELECT doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id", toxicity.held_out().alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lines.remove(id_text(table(spark, sf_dir, "documents")), bounds=lines.BOUNDS)
    return out.select("doc_id", "n_lines", "n_removed", "n_near",
                      F.sha2("text", 256).alias("kept_sha256"))


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.classes(table(spark, sf_dir, "documents"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op10_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = byte_bpe.BpeFile(public_tokenizers.path("byte_bpe_50k.json"))
    manifest = wavelet.write_shards(table(spark, sf_dir, "documents"), facts,
                                    wavelet.shard_folder(spark))
    return wavelet.read_documents(spark, manifest)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = runs.with_echo(id_text(table(spark, sf_dir, "documents")))
    return runs.summary(runs.runs(docs))


def op12_merge_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = merge_replay.Vocabulary(
        public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    return merge_replay.digests(table(spark, sf_dir, "documents"), facts)


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_quality": op1_quality,
    "op2_sentencepiece": op2_sentencepiece,
    "op3_token_counts": op3_token_counts,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_decontamination": op5_decontamination,
    "op6_toxicity": op6_toxicity,
    "op7_line_dedup": op7_line_dedup,
    "op8_near_duplicates": op8_near_duplicates,
    "op9_license_scan": op9_license_scan,
    "op10_token_shards": op10_token_shards,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_merge_replay": op12_merge_replay,
    "op13_collocations": op13_collocations,
}
ORACLES: dict[str, str] = {
    "op4_substring_dedup": OP4_SQL,
    "op9_license_scan": licenses.scan_sql(),
    "op13_collocations": phrases.collocations_sql(),
}
