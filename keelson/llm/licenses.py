"""Operator 9 [native]: license scans by an exact set-similarity join.

Base rules: places where the words of a phrase stand consecutively.

Method: a text block (a line, by default) matches a notice template when it
holds at least ``threshold`` of the template's distinct words. All such pairs
are found, by a prefix-filtered join:

* words outside every template cannot count, so blocks are first reduced to
  template words (bounded by the templates, a parameter, not by the data);
* words are put in one global order, rare in the corpus first;
* for a template of m words that needs o of them, two sets that share o words
  share one among the template's first m-o+1 and the block's first n-o+1
  (prefix filter); blocks with n < o are out (length filter), and a first
  shared word at places i and j leaves room for min(n-i, m-j) words
  (positional filter);
* the few candidates are verified by the exact overlap.

DataFrame functions only. The template table is small by construction, so it
is broadcast; documents are never shuffled with their text, only narrow rows
keyed by (doc_id, hash of the text) are.

NULL and empty texts: no words, no labels, score 0. Repeated rows each get
their result. Texts that contain a phrase or template several times count all
places.
"""

from __future__ import annotations

import math
import re
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelson.llm.common import id_text, persisted

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A word once A-Z are lower-cased; and the same in a text as it is.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]"
RAW_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"

#: Phrase -> label of the base rules.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

#: Label -> public license notices looked for by the method.
TEMPLATES = [
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not '
                   "use this file except in compliance with the License. You may obtain a copy "
                   "of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, "
            "are permitted provided that the following conditions are met"),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International "
                  "License."),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-3.0", "This program is free software: you can redistribute it and/or modify it under "
                "the terms of the GNU General Public License as published by the Free Software "
                "Foundation, either version 3 of the License, or (at your option) any later "
                "version."),
    ("mit-notice", "Released under the MIT License."),
    ("mit-notice", "Permission is hereby granted, free of charge, to any person obtaining a copy "
                   "of this software and associated documentation files (the Software), to deal "
                   "in the Software without restriction"),
]
THRESHOLD = 0.8


def template_words(text: str) -> list[str]:
    """Distinct words of a template, sorted."""
    low = text.translate(str.maketrans(UPPER, LOWER))
    return sorted(set(re.findall(WORD + "+", low)))


def needed(m: int, threshold: float) -> int:
    return max(1, math.ceil(round(threshold * m, 9)))


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(f"({WORD}+)"))


def _stands(parts: list[str]):
    """Whether the parts stand consecutively from word i."""
    def here(i):
        # get() gives NULL behind the last word, and NULL is no match
        return reduce(and_, [F.get("words", i + k) == p for k, p in enumerate(parts)])
    return here


def base_rules(docs: DataFrame, phrases: dict[str, str] = PHRASES) -> DataFrame:
    """doc_id, text hash, n_words and the places of the phrases in each text.

    Only texts that hold some phrase (one regular expression) are cut into a
    list of words; the others just get their words counted.
    """
    gap = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    any_phrase = "(?i)(" + "|".join(gap.join(p.split()) for p in phrases) + ")"
    marked = docs.select(
        "doc_id", F.xxhash64("text").alias("h"),
        F.regexp_count("text", F.lit(RAW_WORD + "+")).cast("long").alias("n_words"),
        F.when(F.col("text").rlike(any_phrase), words_of(F.col("text"))).alias("words"))
    found = []
    for phrase in phrases:
        starts = F.sequence(F.lit(0), F.greatest(F.size("words") - 1, F.lit(0)))
        found.append(F.filter(starts, _stands(phrase.split())))
    placed = marked.select(
        "doc_id", "h", "n_words",
        *[F.when(F.col("words").isNotNull(), f).alias(f"p{k}") for k, f in enumerate(found)])
    cols = [F.coalesce(F.col(f"p{k}"), F.array().cast("array<int>")) for k in range(len(phrases))]
    labels = F.array_compact(F.array(*[
        F.when(F.size(c) > 0, F.lit(label)) for c, label in zip(cols, phrases.values())]))
    places = F.concat(*cols)
    return placed.select(
        "doc_id", "h", "n_words", F.size(places).cast("long").alias("n_base"),
        F.array_min(places).cast("long").alias("first_word"),
        F.array_max(places).cast("long").alias("last_word"),
        F.array_sort(F.array_distinct(labels)).alias("base"))


def template_matches(docs: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD,
                     block_break: str = "\n") -> DataFrame:
    """(doc_id, h, block, template, label, overlap, containment) of all pairs
    of a text block and a template at or above the threshold."""
    spark = docs.sparkSession
    sets = [(k, label, template_words(text)) for k, (label, text) in enumerate(templates)]
    sets = [(k, label, ws, needed(len(ws), threshold)) for k, label, ws in sets if ws]
    least = min(o for *_, o in sets)
    vocabulary = sorted({w for _, _, ws, _ in sets for w in ws})
    blocks = (docs.select("doc_id", F.xxhash64("text").alias("h"),
                          F.posexplode(F.split("text", block_break, -1)).alias("block", "line"))
              .select("doc_id", "h", "block",
                      F.array_intersect(words_of(F.col("line")),
                                        F.array(*map(F.lit, vocabulary))).alias("words"))
              .where(F.size("words") >= least))
    blocks = persisted(blocks, "license-blocks")
    # one row for each template word at most
    counts = {r["w"]: r["n"] for r in
              blocks.select(F.explode("words").alias("w")).groupBy("w")
              .agg(F.count("*").alias("n")).collect()}
    order = sorted(vocabulary, key=lambda w: (counts.get(w, 0), w))
    rank = {w: i for i, w in enumerate(order)}
    prefixes = [(w, k, label, j, len(ws), o, ws)
                for k, label, words, o in sets
                for ws in [sorted(words, key=rank.__getitem__)]
                for j, w in enumerate(ws[:len(ws) - o + 1])]
    table = spark.createDataFrame(
        prefixes, "token string, template int, label string, j int, m int, o int, "
                  "template_words array<string>")
    ranked = blocks.select("doc_id", "h", "block",
                           F.array_intersect(F.array(*map(F.lit, order)), "words").alias("words"),
                           F.size("words").alias("n"))
    probes = ranked.select("*", F.posexplode(
        F.slice("words", F.lit(1), F.col("n") - (least - 1))).alias("i", "token"))
    pairs = (probes.join(F.broadcast(table), "token")
             .where("n >= o and i <= n - o and least(n - i, m - j) >= o")
             .withColumn("overlap", F.size(F.array_intersect("words", "template_words")))
             .where("overlap >= o"))
    return pairs.select("doc_id", "h", "block", "template", "label", "overlap",
                        (F.col("overlap") / F.col("m")).alias("containment"))


def scan(docs: DataFrame, phrases: dict[str, str] = PHRASES, templates=TEMPLATES,
         threshold: float = THRESHOLD) -> DataFrame:
    """One row for each row of ``docs``: base rules and the method's labels."""
    docs = id_text(docs)
    found = (template_matches(docs, templates, threshold)
             .groupBy("doc_id", "h")
             .agg(F.collect_set("label").alias("found"),
                  F.max("containment").alias("containment")))
    base = base_rules(docs, phrases)
    joined = base.join(
        found.select(F.col("doc_id").alias("other"), F.col("h").alias("other_h"),
                     "found", "containment"),
        F.col("doc_id").eqNullSafe(F.col("other")) & (F.col("h") == F.col("other_h")), "left")
    none = F.array().cast("array<string>")
    return joined.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join("base", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", F.coalesce("found", none))), ",")
        .alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("containment", F.lit(0.0)))
        .alias("score"))


def scan_sql(phrases: dict[str, str] = PHRASES, templates=TEMPLATES,
             threshold: float = THRESHOLD) -> str:
    """DuckDB SQL for ``scan``: every block against every template."""
    q = lambda s: "'" + s.replace("'", "''") + "'"
    low = f"translate(t, '{UPPER}', '{LOWER}')"
    places = " UNION ALL ".join(
        f"SELECT r, {q(label)} AS label, i - 1 AS p FROM wi WHERE "
        + " AND ".join(f"ws[i + {k}] = {q(w)}" for k, w in enumerate(phrase.split()))
        for phrase, label in phrases.items())
    rows = ", ".join(
        f"({q(label)}, [{', '.join(map(q, ws))}], {needed(len(ws), threshold)})"
        for label, ws in ((label, template_words(text)) for label, text in templates))
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, doc_id, t, regexp_extract_all({low}, '{WORD}+') AS ws FROM d),
wi AS (SELECT r, ws, unnest(range(1, len(ws) + 1)) AS i FROM w),
hits AS ({places}),
base AS (SELECT r, count(*) AS n, min(p) AS a, max(p) AS b, list(DISTINCT label) AS ls
         FROM hits GROUP BY r),
tpl(label, tw, o) AS (VALUES {rows}),
line AS (SELECT r, list_distinct(regexp_extract_all({low.replace('(t,', '(l,')}, '{WORD}+')) AS bw
         FROM (SELECT r, unnest(string_split(t, chr(10))) AS l FROM d)),
hit AS (SELECT r, label, len(list_intersect(bw, tw)) AS k, len(tw) AS m, o
        FROM line, tpl WHERE len(bw) >= o),
m AS (SELECT r, list(DISTINCT label) AS ls, max(k::DOUBLE / m::DOUBLE) AS c
      FROM hit WHERE k >= o GROUP BY r)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_base,
       a::BIGINT AS first_word, b::BIGINT AS last_word,
       coalesce(list_aggregate(list_sort(base.ls), 'string_agg', ','), '') AS base_labels,
       coalesce(list_aggregate(list_sort(list_distinct(
           coalesce(base.ls, []::VARCHAR[]) || coalesce(m.ls, []::VARCHAR[]))),
           'string_agg', ','), '') AS labels,
       CASE WHEN n > 0 THEN 1.0::DOUBLE ELSE coalesce(c, 0)::DOUBLE END AS score
FROM w LEFT JOIN base USING (r) LEFT JOIN m USING (r)
"""
