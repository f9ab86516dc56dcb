"""Phrase collocations by stripes: prefix -> counter of next words.

1. Texts become slices: for each language of a task's texts the words as
   numbers, -1 between pieces, and the distinct words with their counts. Word
   totals of the corpus are summed from the distinct words only.
2. The distinct words of all slices are dealt by word, once: equal words are
   summed there, and those that occur ``LEAST`` times or more get an id, which
   goes back to each slice and replaces the slice's number. A rarer word is in
   no candidate, so it parts the text like a piece's end.
3. From each place of a slice goes the window of the (up to) five words from
   there on, equal windows as one with a count, packed into a blob for each
   bucket. A bucket holds the stripes of its prefixes: windows are grouped by
   their first two words, then three, four and five; a prefix below ``LEAST``
   takes its windows along.
4. Stripes of hot prefixes are split: while all words so far occur more than
   ``BUCKET`` times, the next word takes part in the choice of the bucket. So
   no key brings more than ``BUCKET`` windows to one bucket, and only phrases
   made of hot words come from several buckets; their counts are summed
   afterwards.
5. The stripes give the counts of all candidates and of their parts (prefix
   totals), and the largest count among one-word extensions at either end,
   which decides whether a longer candidate takes a phrase in: f never grows
   with an extension, so one word more is enough to look at.

Texts: NULL counts as empty; a NULL language is ``und``. Repeated rows count
again. Other columns of the input are never looked at. An empty table gives no
phrases. Memory follows ``SLICE`` bytes of text (or the longest text) in the
first step and ``BUCKET`` windows in the third.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keelson.llm.common import persisted, slices, text_bytes
from keelson.llm.vectors import mix

LEAST = 100
WORDS = 5
TOP = 2000
#: A word that occurs more often is hot: no key brings more windows to a bucket.
BUCKET = 500_000
#: Buckets for each ``BUCKET`` words, so that tasks get about equal shares.
SHARES = 5
#: Text bytes whose distinct words are counted together.
SLICE = 16 << 20
#: Parts of the words; each is summed and numbered by itself.
WORD_PARTS = 4096
#: Parts of a language that are ranked before the last ranking.
RANK_PARTS = 64

CODED = "slice long, lang string, codes binary, local int, word string, n long"

WORD, BLANK, BREAK = range(3)
KIND = np.zeros(256, np.uint8)
KIND[[0x20, 0x09]] = BLANK
KIND[list(b".,;:!?\n\x0b\x0c\r")] = BREAK
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def coded(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """(number of each word in the distinct words, -1 before each new piece;
    the distinct words)."""
    offsets, raw = text_bytes(texts)
    raw = LOWER[raw[offsets[0]:offsets[-1]]]
    n = len(raw)
    kind = KIND[raw]
    texts = offsets[:-1] - offsets[0]
    edge = np.zeros(n + 1, bool)
    edge[texts] = True
    edge = edge[:n]
    solid = kind == WORD
    begin, stop = solid.copy(), solid.copy()
    begin[1:] &= ~solid[:-1] | edge[1:]
    stop[:-1] &= ~solid[1:] | edge[1:]
    start, end = np.flatnonzero(begin), np.flatnonzero(stop) + 1
    del begin, stop
    at = np.zeros(len(start) + 1, np.int64)
    np.cumsum(end - start, out=at[1:])
    # words are the runs of solid bytes, so these are their bytes in order
    words = pa.Array.from_buffers(pa.large_string(), len(start), [
        None, pa.py_buffer(at), pa.py_buffer(raw[solid])])
    words = words.dictionary_encode()
    # texts and breaks up to each word; a number for each byte would take eight times the text
    piece = (np.searchsorted(texts, start, side="right")
             + np.searchsorted(np.flatnonzero(kind == BREAK), start))
    apart = np.cumsum(np.append(False, np.diff(piece) > 0)[:len(start)])
    out = np.full(len(start) + int(apart[-1] if len(apart) else 0), -1, np.int32)
    out[np.arange(len(start)) + apart] = words.indices.to_numpy(zero_copy_only=False)
    return out, words.dictionary


def _slice_rows(most: int):
    schema = pa.schema([("slice", pa.int64()), ("lang", pa.string()), ("codes", pa.large_binary()),
                        ("local", pa.int32()), ("word", pa.large_string()), ("n", pa.int64())])

    def flush(held, begin):
        both = pa.Table.from_batches(held).combine_chunks()
        lang = both.column("lang").combine_chunks().dictionary_encode()
        for k, name in enumerate(lang.dictionary.to_pylist()):
            rows = pa.array(np.flatnonzero(lang.indices.to_numpy(zero_copy_only=False) == k))
            texts = both.column("text").combine_chunks().cast(pa.large_string()).take(rows)
            codes, words = coded(texts)
            m, here = len(words), begin + k
            yield pa.RecordBatch.from_arrays([
                pa.array([here]), pa.array([name]), pa.array([codes.tobytes()], pa.large_binary()),
                pa.nulls(1, pa.int32()), pa.nulls(1, pa.large_string()), pa.nulls(1, pa.int64())],
                schema=schema)
            counts = np.bincount(codes[codes >= 0], minlength=m)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(m, here)), pa.array([name] * m, pa.string()),
                pa.nulls(m, pa.large_binary()), pa.array(np.arange(m, dtype=np.int32)),
                words, pa.array(counts.astype(np.int64))], schema=schema)

    def work(batches):
        begin = TaskContext.get().partitionId() << 40
        held, size = [], 0
        for part in slices(batches, most=most):
            held.append(part)
            offsets, _ = text_bytes(part.column("text"))
            size += int(offsets[-1] - offsets[0])
            if size >= most:
                yield from flush(held, begin)
                begin += sum(p.num_rows for p in held)
                held, size = [], 0
        if held:
            yield from flush(held, begin)
    return work


def numbered(distinct: DataFrame, least: int = LEAST) -> DataFrame:
    """slice, local, f, id, lang, word: the rows of ``distinct`` (slice, local, lang, word, n)
    whose word occurs ``least`` times or more in its language.

    ``f`` is that count and ``id`` the word's number, about dense. Words are dealt once by their
    hash; there the sorted rows are summed and numbered in place, so nothing is looked up. Only
    the first row of a word carries ``lang`` and ``word``.
    """
    part = F.pmod(F.xxhash64("lang", "word"), F.lit(WORD_PARTS))
    dealt = distinct.select("slice", "local", "lang", "word", "n", part.alias("part")).repartition("part")
    sums = dealt.withColumn("f", F.sum("n").over(Window.partitionBy("part", "lang", "word")))
    order = Window.partitionBy("part").orderBy("lang", "word")
    first = F.row_number().over(order) == F.rank().over(order)
    ranks = sums.where(F.col("f") >= least).select(
        "slice", "local", "f", "part", F.dense_rank().over(order).cast("long").alias("rank"),
        "lang", "word", first.alias("first"))
    return ranks.select("slice", "local", "f",
                        ((F.col("rank") - 1) * WORD_PARTS + F.col("part")).alias("id"),
                        F.when(F.col("first"), F.col("lang")).alias("lang"),
                        F.when(F.col("first"), F.col("word")).alias("word"))


def windows(codes: np.ndarray, ids: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """(columns of the distinct windows of two to ``WORDS`` words, sorted; counts).

    ``ids``: twice the id of each of the slice's words, and one if it is hot;
    -1 for a rare word. Columns are -1 behind a window's end.
    """
    columns = [np.where(codes >= 0, ids[codes], -1)]
    for k in range(1, WORDS):
        after = np.full(len(codes), -1, ids.dtype)
        after[:len(codes) - k] = columns[0][k:]
        after[columns[-1] < 0] = -1
        columns.append(after)
    some = columns[1] >= 0
    # one column after the other: only one of them is held twice
    for k in range(WORDS):
        columns[k] = columns[k][some]
    order = np.lexsort(columns[::-1])
    new = np.zeros(len(order), bool)
    new[:1] = True
    for k in range(WORDS):
        columns[k] = columns[k][order]
        new[1:] |= columns[k][1:] != columns[k][:-1]
    at = np.flatnonzero(new)
    return [c[at] for c in columns], np.diff(np.append(at, len(order)))


def bucket_of(columns: list[np.ndarray], buckets: int) -> np.ndarray:
    """The bucket of each window: by its first two words, and by each further
    word behind hot words only."""
    key = mix(mix(columns[0].astype(np.uint64)) + columns[1].astype(np.uint64))
    hot = (columns[0] & columns[1] & 1).astype(bool)
    for c in columns[2:]:
        hot = hot & (c >= 0)
        key = np.where(hot, mix(key + c.astype(np.uint64)), key)
        hot = hot & (c & 1).astype(bool)
    return (key % np.uint64(buckets)).astype(np.int64)


def _window_rows(buckets: int, wide: bool):
    kind = np.dtype("<i8" if wide else "<i4")
    schema = pa.schema([("bucket", pa.int64()), ("n", pa.int64()), ("payload", pa.binary())])

    def work(codes: pa.Table, words: pa.Table) -> pa.Table:
        bucket, size, payload = [], [], []
        for blob in codes.column("codes").to_pylist():
            flat = np.frombuffer(blob, np.int32)
            ids = np.full(int(flat.max(initial=-1)) + 1, -1, kind)
            ids[words.column("local").to_numpy()] = words.column("id").to_numpy()
            columns, count = windows(flat, ids)
            to = bucket_of(columns, buckets)
            order = np.argsort(to, kind="stable")
            cuts = np.append(np.flatnonzero(np.diff(to[order], prepend=-1)), len(order))
            for k in range(WORDS):
                columns[k] = columns[k][order]
            columns.append(count[order].astype(kind))
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                bucket.append(int(to[order[a]]))
                size.append(b - a)
                payload.append(b"".join(c[a:b].tobytes() for c in columns))
        return pa.Table.from_arrays([pa.array(bucket, pa.int64()), pa.array(size, pa.int64()),
                                     pa.array(payload, pa.binary())], schema=schema)
    return work


def stripes(columns: list[np.ndarray], count: np.ndarray, least: int):
    """(prefix columns, next word, total, whether other buckets add to it) of the
    stripes of prefixes of one to four words that reach ``least``."""
    prefix, lead = [columns[0]], np.unique(columns[0], return_inverse=True)[1].reshape(-1)
    rows = np.arange(len(count))
    for k in range(1, WORDS):
        live = columns[k][rows] >= 0
        rows, lead = rows[live], lead[live]
        if not len(rows):
            return
        found, word = np.unique(columns[k][rows], return_inverse=True)
        key = lead * len(found) + word.reshape(-1)
        _, at, lead = np.unique(key, return_index=True, return_inverse=True)
        lead = lead.reshape(-1)
        total = np.bincount(lead, weights=count[rows]).astype(np.int64)
        phrase = [c[rows[at]] for c in columns[:k + 1]]
        shared = np.logical_and.reduce([c & 1 == 1 for c in phrase]) & (k + 1 < WORDS)
        kept = shared | (total >= least)
        yield ([c[kept] >> 1 for c in phrase[:-1]], phrase[-1][kept] >> 1, total[kept],
               shared[kept])
        on = kept[lead]
        rows, lead = rows[on], (np.cumsum(kept) - 1)[lead[on]]


def _stripe_rows(least: int, wide: bool):
    kind = np.dtype("<i8" if wide else "<i4")
    schema = pa.schema([("prefix", pa.list_(pa.int64())), ("next", pa.int64()),
                        ("f", pa.int64()), ("shared", pa.bool_())])

    def work(blobs: pa.Table) -> pa.Table:
        parts = [np.frombuffer(p, kind).reshape(WORDS + 1, -1)
                 for p in blobs.column("payload").to_pylist()]
        whole = np.concatenate(parts, axis=1)
        batches = []
        for prefix, word, total, shared in stripes(list(whole[:WORDS]), whole[WORDS], least):
            flat = np.stack(prefix, axis=1).astype(np.int64).reshape(-1)
            edges = (np.arange(len(word) + 1) * len(prefix)).astype(np.int32)
            batches.append(pa.RecordBatch.from_arrays([
                pa.ListArray.from_arrays(pa.array(edges), pa.array(flat)),
                pa.array(word.astype(np.int64)), pa.array(total), pa.array(shared)],
                schema=schema))
        return pa.Table.from_batches(batches, schema=schema)
    return work


def count_stripes(docs: DataFrame, least: int = LEAST, bucket: int = BUCKET,
                  slice_bytes: int = SLICE) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(words: lang, word, f, id; stripes: prefix, next, f; totals: lang, n).

    ``words`` and ``stripes`` have what occurs ``least`` times or more;
    ``prefix`` is an array of word ids, ``next`` a word id.
    """
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
                        F.coalesce("text", F.lit("")).alias("text"))
    table = persisted(texts.mapInArrow(_slice_rows(slice_bytes), CODED), "phrase-slices")
    distinct = table.where(F.col("word").isNotNull())
    totals = distinct.groupBy("lang").agg(F.sum("n").alias("n"))
    n = totals.agg(F.sum("n")).first()[0] or 0
    rows = persisted(numbered(distinct, least), "phrase-words")
    words = rows.where(F.col("word").isNotNull()).select("lang", "word", "f", "id")
    size = (words.agg(F.max("id")).first()[0] or 0) + 1
    own = rows.select(F.col("slice").alias("of"), "local",
                      (2 * F.col("id") + (F.col("f") > bucket).cast("long")).alias("id"))
    codes = table.where(F.col("codes").isNotNull()).select("slice", "codes")
    buckets, wide = max(1, math.ceil(SHARES * n / bucket)), size >= 1 << 30
    blobs = codes.groupBy("slice").cogroup(own.groupBy("of")).applyInArrow(
        _window_rows(buckets, wide), "bucket long, n long, payload binary")
    found = persisted(blobs.groupBy("bucket").applyInArrow(
        _stripe_rows(least, wide), "prefix array<long>, next long, f long, shared boolean"),
        "phrase-stripes")
    shared = found.where("shared").groupBy("prefix", "next").agg(F.sum("f").alias("f"))
    counts = found.where("not shared").select("prefix", "next", "f").unionByName(
        shared.where(F.col("f") >= least))
    return words, counts, totals


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, bucket: int = BUCKET,
                 slice_bytes: int = SLICE) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's ``top`` phrases."""
    words, counts, totals = count_stripes(docs, least, bucket, slice_bytes)
    phrases = persisted(counts.select(
        F.concat("prefix", F.array("next")).alias("ids"), F.col("f").alias("a")), "phrases")
    size = F.size("ids")
    # subsumption: the largest count of a stripe's entry, and of one more word in front
    ends = phrases.where(size > 2).select(
        F.explode(F.array(F.slice("ids", 1, size - 1), F.slice("ids", 2, size - 1))).alias("ids"),
        F.col("a").alias("longer"))
    longest = ends.groupBy("ids").agg(F.max("longer").alias("longer"))
    alone = phrases.join(longest, "ids", "left").where(
        F.col("longer").isNull() | (F.col("longer") < F.col("a"))).select("ids", "a")
    # both parts of each cut, from the stripes and the word counts
    parts = phrases.select(F.col("ids").alias("part"), F.col("a").alias("f")).unionByName(
        words.select(F.array("id").alias("part"), "f"))
    cuts = alone.select("ids", "a", F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    sides = cuts.select("ids", "a", "k", F.explode(F.array(
        F.struct(F.lit(True).alias("left"), F.slice("ids", 1, F.col("k")).alias("part")),
        F.struct(F.lit(False).alias("left"),
                 F.slice("ids", F.col("k") + 1, size - F.col("k")).alias("part")))).alias("s"))
    sides = sides.select("ids", "a", "k", "s.left", "s.part").join(parts, "part")
    cut = sides.groupBy("ids", "a", "k").agg(
        F.max(F.when(F.col("left"), F.col("f"))).alias("l"),
        F.max(F.when(~F.col("left"), F.col("f"))).alias("r"))
    named = alone.select("ids", F.posexplode("ids").alias("at", "id")).join(
        words.select("id", "lang", "word"), "id").groupBy("ids").agg(
        F.first("lang").alias("lang"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))),
                                 lambda x: x["word"]), " ").alias("phrase"))
    named = named.join(totals, "lang")
    whole = cut.join(named, "ids")
    wide = {c: F.col(c).cast("decimal(18,0)") for c in "alrn"}
    whole = whole.withColumn("_up", (wide["a"] * wide["n"] * F.lit(1000)).cast("decimal(38,0)"))
    whole = whole.withColumn("_down", (wide["l"] * wide["r"]).cast("decimal(38,0)"))
    whole = whole.withColumn("score", F.expr("_up div _down"))
    best = whole.groupBy("lang", "phrase", "a", "n").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    best = best.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    return _ranked(best, top)


def _ranked(best: DataFrame, top: int) -> DataFrame:
    """The first ``top`` rows of each language: parts of it first, then it."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.hash("phrase"), F.lit(RANK_PARTS))
    first = best.withColumn("part", part).withColumn("rank", F.row_number().over(
        Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= top)
    last = first.withColumn("rank", F.row_number().over(
        Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return last.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def collocations_sql(least: int = LEAST, top: int = TOP) -> str:
    """The same rows in DuckDB SQL over ``documents``."""
    return rf"""
WITH piece AS (
  SELECT row_number() OVER () AS p, lang, regexp_extract_all(t, '[^ \t]+') AS ws
  FROM (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
          translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
          '[.,;:!?\x0A-\x0D]')) AS t FROM documents)),
total AS (SELECT lang, sum(len(ws))::HUGEINT AS n FROM piece GROUP BY lang),
f AS (SELECT lang, ws[i:i + k - 1] AS ws, count(*) AS f
      FROM (SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i
            FROM piece, (SELECT unnest(range(1, {WORDS + 1})) AS k) WHERE len(ws) >= k)
      GROUP BY ALL HAVING count(*) >= {least}),
cand AS (SELECT lang, ws, f AS a FROM f WHERE len(ws) >= 2),
inside AS (SELECT DISTINCT lang, ws[i:i + k - 1] AS ws, a
           FROM (SELECT lang, ws, a, k, unnest(range(1, len(ws) - k + 2)) AS i
                 FROM cand, (SELECT unnest(range(2, {WORDS})) AS k) WHERE len(ws) > k)),
alone AS (SELECT c.* FROM cand c LEFT JOIN inside i USING (lang, ws)
          GROUP BY ALL HAVING coalesce(max(i.a), 0) < max(c.a)),
cut AS (SELECT lang, ws, a, k, ws[1:k] AS lw, ws[k + 1:] AS rw
        FROM (SELECT *, unnest(range(1, len(ws))) AS k FROM alone)),
scored AS (SELECT c.lang, array_to_string(c.ws, ' ') AS phrase, c.a, x.f AS l, y.f AS r, n, k,
                  (1000::HUGEINT * c.a * n // (x.f::HUGEINT * y.f))::BIGINT AS score
           FROM cut c JOIN f x ON x.lang = c.lang AND x.ws = lw
                      JOIN f y ON y.lang = c.lang AND y.ws = rw
                      JOIN total t ON t.lang = c.lang),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (
           PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)::BIGINT AS rank,
       phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score
FROM best QUALIFY rank <= {top}
"""
