"""Operator 5: benchmark decontamination by rare word n-grams and local alignment.

Test items are read in blocks of bounded size, so the item side of every job
is small whatever the benchmark's size. For each block, in two passes:

1. seeds are three words of an item, next to each other or with one word
   between (``PATTERNS``), so a copy with every third word replaced has some;
2. a seed at word p of a text and word q of an item speaks for a copy that
   begins near p - q; such begins fall in cells as long as the item, and each
   (text, item, cell) gives one passage that holds every copy beginning in that
   cell;
3. the first pass counts how often each seed stands alone, without another seed
   of the item in its cell or the cells beside it. A copy, exact or edited, has
   several, so no group of copies makes its own seeds common. Seeds that stand
   alone often are phrases of the language: they ask for a second seed. Rare
   seeds speak alone;
4. an alignment matches each word of the item once at most, so a passage that
   holds too few of the item's words cannot reach ``THRESHOLD``;
5. Smith-Waterman alignment on words (match 2, mismatch -1, gap -1) scores the
   others, divided by the score of an exact copy. Passages at or above
   ``THRESHOLD`` are leaks.

Words are lower-cased runs of letters and digits. Items with fewer than
``LEAST_WORDS`` words leak by exact copies only, and items with fewer than
three never match. No shuffle of texts; memory is a slice of texts and one
chunk of alignments, whatever the longest item. NULL ids are kept as they are,
NULL and empty texts hold no passage.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.llm.common import id_text, persisted, slices
from keelson.llm.toxicity import LETTERS
from keelson.llm.vectors import STEP, Texts, mix

#: Which words of a stretch make a seed.
PATTERNS = ((0, 1, 2), (0, 1, 3), (0, 2, 3))
LEAST_WORDS = 8
#: A seed is rare that stands alone so many times, or in that share of the documents.
LONE, LONE_SHARE = 8, 0.001
THRESHOLD = 0.5
MARGIN = 8
MATCH = 2
BLOCK_BYTES = 4 << 20
SLICE = 4 << 20
CHUNK_CELLS = 1 << 21
#: Slots of the table that rules out most seeds with one look.
SIEVE_BITS = 20
#: Flags of a passage's words, by hash; a clash only makes the bound looser.
FLAGS = 1 << 12


def _seeds(words: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Hash of the seed at each word, one row a pattern; 0 where it does not fit."""
    n = len(words)
    out = np.zeros((len(PATTERNS), n), np.uint64)
    for k, pattern in enumerate(PATTERNS):
        m = max(n - pattern[-1], 0)
        h = np.full(m, k + 1, np.uint64)
        for j in pattern:
            h = mix(h * np.uint64(STEP) + words[j:j + m])
        out[k, :m] = np.where(np.arange(m) + pattern[-1] < last[:m], h, 0)
    return out


class Items:
    """One block of test items: words one after another, and a sorted table of seeds."""

    def __init__(self, ids: list[int], texts: list[str]):
        t, self.words, key = _trigrams(pa.array(texts, pa.large_string()))
        self.ids = np.array(ids, np.int64)
        self.first, self.size = t.first[:-1], np.diff(t.first)
        k, at = np.nonzero(key)
        key = key[k, at]
        order = np.argsort(key, kind="stable")
        self.key, at = key[order], at[order]
        self.item = t.doc_of_word()[at]
        self.place = at - self.first[self.item]
        self.common = np.zeros(len(self.key), bool)
        self.sieve = np.zeros(1 << SIEVE_BITS, bool)
        self.sieve[self.key >> np.uint64(64 - SIEVE_BITS)] = True

    def hits(self, key: np.ndarray) -> np.ndarray:
        """Places of ``key`` that hold a seed."""
        at = np.flatnonzero(self.sieve[key >> np.uint64(64 - SIEVE_BITS)])
        left = np.searchsorted(self.key, key[at])
        left = np.minimum(left, max(len(self.key) - 1, 0))
        return at[self.key[left] == key[at]] if len(self.key) else at[:0]

    def least(self, threshold: float) -> np.ndarray:
        """The score that makes a leak, of each item."""
        return np.where(self.size < LEAST_WORDS, 1.0, threshold)

    def rows(self, pick: np.ndarray) -> np.ndarray:
        """Words of some items, one row each; 0 stands for no word."""
        col = np.arange(int(self.size[pick].max()))
        index = np.minimum(self.first[pick, None] + col, len(self.words) - 1)
        return np.where(col < self.size[pick, None], self.words[index], np.uint64(0))


def _trigrams(column: pa.Array):
    t = Texts(column, LETTERS)
    words = t.words()
    return t, words, _seeds(words, np.repeat(t.first[1:], np.diff(t.first)))


def _cells(items: Items, t: Texts, key: np.ndarray):
    """(item, text, cell), seeds in and beside each, whether one is rare, and the
    table place of a seed in it."""
    hit = items.hits(key.ravel())
    value, at = key.ravel()[hit], hit % max(key.shape[1], 1)
    lo = np.searchsorted(items.key, value, side="left")
    count = np.searchsorted(items.key, value, side="right") - lo
    step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    seed = np.repeat(lo, count)
    entry = seed + step
    at = np.repeat(at, count)
    text = np.searchsorted(t.first, at, side="right") - 1
    item = items.item[entry]
    begin = at - t.first[text] - items.place[entry]
    cell = np.floor_divide(begin, items.size[item])
    order = np.lexsort((cell, text, item))
    cells = np.stack([item, text, cell], 1)[order]
    new = np.ones(len(cells), bool)
    new[1:] = (cells[1:] != cells[:-1]).any(1)
    head = np.flatnonzero(new)
    cells = cells[head]
    inside = np.diff(np.append(head, len(new)))
    seeds = inside.copy()
    beside = (cells[1:, :2] == cells[:-1, :2]).all(1) & (cells[1:, 2] == cells[:-1, 2] + 1)
    seeds[1:] += np.where(beside, inside[:-1], 0)
    seeds[:-1] += np.where(beside, inside[1:], 0)
    rare = ~items.common[seed[order]]
    rare = np.logical_or.reduceat(rare, head) if len(head) else rare
    return cells, seeds, rare, seed[order][head]


def align(items: np.ndarray, passages: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(best local score, passage word behind it) of each row pair; 0 is no word."""
    n, width = passages.shape
    step = np.arange(width, dtype=np.int32)
    row = np.zeros((n, width + 1), np.int32)
    best, where = np.zeros(n, np.int32), np.zeros(n, np.int32)
    for i in range(items.shape[1]):
        word = items[:, i, None]
        gain = np.where((passages == word) & (word != 0), MATCH, -1).astype(np.int32)
        new = np.maximum(np.maximum(row[:, :-1] + gain, row[:, 1:] - 1), 0)
        new = np.maximum.accumulate(new + step, axis=1) - step  # gaps in the item
        row[:, 1:] = new
        top = new.argmax(1)
        value = new[np.arange(n), top]
        better = value > best
        best, where = np.where(better, value, best), np.where(better, top + 1, where)
    return best, where


def _held(items: np.ndarray, passages: np.ndarray) -> np.ndarray:
    """Of each row pair, how many words of the item the passage holds, or more."""
    n = len(items)
    slot = lambda x: (mix(x) % np.uint64(FLAGS)).astype(np.int64)
    flags = np.zeros((n, FLAGS), bool)
    flags[np.arange(n)[:, None], slot(passages)] = True
    return (flags[np.arange(n)[:, None], slot(items)] & (items != 0)).sum(1)


def _passages(items: Items, t: Texts, words: np.ndarray, key: np.ndarray, threshold: float):
    """(text, item, first word, score, end word) of the passages in a slice. The
    score is 0 where it cannot reach the threshold."""
    cells, seeds, rare, _ = _cells(items, t, key)
    item, text, cell = cells[rare | (seeds > 1)].T
    size, least = items.size[item], items.least(threshold)[item]
    first = np.maximum(cell * size - MARGIN, 0)
    end = np.minimum((cell + 2) * size + MARGIN, np.diff(t.first)[text])
    score, stop = np.zeros(len(item)), np.zeros(len(item), np.int64)
    order = np.argsort(size, kind="stable")
    order = order[(end - first)[order] >= least[order] * size[order]]
    i = 0
    while i < len(order):
        longest = int(size[order[i:i + 4096]].max())
        n = max(1, CHUNK_CELLS // (2 * longest + 2 * MARGIN))
        pick = order[i:i + min(n, 4096)]
        i += len(pick)
        col = first[pick, None] + np.arange(int((end - first)[pick].max()))
        inside = col < end[pick, None]
        index = np.minimum(col + t.first[text[pick], None], max(len(words) - 1, 0))
        passage = np.where(inside, words[index], np.uint64(0))
        rows = items.rows(item[pick])
        may = _held(rows, passage) / size[pick] >= least[pick]
        pick = pick[may]
        if len(pick):
            value, where = align(rows[may], passage[may])
            score[pick] = value / (MATCH * size[pick])
            stop[pick] = first[pick] + where
    return text, item, first, score, stop


def _blocks(benchmark: DataFrame, id_col: str, text_col: str):
    """Bounded blocks of the benchmark, one after another."""
    items = (benchmark.select(F.col(id_col).cast("long").alias("item_id"),
                              F.col(text_col).alias("text"))
             .where("item_id is not null and text is not null"))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-total // BLOCK_BYTES))
    for k in range(n):
        rows = (items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k)
                .orderBy("item_id", "text").collect())
        if rows:
            yield Items([r.item_id for r in rows], [r.text for r in rows])


def _mark_common(docs: DataFrame, items: Items) -> None:
    """Tell the seeds that often stand alone in ``docs``; -1 counts the documents."""
    def count(batches):
        alone, total = np.zeros(len(items.key), np.int64), 0
        for b in slices(batches, most=SLICE):
            t, _, key = _trigrams(b.column("text"))
            _, seeds, _, seed = _cells(items, t, key)
            alone += np.bincount(seed[seeds == 1], minlength=len(alone))
            total += t.n
        at = np.flatnonzero(alone)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(at, -1)), pa.array(np.append(alone[at], total))],
            names=["seed", "n"])

    counts = persisted(docs.select("text").mapInArrow(count, "seed long, n long")
                       .groupBy("seed").agg(F.sum("n").alias("n")), "seeds")
    total = counts.where("seed = -1").first()
    bound = max(LONE, LONE_SHARE * (total.n if total else 0))
    # at most one row for each seed of the block
    for r in counts.where((F.col("seed") >= 0) & (F.col("n") > bound)).collect():
        items.common[r.seed] = True


def find(docs: DataFrame, benchmark: DataFrame, *, threshold: float = THRESHOLD,
         item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc_id, item_id, score, first_word, end_word): the best passage of each
    document and item at or above the threshold."""
    docs = id_text(docs)
    schema = "doc_id long, item_id long, score double, first_word long, end_word long"
    out = docs.sparkSession.createDataFrame([], schema)

    for items in _blocks(benchmark, item_id, item_text):
        _mark_common(docs, items)

        def match(batches, items=items):
            for b in slices(batches, most=SLICE):
                t, words, key = _trigrams(b.column("text"))
                text, item, first, score, stop = _passages(items, t, words, key, threshold)
                ok = np.flatnonzero(score >= items.least(threshold)[item])
                ok = ok[np.lexsort((first[ok], -score[ok], item[ok], text[ok]))]
                new = np.ones(len(ok), bool)
                new[1:] = (text[ok[1:]] != text[ok[:-1]]) | (item[ok[1:]] != item[ok[:-1]])
                ok = ok[new]
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").take(pa.array(text[ok])),
                     pa.array(items.ids[item[ok]]), pa.array(score[ok]),
                     pa.array(first[ok]), pa.array(stop[ok])],
                    names=["doc_id", "item_id", "score", "first_word", "end_word"])

        out = out.unionByName(docs.mapInArrow(match, schema))
    return out


def clean(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that hold no leaked passage, with all columns."""
    leaked = find(docs, benchmark, threshold=threshold).select("doc_id").distinct()
    # grows with the corpus, so it is never broadcast
    return docs.join(leaked.hint("merge"), "doc_id", "left_anti").select(*docs.columns)
