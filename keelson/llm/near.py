"""Operator 8: near-duplicate documents by ProbMinHash.

A text's elements are its distinct 5-word shingles, weighted by how often they
occur. Each element sends points at the arrival times of a Poisson process
whose rate is its weight; each point falls on one of ``SIZE`` components, and a
component's value is the element whose point reached it first. A text stops
when its latest component is older than every element's next point (early
termination). Two texts agree in a component with the probability Jaccard
similarity of their weighted shingles, which is the Jaccard similarity when
weights are equal.

Links go by the Jaccard similarity of the shingle sets, from which the one of
the weighted shingles parts widely where a text repeats some of them often. So
a text with a repeated shingle has a second signature, of its shingles with
equal weights. For other texts both are the same.

Equal texts are one node from the start (128 bits of hash). ``BANDS`` bands of
``SIZE / BANDS`` components of each signature make the candidate buckets. A
first pass tests the texts of ``FIRST_BANDS`` bands against the least of their
bucket, which makes one class of most of a large group; then only the buckets
(of all bands) that hold several classes are left. ``linked_classes`` tests them, by the exact Jaccard similarity of the shingle sets against
``THRESHOLD``, without ever listing all pairs of a bucket; parity bits of the
sets settle most dissimilar pairs inside its joins (they cannot rule out a
similar one). Classes are the
connected components of the links; a class's id is its least doc_id.

Texts of 1 to 4 words have one shingle, all their words; texts without a word
are only like equal texts. Rows without a doc_id get no class. Rows that share
a doc_id are one document.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.llm import groups
from keelson.llm.common import free_name, id_text, persisted, slices
from keelson.llm.vectors import Texts, mix, window_hashes

SHINGLE = 5
SIZE = 64
BANDS = 16
THRESHOLD = 0.8
#: Bands of the pass before the rounds, and how the leaders of the rounds grow.
FIRST_BANDS = 4
GROWTH = 8
#: Longs of parity bits for each text.
PARITY = 16
PARITIES = [f"p{k}" for k in range(PARITY)]
SLICE = 2 << 20
_STEP = np.uint64(0x9E3779B97F4A7C15)


def shingles(t: Texts, size: int = SHINGLE):
    """(text, hash, count) of the distinct shingles, ordered by text and hash."""
    words = t.words()
    key = window_hashes(words, size)
    first, n = t.first[:-1], np.diff(t.first)
    text = t.doc_of_word()
    fits = np.arange(len(words)) + size <= np.repeat(t.first[1:], n)
    for k in range(1, size):  # short texts: one shingle of all words
        short = np.flatnonzero(n == k)
        if len(short):
            key[first[short]] = window_hashes(words, k)[first[short]]
            fits[first[short]] = True
    text, key = text[fits], key[fits]
    order = np.lexsort((key, text))
    text, key = text[order], key[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (text[1:] != text[:-1])
    head = np.flatnonzero(new)
    return text[head], key[head], np.diff(np.append(head, len(key)))


def prob_minhash(text: np.ndarray, key: np.ndarray, weight: np.ndarray, n: int,
                 size: int = SIZE) -> np.ndarray:
    """Signatures [n, size]; a text without elements has zeros."""
    time = np.full(n * size, np.inf)
    value = np.zeros(n * size, np.uint64)
    at = np.zeros(len(key))
    latest = np.full(n, np.inf)
    turn = 0
    while len(key):
        turn += 1
        g = mix(key + np.uint64(turn * int(_STEP) % (1 << 64)))
        at = at - np.log(((g >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0 ** -53) / weight
        live = at < latest[text]
        text, key, weight, at, g = text[live], key[live], weight[live], at[live], g[live]
        cell = text * size + (g % np.uint64(size)).astype(np.int64)
        np.minimum.at(time, cell, at)
        won = time[cell] == at
        value[cell[won]] = key[won]
        latest = time.reshape(n, size).max(1)
    return value.reshape(n, size)


def band_keys(signature: np.ndarray, bands: int = BANDS) -> np.ndarray:
    n, size = signature.shape
    rows = size // bands
    out = np.zeros((n, bands), np.uint64)
    for j in range(rows):
        out = mix(out * _STEP + signature[:, j::rows])
    return mix(out + np.arange(1, bands + 1, dtype=np.uint64))


def text_bands(text: np.ndarray, key: np.ndarray, count: np.ndarray, n: int
               ) -> tuple[np.ndarray, np.ndarray]:
    """(bands, how many of each text): those of the weighted signature, behind
    them those of the unweighted one where some shingle occurs twice."""
    bands = band_keys(prob_minhash(text, key, count.astype(np.float64), n))
    some = np.bincount(text, minlength=n) > 0
    twice = np.unique(text[count > 1])
    at = np.flatnonzero(np.isin(text, twice))
    equal = np.zeros_like(bands)
    equal[twice] = band_keys(prob_minhash(np.searchsorted(twice, text[at]), key[at],
                                          np.ones(len(at)), len(twice)))
    repeats = np.zeros(n, bool)
    repeats[twice] = True
    use = np.repeat(np.stack([some, repeats], 1), BANDS, axis=1)
    return np.concatenate([bands, equal], axis=1)[use], use.sum(1)


def _signatures(docs: DataFrame) -> DataFrame:
    """(doc_id, h1, h2, bands, size, p0 ...): the two hashes name the text;
    ``size`` counts its distinct shingles, and the p columns hold the parity of
    its shingles in each of ``64 * PARITY`` classes."""
    source = docs.select("doc_id", F.xxhash64("text").alias("h1"),
                         F.xxhash64(F.lit(1), "text").alias("h2"), "text")

    def run(batches):
        for b in slices(batches, most=SLICE):
            t = Texts(b.column("text"))
            text, key, weight = shingles(t)
            bands, size = text_bands(text, key, weight, t.n)
            odd = parities(text, key, t.n)
            offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(bands.view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("h1"), b.column("h2"), lists,
                 pa.array(np.bincount(text, minlength=t.n)),
                 *[pa.array(odd[:, k]) for k in range(PARITY)]],
                names=["doc_id", "h1", "h2", "bands", "size", *PARITIES])

    return source.mapInArrow(run, "doc_id long, h1 long, h2 long, bands array<long>, size long, "
                             + ", ".join(f"{p} long" for p in PARITIES))


def parities(text: np.ndarray, key: np.ndarray, n: int) -> np.ndarray:
    """Parity bits of each text's distinct shingles, [n, PARITY] long."""
    bits = 64 * PARITY
    cell = text * bits + (key >> np.uint64(32)).astype(np.int64) % bits
    odd = np.bincount(cell, minlength=n * bits).astype(np.uint8) & 1
    return np.packbits(odd, bitorder="little").view(np.int64).reshape(n, PARITY)


def _near(threshold: float):
    """What every similar pair fulfils: sets of a and b elements with Jaccard
    similarity s differ in (a + b)(1 - s) / (1 + s) elements, and each changes
    one parity bit at most."""
    most = (1 - threshold) / (1 + threshold)

    def condition(a: str, b: str):
        apart = sum((F.bit_count(F.col(f"{a}.{p}").bitwiseXOR(F.col(f"{b}.{p}")))
                     for p in PARITIES[1:]),
                    F.bit_count(F.col(f"{a}.{PARITIES[0]}").bitwiseXOR(F.col(f"{b}.{PARITIES[0]}"))))
        return apart <= (F.col(f"{a}.size") + F.col(f"{b}.size")) * most + 1e-6
    return condition


def shingle_sets(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, items): packed sorted shingle hashes of the documents in ``nodes``."""
    flags = groups.sieve(nodes)
    source = docs.select("doc_id", groups.sieve_slot("doc_id").alias("slot"), "text")

    def run(batches):
        def some():
            for b in batches:
                yield b.filter(pa.array(flags[b.column("slot").to_numpy()]))

        for b in slices(some(), most=SLICE):
            t = Texts(b.column("text"))
            text, key, _ = shingles(t)
            first = np.searchsorted(text, np.arange(t.n + 1))
            raw = memoryview(key.tobytes())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"),
                 pa.array([bytes(raw[8 * a:8 * e]) for a, e in
                           zip(first[:-1].tolist(), first[1:].tolist())], pa.binary())],
                names=["node", "items"])

    return (source.mapInArrow(run, "node long, items binary")
            .join(nodes, "node", "left_semi"))


def similar(docs: DataFrame, pairs: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) of doc_ids whose shingle sets are similar enough."""
    nodes = pairs.select(F.col("a").alias("node")).unionByName(
        pairs.select(F.col("b").alias("node"))).distinct()
    sets = persisted(shingle_sets(docs, persisted(nodes, "nodes")), "shingles")
    joined = (pairs.join(sets.select(F.col("node").alias("a"), F.col("items").alias("x")), "a")
              .join(sets.select(F.col("node").alias("b"), F.col("items").alias("y")), "b")
              .select("a", "b", "x", "y"))

    def run(batches):
        for b in batches:
            keep = []
            for x, y in zip(b.column("x"), b.column("y")):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(both >= math.ceil(threshold * (len(x) + len(y) - both) - 1e-9))
            yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return joined.mapInArrow(run, "a long, b long")


def classes(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, class_id) of every row of ``docs``."""
    docs = id_text(docs)
    known = docs.where("doc_id is not null")
    marks = persisted(_signatures(known), "signatures")
    # the least id names a text; partial aggregation keeps copies out of the shuffle
    texts = persisted(marks.groupBy("h1", "h2").agg(
        F.min("doc_id").alias("node"),
        *[F.min(c).alias(c) for c in ("bands", "size", *PARITIES)]), "texts")
    verify = lambda pairs: similar(known, pairs, threshold)
    extra, near = ("size", *PARITIES), _near(threshold)
    some = F.explode(F.slice("bands", 1, FIRST_BANDS))
    roots = groups.first_links(texts.select(some.alias("key"), "node", *extra), verify, near)
    classed = texts.join(roots, "node", "left").withColumn("class", F.coalesce("root", "node"))
    rows = groups.mixed(classed.select(F.explode("bands").alias("key"), "node", "class", *extra))
    roots = groups.linked_classes(rows.dropDuplicates(["key", "node"]), verify, near=near,
                                  growth=GROWTH, roots=roots)
    named = (texts.select("h1", "h2", "node").join(roots, "node", "left")
             .select("h1", "h2", F.coalesce("root", "node").alias("class_id")))
    out = marks.select("doc_id", "h1", "h2").join(named, ["h1", "h2"]).select("doc_id", "class_id")
    none = docs.where("doc_id is null").select("doc_id", F.lit(None).cast("long").alias("class_id"))
    return out.unionByName(none)


def keep_one(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that stay: of each class the document that names it.

    Rows without a doc_id stay.
    """
    name = free_name(docs.columns, "gone")
    gone = (classes(docs, threshold).where("doc_id <> class_id")
            .select(F.col("doc_id").alias(name)).distinct())
    # grows with the corpus, so it is never broadcast
    return docs.join(gone.hint("merge"), docs["doc_id"].cast("long") == F.col(name), "left_anti")
