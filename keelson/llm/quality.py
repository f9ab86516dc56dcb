"""Operator 1: quality rules with a hashed n-gram logistic regression.

Features of a text are its word unigrams and bigrams and its byte trigrams,
hashed into ``2**BITS`` slots for each of the three kinds; a text's input is
the share of each slot among its n-grams of that kind. A logistic regression
is trained on the driver from a bounded sample of labelled rows
(``samples.SAMPLE_ROWS``), its scores are turned into probabilities by Platt
scaling on a fifth of the sample kept aside, and all texts are scored in Arrow
batches. The threshold is fixed: a text below ``KEEP`` is not kept.

The rules beside it count, for every whole text: words, their code points,
symbols, repeated lines, and words in 5-word windows that occur twice.
Repeats are found by 64-bit hashes within one text.

NULL and empty texts: no words, counts 0, so the base rule fails. One pass, no
shuffle; memory is one slice of texts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from keelson.llm.common import id_text, slices
from keelson.llm.samples import fitted, sample_frame
from keelson.llm.vectors import Texts, covered, exact_names, mix, named, repeated

BITS = 18
KEEP = 0.5
MIN_WORDS = 10
REPEAT_SHARE = 20  # per cent
WINDOW = 5
SLICE = 4 << 20
TRAIN_SLICE = 1 << 20

SYMBOLS = np.zeros(256, bool)
SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True


def _features(t: Texts, words: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(slot, first index of each text) for the three kinds of n-gram."""
    shift = np.uint64(64 - BITS)
    one = (words >> shift).astype(np.int32)
    pair, fits = t.windows(words, 2)
    two = (pair[fits] >> shift).astype(np.int32) + (1 << BITS)
    two_first = np.searchsorted(np.flatnonzero(fits), t.first)
    n = len(t.raw)
    if n < 3:
        tri, tri_first = np.zeros(0, np.int32), np.zeros(t.n + 1, np.int64)
    else:
        raw = t.raw.astype(np.uint64)
        key = raw[:-2] << np.uint64(16) | raw[1:-1] << np.uint64(8) | raw[2:]
        tri = (mix(key) >> shift).astype(np.int32) + (2 << BITS)
        # trigrams over a border of two texts count for neither
        inside = np.ones(len(tri), bool)
        for back in (1, 2):
            cut = t.at[1:-1] - back
            inside[cut[(cut >= 0) & (cut < len(tri))]] = False
        keep = np.flatnonzero(inside)
        tri, tri_first = tri[keep], np.searchsorted(keep, t.at)
    return [(one, t.first), (two, two_first), (tri, tri_first)]


def _means(weights: np.ndarray, features) -> np.ndarray:
    out = 0.0
    for slot, first in features:
        sums = np.concatenate([[0.0], np.cumsum(weights[slot], dtype=np.float64)])
        out = out + (sums[first[1:]] - sums[first[:-1]]) / np.maximum(np.diff(first), 1)
    return out


class QualityModel:
    """Weights, bias and the two Platt parameters."""

    def __init__(self, weights: np.ndarray, bias: float, scale: float, shift: float):
        self.weights, self.bias, self.scale, self.shift = weights, bias, scale, shift

    def probability(self, features) -> np.ndarray:
        z = self.scale * (_means(self.weights, features) + self.bias) + self.shift
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def train(rows: list, *, rounds: int = 100, rate: float = 0.5, decay: float = 1e-6) -> QualityModel:
    """Fit on Row(label, text). Without both labels everything is kept."""
    y = np.array([r.label for r in rows], np.float64)
    if len(set(y.tolist())) < 2:
        return QualityModel(np.zeros(3 << BITS, np.float32), 0.0, 0.0, 30.0)
    doc, slot, value, done = [], [], [], 0
    texts = pa.RecordBatch.from_arrays([pa.array([r.text for r in rows], pa.large_string())],
                                       names=["text"])
    for b in slices([texts], most=TRAIN_SLICE):
        t = Texts(b.column(0))
        for s, first in _features(t, t.words()):
            size = np.diff(first)
            d = np.repeat(np.arange(t.n), size)
            key, count = np.unique(d.astype(np.int64) << 32 | s, return_counts=True)
            doc.append((done + (key >> 32)).astype(np.int32))
            slot.append((key & 0xFFFFFFFF).astype(np.int32))
            value.append((count / size[key >> 32]).astype(np.float32))
        done += t.n
    doc, slot, value = map(np.concatenate, (doc, slot, value))
    fit = np.arange(len(y)) % 5 != 0
    used = fit[doc]
    d, s, v = doc[used], slot[used], value[used]
    names, s = np.unique(s, return_inverse=True)
    s = s.astype(np.int32)
    w, b = np.zeros(len(names)), float(np.log((y[fit].mean() + 1e-3) / (1 - y[fit].mean() + 1e-3)))
    m, u = np.zeros(len(w)), np.zeros(len(w))
    for k in range(1, rounds + 1):
        z = np.bincount(d, w[s] * v, minlength=len(y)) + b
        err = np.where(fit, 1 / (1 + np.exp(-np.clip(z, -30, 30))) - y, 0) / fit.sum()
        g = np.bincount(s, err[d] * v, minlength=len(w)) + decay * w
        m, u = 0.9 * m + 0.1 * g, 0.99 * u + 0.01 * g * g
        w -= rate * (m / (1 - 0.9 ** k)) / (np.sqrt(u / (1 - 0.99 ** k)) + 1e-8)
        b -= 0.5 * err.sum()
    full = np.zeros(3 << BITS)
    full[names] = w
    z = np.bincount(doc, full[slot] * value, minlength=len(y)) + b
    scale, shift = _platt(z[~fit], y[~fit])
    return QualityModel(full.astype(np.float32), b, scale, shift)


def fit(docs: DataFrame, labels: DataFrame) -> QualityModel:
    """Train on a bounded sample of the labelled rows, in an executor."""
    return fitted(sample_frame(docs, labels, "quality"), train)


def _platt(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Newton steps for sigmoid(scale * z + shift) on smoothed targets."""
    pos, neg = y.sum(), len(y) - y.sum()
    if not pos or not neg:
        return 1.0, 0.0
    target = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    x = np.stack([z, np.ones_like(z)], 1)
    p = np.array([0.1, 0.0])
    for _ in range(50):
        q = 1 / (1 + np.exp(-np.clip(x @ p, -30, 30)))
        hess = (x * (q * (1 - q))[:, None]).T @ x + 1e-4 * np.eye(2)
        p -= np.clip(np.linalg.solve(hess, x.T @ (q - target) + 1e-4 * p), -1, 1)
    return max(float(p[0]), 0.0), float(p[1])


def _line_repeats(t: Texts) -> np.ndarray:
    """Lines with a word that equal an earlier line of their text."""
    n = len(t.raw)
    brk = np.flatnonzero(t.raw == 0x0A)
    start = np.unique(np.concatenate([t.at[:-1], brk + 1]))
    start = start[start < n]
    end = np.empty_like(start)
    end[:-1] = start[1:]
    if len(end):
        end[-1] = n
    doc = np.searchsorted(t.at, start, side="right") - 1
    # a line ends before its line feed, or where its text ends
    end = end - ((end > start) & (t.raw[end - 1] == 0x0A))
    has = np.searchsorted(t.start, end) > np.searchsorted(t.start, start)
    start, end, doc = start[has], end[has], doc[has]
    key, _ = named(exact_names(t.raw, start, end) << 32 | doc)
    order = np.argsort(key, kind="stable")
    same = np.zeros(len(key), bool)
    same[order[1:]] = key[order[1:]] == key[order[:-1]]
    return np.bincount(doc[same], minlength=t.n)


def _again(t: Texts) -> np.ndarray:
    """Windows of ``WINDOW`` words that occur twice or more in their text. Names
    are equal where words are, not where hashes are."""
    n = len(t.start)
    last = np.repeat(t.first[1:], np.diff(t.first))
    at = np.flatnonzero(np.arange(n) + WINDOW <= last)
    words = exact_names(t.raw, t.start, t.end)
    key = t.doc_of_word()[at]
    for j in range(WINDOW):
        key, _ = named(key << 32 | words[at + j])
    return at[repeated(key)]


COLUMNS = {"n_words": pa.int64(), "word_chars": pa.int64(), "n_symbols": pa.int64(),
           "n_dup_lines": pa.int64(), "n_repeat_words": pa.int64(),
           "base_failed": pa.bool_(), "kept": pa.bool_(), "quality": pa.float64()}
SCHEMA = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
          "n_repeat_words long, base_failed boolean, kept boolean, quality double")


def measure(column: pa.Array, model: QualityModel) -> dict[str, np.ndarray]:
    t = Texts(column)
    words = t.words()
    n_words = np.diff(t.first)
    solid = np.concatenate([[0], np.cumsum(t.solid & ((t.raw & 0xC0) != 0x80))])
    marks = np.concatenate([[0], np.cumsum(SYMBOLS[t.raw])])
    again = covered(_again(t), WINDOW, len(words))
    n_repeat = t.per_text(again)
    failed = (n_words < MIN_WORDS) | (100 * n_repeat > REPEAT_SHARE * n_words)
    quality = model.probability(_features(t, words))
    return {"n_words": n_words, "word_chars": solid[t.at[1:]] - solid[t.at[:-1]],
            "n_symbols": marks[t.at[1:]] - marks[t.at[:-1]],
            "n_dup_lines": _line_repeats(t), "n_repeat_words": n_repeat,
            "base_failed": failed, "kept": ~failed & (quality >= KEEP), "quality": quality}


def score(docs: DataFrame, model: QualityModel) -> DataFrame:
    """One row for each row of ``docs`` with the rules' counts and verdicts."""

    def run(batches):
        for b in slices(batches, most=SLICE):
            m = measure(b.column("text"), model)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id")] + [pa.array(m[c], kind) for c, kind in COLUMNS.items()],
                names=["doc_id", *COLUMNS])

    return id_text(docs).mapInArrow(run, SCHEMA)
