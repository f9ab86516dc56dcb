"""Operator 6: toxicity by a bidirectional gated recurrent network.

Input of a word: its embedding (words in ``MIN_COUNT`` documents of the training
sample have one of their own, all others share one) plus the mean of its byte
trigrams' embeddings. Two gated recurrent layers, one in each direction, run
over a window of words; attention pooling and a linear layer give the window's
logit. A text's score is that of its highest window; windows of ``LENGTH``
words start every ``STRIDE`` words and cover every word of the text, so long
texts are scored whole.

Training is plain numpy with Adam on a bounded sample of labelled rows
(``TRAIN_ROWS``): a document's logit is a smooth maximum over its
windows, so the label of a long text need not be spread over its clean parts.
Only text enters a score.

NULL and empty texts, and texts without a word, get the score of an empty
window. One pass, no shuffle; memory is one slice of texts and one chunk of
windows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelson.llm.common import filled, id_text, slices
from keelson.llm.samples import fitted, label_odds, sample_frame
from keelson.llm.vectors import Texts, mix

LENGTH = 32
STRIDE = 24
HIDDEN = 12
WIDTH = 16
ATTEND = 8
CHAR_SLOTS = 1 << 13
MIN_COUNT = 4
SHARP = 3.0
#: Bound of the training sample, and how many of its rows may be toxic.
TRAIN_ROWS = 2400
TRAIN_TOXIC = 800
#: Small samples are gone through again until so many steps are made.
LEAST_STEPS = 120
CHUNK = 2048
SLICE = 4 << 20

#: ASCII letters in lower case, digits and non-ASCII bytes stay; the rest parts words.
LETTERS = np.full(256, 0x20, np.uint8)
for _b in range(256):
    if _b >= 0x80 or chr(_b).isalnum():
        LETTERS[_b] = ord(chr(_b).lower()) if _b < 0x80 else _b
del _b


class Words:
    """Distinct words of a slice: hash, byte trigram slots, and where they stand."""

    def __init__(self, column: pa.Array):
        t = Texts(column, LETTERS)
        self.first = t.first
        self.key, at, self.place = np.unique(t.words(), return_index=True, return_inverse=True)
        start, end = t.start[at], t.end[at]
        # trigrams of the word between two marks: one for each byte
        size = end - start
        pos = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(start, size)
        s, e = np.repeat(start, size), np.repeat(end, size)
        raw = t.raw.astype(np.uint64)
        n = len(raw)
        left = np.where(pos > s, raw[np.maximum(pos - 1, 0)], np.uint64(1)) if n else raw
        right = np.where(pos + 1 < e, raw[np.minimum(pos + 1, n - 1)], np.uint64(1)) if n else raw
        code = left << np.uint64(16) | raw[pos] << np.uint64(8) | right
        self.slots = (mix(code) % np.uint64(CHAR_SLOTS)).astype(np.int64)
        self.size = size

    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        """(first word, end of its text) of every window, and windows of each text."""
        n = np.diff(self.first)
        count = np.where(n > 0, 1 + np.maximum(0, -(-(n - LENGTH) // STRIDE)), 0)
        step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        begin = np.repeat(self.first[:-1], count) + step * STRIDE
        return begin, np.repeat(self.first[1:], count), count


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class ToxicityModel:
    def __init__(self, vocabulary: np.ndarray, seed: int = 3):
        r = np.random.default_rng(seed)
        self.vocabulary = vocabulary  # sorted hashes; the slot behind is for others

        def normal(*shape, scale):
            return (r.standard_normal(shape) * scale).astype(np.float32)
        h = HIDDEN
        self.p = {"word": normal(len(vocabulary) + 1, WIDTH, scale=0.1),
                  "char": normal(CHAR_SLOTS, WIDTH, scale=0.1),
                  "A": normal(2 * h, ATTEND, scale=0.3), "a": normal(ATTEND, scale=0.3),
                  "o": normal(2 * h, scale=0.3), "b": np.full(1, -2, np.float32)}
        for d in "fb":
            self.p["W" + d] = normal(WIDTH, 3 * h, scale=WIDTH ** -0.5)
            self.p["U" + d] = normal(h, 3 * h, scale=h ** -0.5)
            self.p["c" + d] = np.zeros(3 * h, np.float32)

    def inputs(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """(input vector, vocabulary slot) of each distinct word."""
        v = self.vocabulary
        slot = np.minimum(np.searchsorted(v, words.key), max(len(v) - 1, 0))
        known = v[slot] == words.key if len(v) else np.zeros(len(words.key), bool)
        slot = np.where(known, slot, len(v))
        x = self.p["word"][slot]
        if len(words.size):
            head = np.cumsum(words.size) - words.size
            x = x + np.add.reduceat(self.p["char"][words.slots], head) / words.size[:, None]
        return x.astype(np.float32), slot

    def _direction(self, d: str, proj: np.ndarray, ids: np.ndarray, mask: np.ndarray, keep: bool):
        """States of one direction, [step, window, hidden]; the tape if ``keep``."""
        n, steps = ids.shape
        h, U = np.zeros((n, HIDDEN), np.float32), self.p["U" + d]
        out = np.empty((steps, n, HIDDEN), np.float32)
        tape = []
        k = HIDDEN
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            P, G = proj[ids[:, t]], h @ U
            zr = P[:, :2 * k] + G[:, :2 * k]
            np.negative(zr, out=zr)
            np.exp(zr, out=zr)
            zr += 1
            np.reciprocal(zr, out=zr)
            z, r = zr[:, :k], zr[:, k:]
            m = np.tanh(P[:, 2 * k:] + r * G[:, 2 * k:])
            z = np.where(mask[:, t, None], z, np.float32(1))  # padding keeps the state
            new = m + z * (h - m)
            if keep:
                tape.append((t, h, z, r, m, G[:, 2 * k:]))
            h = out[t] = new
        return out, tape

    def forward(self, proj, ids, mask, keep=False):
        hf, tf = self._direction("f", proj["f"], ids, mask, keep)
        hb, tb = self._direction("b", proj["b"], ids, mask, keep)
        h = np.concatenate([hf, hb], 2)
        u = np.tanh(h @ self.p["A"])
        s = np.where(mask.T, u @ self.p["a"], np.float32(-1e9))
        w = np.exp(s - s.max(0))
        w /= w.sum(0)
        c = np.einsum("tn,tnk->nk", w, h)
        return c @ self.p["o"] + self.p["b"][0], (h, u, w, c, tf, tb)

    def projections(self, x: np.ndarray) -> dict[str, np.ndarray]:
        return {d: x @ self.p["W" + d] + self.p["c" + d] for d in "fb"}

    def scores(self, column: pa.Array) -> np.ndarray:
        """The score of each text: its highest window."""
        words = Words(column)
        begin, stop, count = words.windows()
        proj = self.projections(self.inputs(words)[0])
        logit = np.empty(len(begin), np.float64)
        for i in range(0, len(begin), CHUNK):
            ids, mask = _cut(words.place, begin[i:i + CHUNK], stop[i:i + CHUNK])
            logit[i:i + CHUNK] = self.forward(proj, ids, mask)[0]
        top = np.full(len(count), float(self.p["b"][0]))
        some = count > 0
        if some.any():
            top[some] = np.maximum.reduceat(logit, (np.cumsum(count) - count)[some])
        return _sigmoid(top)


def _cut(place: np.ndarray, begin: np.ndarray, stop: np.ndarray):
    at = begin[:, None] + np.arange(LENGTH)
    mask = at < stop[:, None]
    return place[np.minimum(at, len(place) - 1)], mask


def _scatter(index: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Rows of ``values`` summed by ``index``."""
    out = np.zeros((n, values.shape[1]), np.float32)
    if len(index):
        order = np.argsort(index, kind="stable")
        s = index[order]
        head = np.flatnonzero(np.append(True, s[1:] != s[:-1]))
        out[s[head]] = np.add.reduceat(values[order], head)
    return out


def _gradients(model: ToxicityModel, words: Words, docs: np.ndarray, label: np.ndarray):
    """Loss gradients of a batch of documents (positions in ``words``)."""
    begin, stop, count = words.windows()
    doc_first = np.cumsum(count) - count
    pick = np.concatenate([np.arange(doc_first[d], doc_first[d] + count[d]) for d in docs])
    group = np.repeat(np.arange(len(docs)), count[docs])
    ids, mask = _cut(words.place, begin[pick], stop[pick])
    x, slot = model.inputs(words)
    proj = model.projections(x)
    logit, (h, u, w, c, tf, tb) = model.forward(proj, ids, mask, keep=True)
    head = np.cumsum(count[docs]) - count[docs]
    top = np.maximum.reduceat(logit, head)
    e = np.exp(SHARP * (logit - top[group]))
    total = np.add.reduceat(e, head)
    doc = top + np.log(total) / SHARP
    err = (_sigmoid(doc) - label) / len(docs)
    dl = (err[group] * e / total[group]).astype(np.float32)
    g = {k: None for k in model.p}
    g["b"] = np.array([dl.sum()], np.float32)
    g["o"] = c.T @ dl
    dc = dl[:, None] * model.p["o"]
    dh = w[:, :, None] * dc
    dw = np.einsum("nk,tnk->tn", dc, h)
    ds = w * (dw - (w * dw).sum(0))
    g["a"] = np.einsum("tn,tnk->k", ds, u)
    du = ds[:, :, None] * model.p["a"] * (1 - u * u)
    g["A"] = np.einsum("tnh,tnk->hk", h, du)
    dh = dh + du @ model.p["A"].T
    k = HIDDEN
    dx = 0
    for d, tape, part in (("f", tf, dh[:, :, :k]), ("b", tb, dh[:, :, k:])):
        U, dU = model.p["U" + d], 0
        dP = np.zeros((LENGTH, len(pick), 3 * k), np.float32)
        carry = 0
        for t, before, z, r, m, gn in reversed(tape):
            cur = part[t] + carry
            on = mask[:, t, None]
            an = cur * (1 - z) * (1 - m * m)
            az = cur * (before - m) * z * (1 - z)
            ar = an * gn * r * (1 - r)
            dG = np.concatenate([az, ar, an * r], 1) * on
            dP[t] = np.concatenate([az, ar, an], 1) * on
            dU = dU + before.T @ dG
            carry = cur * z + dG @ U.T
        g["U" + d] = dU
        flat = dP.transpose(1, 0, 2).reshape(-1, 3 * k)
        dproj = _scatter(ids.ravel(), flat, len(x))
        g["W" + d], g["c" + d] = x.T @ dproj, dproj.sum(0)
        dx = dx + dproj @ model.p["W" + d].T
    g["word"] = _scatter(slot, dx, len(model.p["word"]))
    per = np.repeat(dx / np.maximum(words.size, 1)[:, None], words.size, axis=0)
    g["char"] = _scatter(words.slots, per, CHAR_SLOTS)
    return g


def _vocabulary(texts: list[str], batch: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of the words in ``MIN_COUNT`` texts or more, sorted; the texts that
    have a word), so many texts at once as in a step of the training."""
    keys, seen, some = np.zeros(0, np.uint64), np.zeros(0, np.int64), []
    for i in range(0, len(texts), batch):
        words = Words(pa.array(texts[i:i + batch], pa.large_string()))
        n = np.diff(words.first)
        some.append(i + np.flatnonzero(n > 0))
        pairs = np.unique(words.place.astype(np.int64) << 32 | np.repeat(np.arange(len(n)), n))
        found = np.bincount(pairs >> 32, minlength=len(words.key))
        keys, at = np.unique(np.concatenate([keys, words.key]), return_inverse=True)
        seen = np.bincount(at.reshape(-1), np.concatenate([seen, found]), len(keys)).astype(np.int64)
    return keys[seen >= MIN_COUNT], np.concatenate([np.zeros(0, np.int64), *some])


def train(rows: list, odds: float | None = None, *, epochs: int = 5, batch: int = 96,
          rate: float = 0.01) -> ToxicityModel:
    """Fit on Row(label, text); a single label gives a constant score.

    ``odds``: toxic to other rows among all labelled ones, where the sample
    holds more of the toxic; the bias is shifted back by the difference.
    """
    texts = [r.text for r in rows]
    label = np.array([r.label for r in rows], np.float32)
    if len(set(label.tolist())) < 2:
        model = ToxicityModel(np.zeros(0, np.uint64))
        model.p["o"][:] = 0
        model.p["b"][:] = -8 if not len(label) or label[0] == 0 else 8
        return model
    vocabulary, some = _vocabulary(texts, batch)
    model = ToxicityModel(vocabulary)
    moment = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in model.p.items()}
    r = np.random.default_rng(5)
    turns = -(-len(some) // batch)
    epochs = max(epochs, -(-LEAST_STEPS // turns))
    step, total = 0, epochs * turns
    for _ in range(epochs):
        order = r.permutation(some)
        for i in range(0, len(order), batch):
            docs = order[i:i + batch]
            part = Words(pa.array([texts[d] for d in docs], pa.large_string()))
            grads = _gradients(model, part, np.arange(len(docs)), label[docs])
            step += 1
            now = rate * (1 - 0.9 * step / total)
            norm = np.sqrt(sum(float((v * v).sum()) for v in grads.values()))
            for k, v in model.p.items():
                m, u = moment[k]
                grad = grads[k] * min(1.0, 5 / (norm + 1e-9))
                m += 0.1 * (grad - m)
                u += 0.01 * (grad * grad - u)
                v -= now * (m / (1 - 0.9 ** step)) / (np.sqrt(u / (1 - 0.99 ** step)) + 1e-6)
    if odds:
        model.p["b"] += np.float32(np.log(odds * (label == 0).sum() / (label == 1).sum()))
    return model


def fit(docs: DataFrame, labels: DataFrame) -> ToxicityModel:
    """Train on a bounded sample of the rows that are not held out."""
    sample = sample_frame(docs, labels, "toxic", rows=TRAIN_ROWS, ones=TRAIN_TOXIC,
                          where=~held_out())
    odds = label_odds(labels, "toxic", ~held_out())
    return fitted(sample, lambda rows: train(rows, odds))


def held_out() -> Column:
    """Rows never learnt from: crc32(doc_id as text) mod 5 = 0."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


def scored(docs: DataFrame, model: ToxicityModel, out_col: str = "score",
           text_col: str = "text") -> DataFrame:
    """``docs`` with the score of ``text_col`` as ``out_col`` (replaced if there)."""
    rest = [c for c in docs.columns if c != out_col]
    kept = docs.select(*rest)
    schema = T.StructType([*kept.schema.fields, T.StructField(out_col, T.DoubleType())])

    def run(batches):
        for b, texts in filled(batches, text_col):
            parts = slices([pa.RecordBatch.from_arrays([texts], names=["t"])], "t", SLICE)
            s = pa.array(np.concatenate([model.scores(p.column(0)) for p in parts]))
            yield pa.RecordBatch.from_arrays([b.column(c) for c in rest] + [s],
                                             names=[*rest, out_col])

    return kept.mapInArrow(run, schema)


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """doc_id and score of every row of ``docs``."""
    return scored(id_text(docs), model)
