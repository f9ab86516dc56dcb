"""Operator 4: exact removal of repeated word windows, by super-k-mers.

A window is ``WINDOW`` consecutive words of one document. The least hash among
its groups of ``GROUP`` consecutive words is its minimiser; runs of windows
that share one travel together, as one packed string (a super-k-mer), to the
bucket that the minimiser names. Equal windows have equal minimisers, so they
meet in one bucket, where sorting puts them side by side. Equal hashes are
then checked byte by byte, so the outcome is exact.

Before anything is sent, equal super-k-mers of a task are reduced to those of
the smallest doc_id: all others are repeats whatever the other tasks hold. A
group of copies therefore sends at most one string from each task, and a
bucket holds no hot group of equal strings. Payloads are compressed for each
bucket and task.

A word goes when a window that covers it starts with the same words in a
document with a smaller doc_id; windows are judged on the input. Rows without
a doc_id have no order: they are left whole and remove nothing. Rows that
share a doc_id are one document, so they do not remove each other. NULL,
empty and short texts have no windows.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.llm.common import id_text, persisted, slices
from keelson.llm.vectors import (INVERSE, Texts, byte_sums, gathered, mix, power_sums,
                                 powers_at, range_hashes, window_hashes)

WINDOW = 13
GROUP = 3
SLICE = 4 << 20
#: Text bytes of a task that are cut up before their payloads are sent.
FLUSH = 16 << 20
BUCKETS_PER_PARTITION = 3


def _zip(*arrays: np.ndarray) -> bytes:
    codec = pa.Codec("zstd", compression_level=1)
    parts = []
    for a in arrays:
        raw = np.ascontiguousarray(a).tobytes()
        packed = codec.compress(raw, asbytes=True)
        parts.append(struct.pack("<qq", len(raw), len(packed)) + packed)
    return b"".join(parts)


def _unzip(data: bytes, *kinds) -> list[np.ndarray]:
    codec, at, out = pa.Codec("zstd"), 0, []
    for kind in kinds:
        n, size = struct.unpack_from("<qq", data, at)
        at += 16
        out.append(np.frombuffer(codec.decompress(data[at:at + size], n, asbytes=True), kind))
        at += size
    return out


def _least(keys: np.ndarray, width: int) -> np.ndarray:
    """Place of the least of ``width`` keys from each place on (first wins)."""
    n = len(keys) - width + 1
    best, at = keys[:n].copy(), np.arange(n)
    for j in range(1, width):
        less = keys[j:j + n] < best
        best[less] = keys[j:j + n][less]
        at[less] = np.flatnonzero(less) + j
    return at


def super_kmers(t: Texts, window: int, group: int):
    """(first word, windows, minimiser) of each run, over the slice's words."""
    words = t.words()
    if len(words) < window:
        return [np.zeros(0, np.int64)] * 2 + [np.zeros(0, np.uint64), words]
    keys = window_hashes(words, group)
    least = _least(keys, window - group + 1)[:len(words) - window + 1]
    last = np.repeat(t.first[1:], np.diff(t.first))
    at = np.arange(len(words) - window + 1)
    fits = np.flatnonzero(at + window <= last[:len(at)])
    if not len(fits):
        return [np.zeros(0, np.int64)] * 2 + [np.zeros(0, np.uint64), words]
    least = least[fits]
    new = np.ones(len(fits), bool)
    new[1:] = (least[1:] != least[:-1]) | (fits[1:] != fits[:-1] + 1)
    head = np.flatnonzero(new)
    count = np.diff(np.append(head, len(fits)))
    return [fits[head], count, keys[least[head]], words]


class _Cut:
    """Super-k-mers of some slices of a task."""

    def __init__(self):
        self.parts, self.size = [], 0

    def add(self, doc_ids: np.ndarray, column: pa.Array, window: int, group: int) -> None:
        t = Texts(column)
        first, count, key, words = super_kmers(t, window, group)
        self.size += len(t.raw)
        if not len(first):
            return
        doc = np.searchsorted(t.first, first, side="right") - 1
        stop = first + count + window - 1
        sums = power_sums(words)
        same = mix((sums[stop] - sums[first]) * powers_at(INVERSE, first)
                   + count.astype(np.uint64))
        text, at = gathered(t.raw, t.start, t.end)
        self.parts.append((doc_ids[doc], first - t.first[doc], count, key, same,
                           text, at[first], at[stop]))

    def flush(self, buckets: int):
        """(bucket, payload) rows; all flags ride with some bucket."""
        if not self.parts:
            self.size = 0
            return []
        doc, word, count, key, same = (np.concatenate([p[i] for p in self.parts])
                                       for i in range(5))
        base = np.cumsum([0] + [len(p[5]) for p in self.parts])
        text = np.concatenate([p[5] for p in self.parts])
        start = np.concatenate([p[6] + b for p, b in zip(self.parts, base)])
        stop = np.concatenate([p[7] + b for p, b in zip(self.parts, base)])
        self.parts, self.size = [], 0
        order = np.lexsort((doc, same))
        head = np.ones(len(order), bool)
        head[1:] = same[order[1:]] != same[order[:-1]]
        lead = order[np.maximum.accumulate(np.where(head, np.arange(len(order)), 0))]
        late = doc[order] > doc[lead]
        view = memoryview(text.tobytes())
        for i in np.flatnonzero(late):  # equal hashes must be equal strings
            a, b = order[i], lead[i]
            late[i] = view[start[a]:stop[a]] == view[start[b]:stop[b]]
        flagged, kept = order[late], np.sort(order[~late])
        to = ((key[kept] >> np.uint64(7)) % np.uint64(buckets)).astype(np.int64)
        kept = kept[np.argsort(to, kind="stable")]
        to = np.sort(to)
        out = []
        edges = np.searchsorted(to, np.arange(buckets + 1))
        for b in np.flatnonzero(np.diff(edges)):
            lo, hi = edges[b], edges[b + 1]
            k = kept[lo:hi]
            mine = flagged if b == to[0] else flagged[:0]
            out.append((int(b), _zip(
                doc[k], word[k].astype(np.int32), count[k].astype(np.int32),
                (stop[k] - start[k]).astype(np.int32),
                gathered(text, start[k], stop[k], None)[0],
                doc[mine], word[mine].astype(np.int32), count[mine].astype(np.int32))))
        return out


def _bucket_flags(payloads: list[bytes], window: int):
    """(doc_id, first window, windows) of the repeats in one bucket."""
    doc, word, key, lo, hi, which, texts = [], [], [], [], [], [], []
    flags = []
    for n, payload in enumerate(payloads):
        d, w, c, size, text, *more = _unzip(
            payload, np.int64, np.int32, np.int32, np.int32, np.uint8,
            np.int64, np.int32, np.int32)
        flags.append([a.astype(np.int64) for a in more])
        end = np.flatnonzero(text == 0x20)
        start = np.concatenate([[0], end[:-1] + 1])
        hashes = window_hashes(range_hashes(byte_sums(text), start, end), window)
        begin = np.searchsorted(start, np.cumsum(size) - size)
        step = np.arange(c.sum()) - np.repeat(np.cumsum(c) - c, c)
        at = np.repeat(begin, c) + step
        doc.append(np.repeat(d, c))
        word.append(np.repeat(w, c) + step)
        key.append(hashes[at])
        lo.append(start[at])
        hi.append(end[at + window - 1])
        which.append(np.full(len(at), n, np.int32))
        texts.append(text.tobytes())
    doc, word, key, lo, hi, which = map(np.concatenate, (doc, word, key, lo, hi, which))
    order = np.lexsort((doc, key))
    head = np.ones(len(order), bool)
    head[1:] = key[order[1:]] != key[order[:-1]]
    lead = order[np.maximum.accumulate(np.where(head, np.arange(len(order)), 0))]
    late = doc[order] > doc[lead]
    clash = set()
    for i in np.flatnonzero(order != lead):
        a, b = order[i], lead[i]
        if texts[which[a]][lo[a]:hi[a]] != texts[which[b]][lo[b]:hi[b]]:
            clash.add(int(key[a]))
    for k in clash:  # different windows under one hash: group by their bytes
        least: dict[bytes, int] = {}
        members = [i for i in np.flatnonzero(key[order] == np.uint64(k))]
        for i in members:
            a = order[i]
            s = texts[which[a]][lo[a]:hi[a]]
            least[s] = min(least.get(s, int(doc[a])), int(doc[a]))
        for i in members:
            a = order[i]
            late[i] = int(doc[a]) > least[texts[which[a]][lo[a]:hi[a]]]
    hit = order[late]
    d = np.concatenate([doc[hit]] + [f[0] for f in flags])
    w = np.concatenate([word[hit]] + [f[1] for f in flags])
    c = np.concatenate([np.ones(len(hit), np.int64)] + [f[2] for f in flags])
    order = np.lexsort((w, d))
    d, w, c = d[order], w[order], c[order]
    new = np.ones(len(d), bool)
    new[1:] = (d[1:] != d[:-1]) | (w[1:] != w[:-1] + c[:-1])
    head = np.flatnonzero(new)
    return d[head], w[head], (np.add.reduceat(c, head) if len(head) else c)


def repeated_windows(docs: DataFrame, *, window: int = WINDOW, group: int = GROUP,
                     buckets: int | None = None) -> DataFrame:
    """(doc_id, first, count): runs of windows that start in an earlier document."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n = buckets or parts * BUCKETS_PER_PARTITION

    def cut(batches):
        held = _Cut()

        def rows():
            out = held.flush(n)
            return pa.RecordBatch.from_arrays(
                [pa.array([b for b, _ in out], pa.int32()),
                 pa.array([p for _, p in out], pa.binary())], names=["bucket", "payload"])

        for b in slices(batches, most=SLICE):
            held.add(b.column("doc_id").to_numpy(zero_copy_only=False), b.column("text"),
                     window, group)
            if held.size >= FLUSH:
                yield rows()
        yield rows()

    def judge(batches):
        held, now = [], None

        def rows():
            d, w, c = _bucket_flags(held, window)
            return pa.RecordBatch.from_arrays(
                [pa.array(d, pa.int64()), pa.array(w, pa.int32()), pa.array(c, pa.int32())],
                names=["doc_id", "first", "count"])

        for batch in batches:
            for b, p in zip(batch.column("bucket").to_pylist(), batch.column("payload")):
                if b != now and held:
                    yield rows()
                    held = []
                now = b
                held.append(p.as_py())
        if held:
            yield rows()

    return (id_text(docs).where("doc_id is not null")
            .mapInArrow(cut, "bucket int, payload binary")
            .repartition(parts, "bucket").sortWithinPartitions("bucket")
            .mapInArrow(judge, "doc_id long, first int, count int"))


def remove_repeats(docs: DataFrame, *, window: int = WINDOW, group: int = GROUP) -> DataFrame:
    """Each row's id, words, removed words and the text that is left (kept
    words joined by one space)."""
    flags = persisted(repeated_windows(docs, window=window, group=group), "repeated-windows")
    ranges = (flags.groupBy(F.col("doc_id").alias("other"))
              .agg(F.collect_list(F.struct("first", "count")).alias("ranges")))
    # grows with the corpus, so it is never broadcast
    joined = (id_text(docs).join(ranges.hint("merge"), F.col("doc_id") == F.col("other"), "left")
              .select("doc_id", "text", "ranges"))

    def run(batches):
        for b in slices(batches, most=SLICE):
            t = Texts(b.column("text"))
            gone = np.zeros(len(t.start), bool)
            lists = b.column("ranges")
            for i in np.flatnonzero(np.asarray(lists.is_valid())):
                lo, hi = t.first[i], t.first[i + 1]
                pairs = lists[int(i)].values
                first = pairs.field("first").to_numpy()
                count = pairs.field("count").to_numpy()
                edge = np.zeros(hi - lo + 1, np.int32)
                ok = first < hi - lo
                np.add.at(edge, first[ok], 1)
                np.add.at(edge, np.minimum(first[ok] + count[ok] + window - 1, hi - lo), -1)
                gone[lo:hi] = np.cumsum(edge[:-1]) > 0
            keep = np.flatnonzero(~gone)
            text, at = gathered(t.raw, t.start[keep], t.end[keep])
            bounds = at[np.searchsorted(keep, t.first)]
            raw = memoryview(text.tobytes())
            left = [bytes(raw[a:max(a, e - 1)])
                    for a, e in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(np.diff(t.first), pa.int64()),
                 pa.array(t.per_text(gone), pa.int64()),
                 pa.array(left, pa.binary()).cast(pa.string())],
                names=["doc_id", "n_words", "n_removed", "kept"])

    return joined.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept string")
