"""Operator 7: line dedup by a segment-partition edit join.

Two lines are linked when so many single-character edits turn one into the
other as the shorter's length allows (``BOUNDS``): short lines differ by a word
at few edits. A line with a limit of k edits is split into k + 1 even segments;
of two linked lines the longer holds some segment of the shorter unchanged, at
a place that their lengths narrow down. So each distinct line enters its own
segments into an index keyed by (length, segment number, segment), and probes
the index with the few substrings that can match, for each length from its own
down to the limit less. Equal lines need no join, whatever their length. Entries travel as packed arrays, one for each bucket and
slice; a bucket keeps only keys that join different lines.

Such keys are the buckets of ``linked_classes``; parities of characters and
character pairs rule out most pairs inside its joins (they cannot rule out a
linked pair), and the rest are verified by a banded bit-parallel edit distance. A class of lines is a connected component of the
links (equal lines are one node). Of each class the first line in the order
(doc_id, line number) stays, all others go.

Lines are parted by ``\\n``. The query and the pipeline pass ``BOUNDS``, so that
every line with a word (characters besides white space) can go; without bounds
only lines of ``LEAST`` characters or more can. Lines under ``LEAST`` characters
without a word always stay. NULL and empty texts have no lines to remove. Rows
without a doc_id have no place in the order: they are left whole and remove
nothing. Rows that share a doc_id are one document.
"""

from __future__ import annotations

from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelson.llm import groups
from keelson.llm.common import SPACE_BYTES, free_name, id_text, persisted, slices
from keelson.llm.substrings import _unzip, _zip
from keelson.llm.vectors import mix, power_sums, range_hashes

LIMIT = 2
LEAST = 24
#: (characters, edits): from so many characters on, so many edits.
BOUNDS = ((1, 0), (12, 1), (LEAST, LIMIT))
LONG = ((LEAST, LIMIT),)
SLICE = 4 << 20
FLUSH = 24 << 20
BUCKETS_PER_PARTITION = 2
#: Lines are cheap to compare, so few rounds are worth more than few tests.
LEADERS = 16


class Lines:
    """The lines of a slice of texts, over code points."""

    def __init__(self, texts: list[str]):
        self.points = np.frombuffer("\n".join(texts).encode("utf-32-le", "surrogatepass"),
                                    np.uint32)
        n = len(self.points)
        stop = np.append(np.flatnonzero(self.points == 10), n)
        self.start = np.concatenate([[0], stop[:-1] + 1])
        self.end = stop
        at = np.cumsum([0] + [len(t) + 1 for t in texts])
        self.first = np.searchsorted(self.start, at)
        self.sums = power_sums(self.points, lambda p: mix(p.astype(np.uint64) + np.uint64(1)))

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return range_hashes(self.sums, start, end)

    def names(self, at: np.ndarray) -> np.ndarray:
        """64 bits of a cryptographic hash of each of the lines ``at``: what lines
        are told apart by."""
        view = memoryview(self.points.tobytes())
        digest = [blake2b(view[4 * a:4 * b], digest_size=8).digest()
                  for a, b in zip(self.start[at].tolist(), self.end[at].tolist())]
        return np.frombuffer(b"".join(digest), np.uint64)

    def long(self, least: int) -> np.ndarray:
        """Lines of ``least`` characters or more; those under LEAST with a word."""
        size = self.end - self.start
        at = np.flatnonzero(size >= least)
        short = size[at] < LEAST
        n = size[at[short]]
        first = np.cumsum(n) - n
        place = np.arange(n.sum()) + np.repeat(self.start[at[short]] - first, n)
        inside = np.zeros(len(place) + 1, np.int64)
        np.cumsum(~np.isin(self.points[place], SPACE_BYTES), out=inside[1:])
        keep = ~short
        keep[short] = inside[first + n] > inside[first]
        return at[keep]

    def parities(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Parity bits of the characters and of the character pairs of lines."""
        p, one = self.points.astype(np.uint64), np.uint64(1)
        out = []
        for size, code in ((1, p), (2, p[:-1] * np.uint64(0x9E3779B1) + p[1:])):
            acc = np.zeros(len(code) + 1, np.uint64)
            np.bitwise_xor.accumulate(one << (mix(code + one) & np.uint64(63)), out=acc[1:])
            first = np.minimum(self.start[at], len(code))
            out.append(acc[np.maximum(self.end[at] - size + 1, first)] ^ acc[first])
        return out[0], out[1]

    def text(self, i: int) -> str:
        return self.points[self.start[i]:self.end[i]].tobytes().decode("utf-32-le",
                                                                       "surrogatepass")


def segment(length: np.ndarray, parts: int, i: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, length) of segment i of ``parts`` even ones; the last are longer."""
    base = length // parts
    longer = length - base * parts
    before = np.maximum(0, i - (parts - longer))
    return i * base + before, base + (i >= parts - longer)


def _key(piece: np.ndarray, length: np.ndarray, i: int) -> np.ndarray:
    return mix(piece + length.astype(np.uint64) * np.uint64(0xA24BAED4963EE407)
               + np.uint64(i * 0x9FB21C651E98DF25 % (1 << 64)))


def allowed(size: np.ndarray, bounds) -> np.ndarray:
    """Edits that lines of so many characters are given."""
    least, limit = np.array(bounds).T
    return limit[np.searchsorted(least, size, side="right") - 1]


def compared(bounds) -> int:
    """The least length that any edit is allowed at."""
    return min((least for least, limit in bounds if limit), default=1 << 31)


def entries(lines: Lines, at: np.ndarray, bounds):
    """((key, line) to index, (key, line) to probe) for the lines ``at``."""
    start, end = lines.start[at], lines.end[at]
    size = end - start
    index, probe = [], []
    for (least, limit), above in zip(bounds, [b[0] for b in bounds[1:]] + [1 << 62]):
        for i in range(limit + 1 if limit else 0):
            own = np.flatnonzero((size >= least) & (size < above))
            p, n = segment(size[own], limit + 1, i)
            index.append((_key(lines.hash(start[own] + p, start[own] + p + n), size[own], i), own))
            for less in range(limit + 1):
                short = size - less
                p, n = segment(short, limit + 1, i)
                # shifts that leave i edits to the left and limit - i to the right
                for shift in range(max(-i, less - (limit - i)), min(i, less + limit - i) + 1):
                    q = p + shift
                    ok = np.flatnonzero((short >= least) & (short < above)
                                        & (q >= 0) & (q + n <= size))
                    piece = lines.hash(start[ok] + q[ok], start[ok] + q[ok] + n[ok])
                    probe.append((_key(piece, short[ok], i), ok))
    join = lambda xs: tuple(np.concatenate([x[k] for x in xs]) for k in (0, 1))
    return join(index), join(probe)


def within(a: str, b: str, limit: int) -> bool:
    """Whether the edit distance of a and b is at most ``limit``.

    Bit-parallel over the band of 2 * limit + 1 diagonals: word d holds the
    rows of the current column that d edits reach; bit k is row
    column - limit + k.
    """
    if abs(len(a) - len(b)) > limit:
        return False
    lo = 0
    most = min(len(a), len(b))
    while lo < most and a[lo] == b[lo]:
        lo += 1
    hi = 0
    while hi < most - lo and a[len(a) - 1 - hi] == b[len(b) - 1 - hi]:
        hi += 1
    a, b = a[lo:len(a) - hi], b[lo:len(b) - hi]
    places: dict[str, int] = {}
    for row, c in enumerate(a, 1):
        places[c] = places.get(c, 0) | 1 << (row + limit)
    band = (1 << (2 * limit + 1)) - 1
    valid = ((1 << (len(a) + 1)) - 1) << limit  # rows 0 .. len(a)
    reach = [(band >> (limit - d)) & valid & ~((1 << limit) - 1) for d in range(limit + 1)]
    for col, c in enumerate(b, 1):
        match = places.get(c, 0) >> col & band
        rows = valid >> col & band
        new = [reach[0] & match & rows]
        for d in range(1, limit + 1):
            new.append(((reach[d] & match) | reach[d - 1] | reach[d - 1] >> 1
                        | new[d - 1] << 1) & rows)
        reach = new
        if not reach[limit]:
            return False
    return bool(reach[limit] >> (len(a) - len(b) + limit) & 1)


def _candidates(docs: DataFrame, bounds) -> DataFrame:
    """(key, node): segment keys that join different lines; a node is a line's name."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = parts * BUCKETS_PER_PARTITION

    def cut(batches):
        held, size = [], 0

        def rows():
            lists = [[np.concatenate([h[s][k] for h in held]) for k in (0, 1)] for s in (0, 1)]
            packed = []
            for key, node in lists:
                key, node = _distinct(key, node)
                to = (key >> np.uint64(32)) % np.uint64(buckets)
                order = np.argsort(to, kind="stable")  # keys stay in order inside a bucket
                packed.append((key[order], node[order],
                               np.searchsorted(to[order], np.arange(buckets + 1))))
            out = []
            for b in range(buckets):
                arrays = []
                for key, node, edge in packed:
                    low = key[edge[b]:edge[b + 1]].astype(np.uint32)
                    order = np.argsort(low, kind="stable")
                    arrays += [np.diff(low[order], prepend=np.uint32(0)),
                               node[edge[b]:edge[b + 1]][order]]
                if len(arrays[0]) or len(arrays[2]):
                    out.append((b, _zip(*arrays)))
            return pa.RecordBatch.from_arrays(
                [pa.array([b for b, _ in out], pa.int32()),
                 pa.array([p for _, p in out], pa.binary())], names=["bucket", "payload"])

        for b in slices(batches, most=SLICE):
            lines = Lines(b.column("text").to_pylist())
            at = lines.long(compared(bounds))
            node = lines.names(at)
            node, one = np.unique(node, return_index=True)
            if len(node):
                index, probe = entries(lines, at[one], bounds)
                held.append(((index[0], node[index[1]]), (probe[0], node[probe[1]])))
            size += len(lines.points)
            if size >= FLUSH and held:
                yield rows()
                held, size = [], 0
        if held:
            yield rows()

    def meet(batches):
        held, now = [], None

        def rows():
            index, probe = [], []
            for p in held:
                ik, i, pk, q = _unzip(p, np.uint32, np.uint64, np.uint32, np.uint64)
                index.append((np.cumsum(ik, dtype=np.uint32), i))
                probe.append((np.cumsum(pk, dtype=np.uint32), q))
            ik, i, pk, q = (np.concatenate([x[k] for x in xs])
                            for xs in (index, probe) for k in (0, 1))
            ik, i = _distinct(ik, i)
            near = np.isin(pk, ik)
            pk, q = _distinct(pk[near], q[near])
            near = np.isin(ik, pk)
            key, node = _distinct(np.append(ik[near], pk), np.append(i[near], q))
            # keys with two nodes or more
            _, first, count = np.unique(key, return_index=True, return_counts=True)
            some = np.repeat(count > 1, count)
            full = (np.uint64(now) << np.uint64(32)) | key[some].astype(np.uint64)
            return pa.RecordBatch.from_arrays(
                [pa.array(full.view(np.int64)), pa.array(node[some].view(np.int64))],
                names=["key", "node"])

        for batch in batches:
            for b, p in zip(batch.column("bucket").to_pylist(), batch.column("payload")):
                if b != now and held:
                    yield rows()
                    held = []
                now = b
                held.append(p.as_py())
        if held:
            yield rows()

    return (docs.mapInArrow(cut, "bucket int, payload binary")
            .repartition(parts, "bucket").sortWithinPartitions("bucket")
            .mapInArrow(meet, "key long, node long"))


def _distinct(key: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((node, key))
    key, node = key[order], node[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (node[1:] != node[:-1])
    return key[new], node[new]


def _texts(docs: DataFrame, rows: DataFrame, bounds) -> DataFrame:
    """(node, line, chars, pairs, edits) of the lines in ``rows``: a parity bit for
    each of 64 classes of characters and of character pairs, and the edits allowed."""
    nodes = persisted(rows.select("node").distinct(), "nodes")
    flags = groups.sieve(nodes, hashed=True)

    def fetch(batches):
        for b in slices(batches, most=SLICE):
            lines = Lines(b.column("text").to_pylist())
            at = lines.long(compared(bounds))
            node = lines.names(at)
            node, one = np.unique(node, return_index=True)
            keep = flags[(node & np.uint64(len(flags) - 1)).astype(np.int64)]
            at = at[one[keep]]
            chars, pairs = lines.parities(at)
            yield pa.RecordBatch.from_arrays(
                [pa.array(node[keep].view(np.int64)),
                 pa.array([lines.text(i) for i in at], pa.string()),
                 pa.array(chars.view(np.int64)), pa.array(pairs.view(np.int64)),
                 pa.array(allowed(lines.end[at] - lines.start[at], bounds), pa.int32())],
                names=["node", "line", "chars", "pairs", "edits"])

    schema = "node long, line string, chars long, pairs long, edits int"
    return persisted(docs.mapInArrow(fetch, schema)
                     .join(nodes, "node", "left_semi").dropDuplicates(["node"]), "lines")


def _near(a: str, b: str):
    """What every linked pair fulfils: an edit changes at most 2 characters and
    4 character pairs, so at most that many parity bits."""
    apart = lambda c: F.bit_count(F.col(f"{a}.{c}").bitwiseXOR(F.col(f"{b}.{c}")))
    most = F.least(f"{a}.edits", f"{b}.edits")
    return (apart("chars") <= 2 * most) & (apart("pairs") <= 4 * most)


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) of line hashes whose lines are linked."""
    joined = (pairs.join(texts.select(F.col("node").alias("a"), F.col("line").alias("x"),
                                          F.col("edits").alias("x_edits")), "a")
              .join(texts.select(F.col("node").alias("b"), F.col("line").alias("y"),
                                 F.col("edits").alias("y_edits")), "b")
              .select("a", "b", "x", "y", F.least("x_edits", "y_edits").alias("most")))

    def run(batches):
        for b in batches:
            ok = [within(x, y, most) for x, y, most in
                  zip(*(b.column(c).to_pylist() for c in ("x", "y", "most")))]
            yield b.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return joined.mapInArrow(run, "a long, b long")


def repeats(docs: DataFrame, *, bounds=LONG) -> DataFrame:
    """(doc_id, line, near): lines that go; ``near`` if no earlier line is equal."""
    known = id_text(docs).where("doc_id is not null")

    def place(batches):
        for b in slices(batches, most=SLICE):
            lines = Lines(b.column("text").to_pylist())
            at = lines.long(bounds[0][0])
            text = np.searchsorted(lines.first, at, side="right") - 1
            node = lines.names(at)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").take(pa.array(text)),
                 pa.array((at - lines.first[text]).astype(np.int32)),
                 pa.array(node.view(np.int64))], names=["doc_id", "line", "node"])

    places = persisted(known.mapInArrow(place, "doc_id long, line int, node long"), "places")
    rows = persisted(_candidates(known, bounds), "candidates")
    texts = _texts(known, rows, bounds)
    roots = groups.linked_classes(
        rows.join(texts.select("node", "chars", "pairs", "edits"), "node"),
        lambda pairs: _verified(pairs, texts), leaders=LEADERS, near=_near)
    at = F.struct("doc_id", "line")
    firsts = places.groupBy("node").agg(F.min(at).alias("own"), F.count("*").alias("n"))
    firsts = persisted(firsts.join(roots, "node", "left")
                       .withColumn("class", F.coalesce("root", "node")).drop("root"), "firsts")
    heads = firsts.groupBy("class").agg(F.min("own").alias("head"))
    # only lines that occur again, or in a class of several, can go
    firsts = firsts.join(heads, "class").where("n > 1 or own <> head")
    return (places.join(firsts, "node").where(at != F.col("head"))
            .select("doc_id", "line", (at == F.col("own")).alias("near")))


def remove(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
           bounds=LONG) -> DataFrame:
    """``docs`` with the repeated lines cut out of the text, and three columns:
    lines, removed lines, and removed lines that had no equal line before."""
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    own, lost_lines, near = (free_name(docs.columns, c) for c in ("__id", "__gone", "__near"))
    gone = (repeats(source, bounds=bounds).distinct()
            .groupBy(F.col("doc_id").alias(own))
            .agg(F.collect_list("line").alias(lost_lines), F.count_if("near").alias(near)))
    gone = persisted(gone, "removed-lines")
    added = ["n_lines", "n_removed", "n_near"]
    kept = [c for c in docs.columns if c not in added]
    # grows with the corpus, so it is never broadcast
    joined = docs.select(*kept).join(gone.hint("merge"),
                                     docs[id_col].cast("long") == F.col(own), "left")
    joined = joined.select(*kept, lost_lines, F.coalesce(near, F.lit(0)).alias(near))
    schema = T.StructType([f for f in docs.select(*kept).schema.fields]
                          + [T.StructField(c, T.LongType()) for c in added])

    def run(batches):
        for b in batches:
            texts, total, lost = [], [], []
            for t, g in zip(b.column(text_col).to_pylist(), b.column(lost_lines).to_pylist()):
                parts = t.split("\n") if t else []
                total.append(len(parts))
                if g:
                    out = set(g)
                    left = [x for i, x in enumerate(parts) if i not in out]
                    t = "\n".join(left)
                    lost.append(len(parts) - len(left))
                else:
                    lost.append(0)
                texts.append(t)
            cols = [pa.array(texts, pa.string()) if c == text_col else b.column(c) for c in kept]
            yield pa.RecordBatch.from_arrays(
                cols + [pa.array(total, pa.int64()), pa.array(lost, pa.int64()),
                        b.column(near)], names=kept + added)

    return joined.mapInArrow(run, schema)
