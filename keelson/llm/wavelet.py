"""Operator 10: token ids as one wavelet-matrix file for each shard.

``write_shards`` puts documents in ascending id order (range partitioning on
the cluster, sorted inside each task), encodes them, appends the end id and
writes the ids of each run of documents as one file; ``read_documents`` and
``WaveletShard`` read the files back.

File: magic, header length (u32), header (JSON), sections. Ids are renumbered
by falling frequency in the shard, so high planes are sparse and compress
well. For each bit-plane the file holds its bits in blocks of ``BLOCK_BITS``,
each compressed alone, and the number of ones before each block. That is all
that rank and select need: ``access``, ``count`` and ``occurrences`` touch one
block in each plane for each step and never unpack the shard.

A shard file is written under an attempt's own name and then renamed. Content
follows from the input alone, so a task that runs again writes the same file.
Documents are never split over shards; a shard closes after ``shard_tokens``
ids, which bounds a task's memory (a longer document is a shard alone).

NULL and empty texts: only the end id. NULL doc_id: kept, sorted first.
Repeated ids: all kept, in order of their text. Empty table: no files, no rows.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from keelson.llm.byte_bpe import BpeFile, encoder
from keelson.llm.common import id_text, persisted, scratch, slices

MAGIC = b"KWM1"
BLOCK_BITS = 1 << 18
SHARD_TOKENS = 8_000_000
SLICE = 4 << 20
MANIFEST = "part int, sub int, path string, n_docs long, n_tokens long"


def _pack(block: bytes) -> bytes:
    return struct.pack("<I", len(block)) + pa.Codec("zstd", compression_level=1).compress(
        block, asbytes=True)


def _unpack(block: bytes) -> bytes:
    """A block is at most BLOCK_BITS long; its size stands in front."""
    size, = struct.unpack("<I", block[:4])
    return pa.Codec("zstd").decompress(block[4:], size, asbytes=True)


def build(ids: np.ndarray, doc_ids: list, lengths: np.ndarray) -> bytes:
    """The file of one shard."""
    ids = np.asarray(ids, np.uint32)
    n = len(ids)
    if n and int(ids.max()) >= 1 << 24:
        alphabet, counts = np.unique(ids, return_counts=True)
        alphabet = alphabet[np.argsort(-counts, kind="stable")].astype(np.uint32)
        order = np.argsort(alphabet)
        codes = order[np.searchsorted(alphabet[order], ids)]
    else:
        counts = np.bincount(ids) if n else np.zeros(0, np.int64)
        alphabet = np.argsort(-counts, kind="stable")[:np.count_nonzero(counts)]
        lut = np.zeros(len(counts), np.uint32)
        lut[alphabet] = np.arange(len(alphabet))
        codes = lut[ids] if n else ids
    sigma = len(alphabet)
    codes = codes.astype(np.uint16 if sigma <= 1 << 16 else np.uint32)
    planes = max(1, (max(sigma, 1) - 1).bit_length())
    blobs, zeros = [], []
    for k in range(planes - 1, -1, -1):
        bit = (codes & codes.dtype.type(1 << k)) != 0
        bits = np.packbits(bit, bitorder="little")
        packed, step = bits.tobytes(), BLOCK_BITS // 8
        parts = [_pack(packed[i:i + step]) for i in range(0, len(packed), step)]
        ones = np.add.reduceat(np.bitwise_count(bits), np.arange(0, len(bits), step),
                               dtype=np.int64) if n else np.zeros(0, np.int64)
        blobs.append((np.concatenate([[0], np.cumsum(ones)]).astype("<i8").tobytes(),
                      np.cumsum([0] + [len(p) for p in parts]).astype("<i8").tobytes(),
                      b"".join(parts)))
        high = codes[np.flatnonzero(bit)]
        zeros.append(n - len(high))
        codes = np.concatenate([codes[np.flatnonzero(~bit)], high])
    sections, at = [], 0
    body = []
    for blob in [alphabet.astype("<u4").tobytes(),
                 zlib.compress(json.dumps(doc_ids).encode(), 1),
                 np.asarray(lengths).astype("<i8").tobytes(),
                 *[b for plane in blobs for b in plane]]:
        sections.append((at, len(blob)))
        body.append(blob)
        at += len(blob)
    head = json.dumps({"n": n, "docs": len(doc_ids), "planes": planes, "zeros": zeros,
                       "block": BLOCK_BITS, "sections": sections}).encode()
    return b"".join([MAGIC, struct.pack("<I", len(head)), head, *body])


class WaveletShard:
    """Reads one shard. ``data`` is anything that slices to bytes."""

    def __init__(self, data):
        if bytes(data[:4]) != MAGIC:
            raise ValueError("not a wavelet shard")
        size, = struct.unpack("<I", bytes(data[4:8]))
        self.head = json.loads(bytes(data[8:8 + size]))
        self.data, self.base = data, 8 + size
        self.n, self.planes = self.head["n"], self.head["planes"]
        self.zeros = self.head["zeros"]
        self.alphabet = np.frombuffer(self._section(0), "<u4")
        self.code = {int(t): c for c, t in enumerate(self.alphabet)}
        self.doc_ids = json.loads(zlib.decompress(self._section(1)))
        self.lengths = np.frombuffer(self._section(2), "<i8")
        self.ones = [np.frombuffer(self._section(3 + 3 * p), "<i8") for p in range(self.planes)]
        self.ends = [np.frombuffer(self._section(4 + 3 * p), "<i8") for p in range(self.planes)]
        self._cache: dict[tuple[int, int], np.ndarray] = {}

    def _section(self, i: int, start: int = 0, end: int | None = None) -> bytes:
        at, size = self.head["sections"][i]
        return bytes(self.data[self.base + at + start:
                               self.base + at + (size if end is None else end)])

    def _block(self, plane: int, b: int) -> np.ndarray:
        key = (plane, b)
        if key not in self._cache:
            if len(self._cache) >= 64:
                self._cache.pop(next(iter(self._cache)))
            e = self.ends[plane]
            raw = _unpack(self._section(5 + 3 * plane, int(e[b]), int(e[b + 1])))
            self._cache[key] = np.unpackbits(np.frombuffer(raw, np.uint8), bitorder="little")
        return self._cache[key]

    def _rank1(self, plane: int, i: int) -> int:
        """Ones before position i."""
        b, r = divmod(i, BLOCK_BITS)
        return int(self.ones[plane][b]) + (int(self._block(plane, b)[:r].sum(dtype=np.int64))
                                           if r else 0)

    def _bit(self, plane: int, i: int) -> int:
        b, r = divmod(i, BLOCK_BITS)
        return int(self._block(plane, b)[r])

    def _select(self, plane: int, bit: int, k: int) -> int:
        """Position of the k-th (from 0) ``bit``."""
        starts = np.arange(len(self.ones[plane]), dtype=np.int64) * BLOCK_BITS
        before = self.ones[plane] if bit else starts - self.ones[plane]
        b = min(int(np.searchsorted(before, k, side="right")) - 1, len(self.ends[plane]) - 2)
        hits = np.flatnonzero(self._block(plane, b) == bit)
        return b * BLOCK_BITS + int(hits[k - int(before[b])])

    def access(self, i: int) -> int:
        """The id at position i."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        code = 0
        for p in range(self.planes):
            bit, r = self._bit(p, i), self._rank1(p, i)
            code = code << 1 | bit
            i = self.zeros[p] + r if bit else i - r
        return int(self.alphabet[code])

    def _range(self, token: int, start: int, end: int) -> tuple[int, int]:
        code = self.code[token]
        for p in range(self.planes):
            a, b = self._rank1(p, start), self._rank1(p, end)
            if code >> (self.planes - 1 - p) & 1:
                start, end = self.zeros[p] + a, self.zeros[p] + b
            else:
                start, end = start - a, end - b
        return start, end

    def count(self, token: int, start: int = 0, end: int | None = None) -> int:
        """How often the id occurs in [start, end)."""
        if token not in self.code:
            return 0
        a, b = self._range(token, start, self.n if end is None else end)
        return b - a

    def select(self, token: int, k: int) -> int:
        """Position of the k-th (from 0) occurrence of the id."""
        if not 0 <= k < self.count(token):
            raise IndexError(k)
        i = self._range(token, 0, self.n)[0] + k
        code = self.code[token]
        for p in range(self.planes - 1, -1, -1):
            if code >> (self.planes - 1 - p) & 1:
                i = self._select(p, 1, i - self.zeros[p])
            else:
                i = self._select(p, 0, i)
        return i

    def occurrences(self, token: int) -> list[int]:
        return [self.select(token, k) for k in range(self.count(token))]

    def tokens(self) -> np.ndarray:
        """All ids in order (one pass over the planes, last to first)."""
        out = None
        for p in range(self.planes - 1, -1, -1):
            e = self.ends[p]
            raw = b"".join(_unpack(self._section(5 + 3 * p, int(e[b]), int(e[b + 1])))
                           for b in range(len(e) - 1))
            bit = np.unpackbits(np.frombuffer(raw, np.uint8), count=self.n,
                                bitorder="little").astype(bool)
            if out is None:
                out = bit.astype(np.uint16 if self.planes <= 16 else np.uint32)
                continue
            up = np.empty_like(out)
            up[np.flatnonzero(~bit)] = out[:self.zeros[p]]
            up[np.flatnonzero(bit)] = (out[self.zeros[p]:]
                                       | out.dtype.type(1 << (self.planes - 1 - p)))
            out = up
        return self.alphabet[out] if self.n else np.zeros(0, np.uint32)


def _write_file(folder: str, name: str, data: bytes) -> str:
    from pyarrow import fs
    store, base = fs.FileSystem.from_uri(folder)
    store.create_dir(base, recursive=True)
    own = f"{base}/.{name}.{uuid.uuid4().hex}"
    with store.open_output_stream(own) as f:
        f.write(data)
    store.move(own, f"{base}/{name}")
    return f"{folder}/{name}"


def read_file(path: str) -> bytes:
    from pyarrow import fs
    store, base = fs.FileSystem.from_uri(path)
    with store.open_input_file(base) as f:
        return f.read()


def write_shards(docs: DataFrame, facts: BpeFile, folder: str, *, end_id: int | None = 2,
                 id_col: str = "doc_id", text_col: str = "text",
                 shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Write all documents; returns the manifest, one row for each file.

    ``folder`` is a URI that every executor can write. One shuffle, of the
    texts, by ranges of (id, hash of the text).
    """
    tail = b"" if end_id is None else struct.pack("<I", end_id)
    sorted_docs = (id_text(docs, id_col, text_col)
                   .withColumn("salt", F.xxhash64("text"))
                   .repartitionByRange("doc_id", "salt")
                   .sortWithinPartitions("doc_id", "salt", "text")
                   .drop("salt"))

    def run(batches):
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        enc = encoder(facts)
        sub, rows, names, held = 0, [], [], 0

        def close():
            nonlocal sub, rows, names, held
            data = build(np.frombuffer(b"".join(rows), "<u4"), names,
                         np.array([len(r) // 4 for r in rows]))
            path = _write_file(folder, f"shard-{part:07d}-{sub:05d}.kwm", data)
            out = pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([sub], pa.int32()), pa.array([path]),
                 pa.array([len(rows)], pa.int64()), pa.array([held], pa.int64())],
                names=["part", "sub", "path", "n_docs", "n_tokens"])
            sub, rows, names, held = sub + 1, [], [], 0
            return out

        for b in slices(batches, most=SLICE):
            for i, ids in zip(b.column("doc_id").to_pylist(),
                              enc.encode_many(b.column("text").to_pylist())):
                ids += tail
                if rows and held + len(ids) // 4 > shard_tokens:
                    yield close()
                rows.append(ids)
                names.append(i)
                held += len(ids) // 4
        if rows:
            yield close()

    return persisted(sorted_docs.mapInArrow(run, MANIFEST), "shard-manifest")


def with_starts(manifest: DataFrame) -> DataFrame:
    """``start``: ids in all files before. One row for each file is ordered."""
    before = Window.orderBy("part", "sub").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn(
        "start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0).cast("long")))


def read_documents(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of each document, from the files."""
    files = manifest.count()
    dealt = with_starts(manifest).repartitionByRange(max(1, files), "part", "sub")

    def run(batches):
        for b in batches:
            for path, start in zip(b.column("path").to_pylist(), b.column("start").to_pylist()):
                shard = WaveletShard(memoryview(read_file(path)))
                ids = shard.tokens().astype("<u4")
                ends = np.cumsum(shard.lengths)
                raw = memoryview(ids.tobytes())
                crc = [zlib.crc32(raw[4 * (e - n):4 * e])
                       for e, n in zip(ends.tolist(), shard.lengths.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard.doc_ids, pa.int64()),
                     pa.array(ends - shard.lengths + start, pa.int64()),
                     pa.array(shard.lengths, pa.int64()), pa.array(crc, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return dealt.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def shard_folder(spark: SparkSession) -> str:
    folder = scratch(spark, "shards")
    return folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"
