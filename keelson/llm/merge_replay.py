"""Byte-level BPE by replaying the merges over a corpus of pre-tokens.

A task gathers the texts of its partition (up to ``CORPUS`` bytes), cuts them
into pre-tokens and keeps each distinct one once. An inverted index goes from
the rank that two neighbouring tokens would merge to, to the places of such
neighbours in all distinct pre-tokens. Ranks are replayed in ascending order:
all places of a rank merge together, and only their neighbours' entries in the
index change. Ids then go back to every occurrence. No shuffle, and a lost
executor costs its own tasks only.

Exactness. A library merges the least rank of a pre-token first, the leftmost
of equals. Replay in ascending order gives the same unless a merge makes
neighbours of a lower rank than its own; pre-tokens where that happens are
merged alone, least rank first. A pre-token that is a token itself gets its
id. Character classes come from the library: ``CharKinds`` has it split one
probe for each code point.

Texts: NULL counts as empty and gives no ids. Repeated rows give repeated
results, a NULL id stays NULL; other columns are never looked at.
"""

from __future__ import annotations

import base64
import hashlib
import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from keelson.llm.byte_bpe import LETTER, NUMBER, OTHER, SPACE, WHITE_KIND, token_starts
from keelson.llm.common import id_text, slices, text_bytes
from keelson.llm.vectors import gathered

#: Text bytes cut at once, and text bytes whose pre-tokens are replayed together.
SLICE = 2 << 20
CORPUS = 8 << 20
#: Documents of a result batch.
ROWS = 500
#: Pairs whose rank a task remembers.
PAIRS = 1 << 18

CODE_POINTS = 0x110000
#: What may follow an apostrophe to make a pre-token (fixed by the pattern).
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")


class Vocabulary:
    """The ranks of a file, each the id of a byte string, and the split pattern."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            pairs = [line.split() for line in f if line.strip()]
        ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"{path} has no token for the bytes {missing}")
        self.ranks = ranks
        self.kinds = char_kinds(pattern)

    def token_table(self) -> tuple[np.ndarray, np.ndarray]:
        """(bytes of all tokens one after another, offset of each id)."""
        by_id = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            by_id[rank] = token
        at = np.cumsum([0] + [len(t) for t in by_id])
        return np.frombuffer(b"".join(by_id), np.uint8), at


def char_kinds(pattern: str) -> list[tuple[int, int]]:
    """(first code point, kind) of each stretch of code points of one kind.

    The library is asked: with a vocabulary in which "a", "1" and "." merge
    with any byte, the probe "ac" is one pre-token only for a letter c, "1c"
    for a number, ".c" for another character. Planes without characters (4 to
    13) or for private use (15, 16) hold neither letters, numbers nor spaces.
    """
    import tiktoken  # on the driver only

    ranks = {bytes([b]): b for b in range(256)}
    for lead in b"a1.":
        ranks |= {bytes([lead, b]): len(ranks) + b for b in range(256)}
    probe = tiktoken.Encoding("probe", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    size = np.ones(1024, np.int64)
    size[256:] = 2
    kinds = np.full(CODE_POINTS, OTHER, np.uint8)
    points = np.arange(CODE_POINTS, dtype=np.uint32)
    points = points[((points < 0x40000) | (points >> 16 == 14)) & (points >> 11 != 0xD800 >> 11)]
    kinds[points] = WHITE_KIND
    for part in np.array_split(points, 32):
        long = 1 + sum((part >= least).astype(np.int64) for least in (0x80, 0x800, 0x10000))
        place = np.cumsum(long + 2) - (long + 2)
        for lead, kind in (("a", LETTER), ("1", NUMBER), (".", OTHER)):
            line = np.full((len(part), 3), ord("\n"), "<u4")
            line[:, 0], line[:, 1] = ord(lead), part
            ids = np.array(probe.encode_ordinary(line.tobytes().decode("utf-32-le")))
            at = np.cumsum(size[ids]) - size[ids]
            joined = np.zeros(int(at[-1]) + 3, bool)
            joined[at[ids >= 256]] = True
            kinds[part[joined[place]]] = kind
    kinds[0x20] = SPACE
    edge = np.flatnonzero(np.append(True, kinds[1:] != kinds[:-1]))
    return list(zip(edge.tolist(), kinds[edge].tolist()))


def kind_table(stretches: list[tuple[int, int]]) -> np.ndarray:
    start, kind = (np.array(x) for x in zip(*stretches))
    return np.repeat(kind.astype(np.uint8), np.diff(np.append(start, CODE_POINTS)))


def cut(texts: pa.Array, kinds: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """(pre-tokens of all texts as bytes, index of each text's first, and the end)."""
    offsets, raw = text_bytes(texts)
    raw = raw[offsets[0]:offsets[-1]]
    data = raw.tobytes()
    points = np.frombuffer(data.decode().encode("utf-32-le"), np.uint32)
    char_at = np.append(np.flatnonzero((raw & 0xC0) != 0x80), len(raw))
    at = np.searchsorted(char_at, offsets - offsets[0])
    begin = np.zeros(len(points) + 1, bool)
    begin[token_starts(kinds[points], at)] = True
    _contractions(points, at, kinds, begin)
    start = np.flatnonzero(begin[:-1])
    bounds = char_at[np.append(start, len(points))]
    pieces = pa.Array.from_buffers(pa.large_binary(), len(start), [
        None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(data)])
    return pieces, np.searchsorted(start, at)


def _contractions(points: np.ndarray, at: np.ndarray, kinds: np.ndarray,
                  begin: np.ndarray) -> None:
    """Where an apostrophe begins a pre-token and a contraction follows, the
    pre-token ends with it; letters after it begin another."""
    place = np.flatnonzero((points == 0x27) & begin[:-1])
    end = at[np.searchsorted(at, place, side="right")]
    padded = np.append(points, [0, 0]).astype(np.int64)
    one, two = padded[place + 1], padded[place + 2]
    for tail in CONTRACTIONS:
        if len(tail) == 1:
            hit = (one == ord(tail)) & (place + 1 < end)
        else:
            hit = (one == ord(tail[0])) & (two == ord(tail[1])) & (place + 2 < end)
        begin[place[hit] + 1] = False
        after = place[hit] + 1 + len(tail)
        after = after[after < end[hit]]
        begin[after[kinds[points[after]] == LETTER]] = True


class Merger:
    """Replays the ranks over distinct pre-tokens."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {r: t for t, r in ranks.items()}
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.known: dict[int, int] = {}

    def pair_ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank each two tokens merge to, -1 for none."""
        a, b = a.astype(np.int64), b.astype(np.int64)
        if len(a) > 64:
            keys, which = np.unique(a << 32 | b, return_inverse=True)
            return np.array([self.rank(k) for k in keys.tolist()], np.int64)[which.reshape(-1)]
        return np.array([self.rank(k) for k in (a << 32 | b).tolist()], np.int64)

    def rank(self, key: int) -> int:
        found = self.known.get(key)
        if found is None:
            if len(self.known) >= PAIRS:
                self.known.clear()
            pair = self.bytes_of[key >> 32] + self.bytes_of[key & 0xFFFFFFFF]
            found = self.known[key] = self.ranks.get(pair, -1)
        return found

    def merge_all(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all pieces one after another, offset of each piece's)."""
        whole = np.array([self.ranks.get(p, -1) for p in pieces], np.int64)
        size = np.array([len(p) for p in pieces], np.int64)
        size[whole >= 0] = 1
        at = np.zeros(len(pieces) + 1, np.int64)
        np.cumsum(size, out=at[1:])
        raw = np.frombuffer(b"".join(b"\0" if w >= 0 else p
                                     for p, w in zip(pieces, whole.tolist())), np.uint8)
        token = self.single[raw]
        token[at[:-1][whole >= 0]] = whole[whole >= 0]
        piece = np.repeat(np.arange(len(pieces), dtype=np.int32), size)
        odd = self._replay(token, piece)
        for k in odd.tolist():
            ids = self.merge_alone(pieces[k])
            token[at[k]:at[k + 1]] = -1
            token[at[k]:at[k] + len(ids)] = ids
        alive = np.append(0, np.cumsum(token >= 0))
        return token[token >= 0], alive[at]

    def _replay(self, token: np.ndarray, piece: np.ndarray) -> np.ndarray:
        """Merge in place: the left place of a pair takes the rank, the right
        one -1. Returns the pieces to merge alone."""
        n = len(token)
        after = np.arange(1, n + 1, dtype=token.dtype)
        after[np.append(piece[1:] != piece[:-1], True)[:n]] = n  # n: none
        before = np.arange(-1, n - 1, dtype=token.dtype)
        before[np.append(True, piece[1:] != piece[:-1])[:n]] = n
        before, after = (np.append(x, token.dtype.type(n)) for x in (before, after))
        odd = np.zeros(len(piece) and int(piece[-1]) + 1, bool)
        index: dict[int, list[np.ndarray]] = {}
        queue: list[int] = []

        def note(place: np.ndarray, rank: np.ndarray) -> None:
            place, rank = place[rank >= 0], rank[rank >= 0]
            if not len(place):
                return
            order = np.argsort(rank, kind="stable")
            place, rank = place[order], rank[order]
            cuts = np.flatnonzero(rank[1:] != rank[:-1]) + 1
            for r, group in zip(rank[np.append(0, cuts)].tolist(), np.split(place, cuts)):
                if r not in index:
                    index[r] = []
                    heapq.heappush(queue, r)
                index[r].append(group)

        left = np.flatnonzero(after[:n] < n)
        note(left, self.pair_ranks(token[left], token[after[left]]))
        while queue:
            r = heapq.heappop(queue)
            spots = index.pop(r)
            at = spots[0] if len(spots) == 1 else np.unique(np.concatenate(spots))
            at = np.sort(at[(token[at] >= 0) & (after[at] < n) & ~odd[piece[at]]])
            if not len(at):
                continue
            at = at[self.pair_ranks(token[at], token[after[at]]) == r]
            at = _leftmost(at, after)
            if not len(at):
                continue
            right = after[at]
            following = after[right]
            has_next = following < n
            # what stands to the right while this place merges, before its turn
            seen = self.pair_ranks(np.full(int(has_next.sum()), r), token[following[has_next]])
            low = at[has_next][(seen >= 0) & (seen < r)]
            token[at], token[right] = r, -1
            after[at] = following
            before[following[has_next]] = at[has_next]
            former = before[at]
            place = np.unique(np.append(former[former < n], at[has_next]))
            rank = self.pair_ranks(token[place], token[after[place]])
            low = np.append(low, place[(rank >= 0) & (rank < r)])
            odd[piece[low]] = True
            note(place, rank)
        return np.flatnonzero(odd)

    def merge_alone(self, piece: bytes) -> list[int]:
        """One piece, least rank first, leftmost first."""
        token = self.single[np.frombuffer(piece, np.uint8)].tolist()
        n = len(token)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue: list[tuple[int, int]] = []

        def offer(i: int) -> None:
            if i >= 0 and after[i] < n:
                rank = self.rank(token[i] << 32 | token[after[i]])
                if rank >= 0:
                    heapq.heappush(queue, (rank, i))

        for i in range(n):
            offer(i)
        while queue:
            rank, i = heapq.heappop(queue)
            j = after[i]
            if token[i] < 0 or j >= n or self.rank(token[i] << 32 | token[j]) != rank:
                continue
            token[i], token[j], after[i] = rank, -1, after[j]
            if after[j] < n:
                before[after[j]] = i
            offer(before[i])
            offer(i)
        return [t for t in token if t >= 0]


def _leftmost(at: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Of places that share a token with the place before, every second."""
    tied = np.append(False, after[at[:-1]] == at[1:])[:len(at)]
    if not tied.any():
        return at
    head = np.flatnonzero(~tied)
    nth = np.arange(len(at)) - np.repeat(head, np.diff(np.append(head, len(at))))
    return at[nth % 2 == 0]


def _encode_rows(facts: Vocabulary, corpus: int):
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])

    def flush(held, merger):
        pieces = pa.chunked_array([codes for _, codes, _ in held]).unify_dictionaries()
        flat, at = merger.merge_all(pieces.chunk(0).dictionary.to_pylist())
        for (ids, _, first), chunk in zip(held, pieces.chunks):
            which = chunk.indices.to_numpy(zero_copy_only=False)
            for k in range(0, len(ids), ROWS):
                part = first[k:k + ROWS + 1]
                some = which[part[0]:part[-1]]
                values, edges = gathered(flat, at[some], at[some + 1], None)
                yield pa.RecordBatch.from_arrays([
                    ids.slice(k, ROWS),
                    pa.ListArray.from_arrays(pa.array(edges[part - part[0]].astype(np.int32)),
                                             pa.array(values.astype(np.int32)))], schema=schema)

    def work(batches):
        kinds, merger = kind_table(facts.kinds), Merger(facts.ranks)
        held, size = [], 0
        for batch in slices(batches, most=SLICE):
            pieces, first = cut(batch.column("text"), kinds)
            held.append((batch.column("doc_id"), pieces.dictionary_encode(), first))
            offsets, _ = text_bytes(batch.column("text"))
            size += int(offsets[-1] - offsets[0])
            if size >= corpus:
                yield from flush(held, merger)
                held, size = [], 0
        if held:
            yield from flush(held, merger)
    return work


def encode(docs: DataFrame, facts: Vocabulary, corpus: int = CORPUS) -> DataFrame:
    """doc_id and the ids of each text."""
    return id_text(docs).mapInArrow(_encode_rows(facts, corpus), "doc_id long, ids array<int>")


def _decoded(batch: pa.RecordBatch, table: np.ndarray, at: np.ndarray
             ) -> tuple[np.ndarray, np.ndarray, bytes, np.ndarray]:
    """(ids of all rows, offset of each row's, their bytes, offset of each row's)."""
    ids = batch.column("ids")
    edges = ids.offsets.to_numpy().astype(np.int64)
    flat = ids.values.to_numpy(zero_copy_only=False)[edges[0]:edges[-1]]
    data, byte_at = gathered(table, at[flat], at[flat + 1], None)
    edges = edges - edges[0]
    return flat, edges, data.tobytes(), byte_at[edges]


def decode(encoded: DataFrame, facts: Vocabulary) -> DataFrame:
    """doc_id and the bytes that the ids stand for."""
    table, at = facts.token_table()
    schema = pa.schema([("doc_id", pa.int64()), ("decoded", pa.large_binary())])

    def work(batches):
        for batch in batches:
            _, _, raw, ends = _decoded(batch, table, at)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(
                [raw[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())],
                pa.large_binary())], schema=schema)
    return encoded.select("doc_id", "ids").mapInArrow(work, "doc_id long, decoded binary")


def digests(docs: DataFrame, facts: Vocabulary, corpus: int = CORPUS) -> DataFrame:
    """doc_id, n_tokens, and the sha256 of the ids (as little-endian unsigned
    32-bit integers) and of the bytes they decode to: ``encode`` and ``decode``
    one after the other in the same worker."""
    table, at = facts.token_table()
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()),
                        ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])
    encoder = _encode_rows(facts, corpus)

    def sums(raw: bytes, edges: np.ndarray) -> pa.Array:
        view = memoryview(raw)
        return pa.array([hashlib.sha256(view[a:b]).hexdigest()
                         for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())], pa.string())

    def work(batches):
        for batch in encoder(batches):
            flat, edges, raw, ends = _decoded(batch, table, at)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array(np.diff(edges)),
                sums(flat.astype("<u4").tobytes(), 4 * edges), sums(raw, ends)], schema=schema)
    return id_text(docs).mapInArrow(
        work, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
