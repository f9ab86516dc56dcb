"""Words, lines and 64-bit hashes of a slice of texts, as numpy arrays.

Every array spans a whole slice (many documents); no Python code runs for a
word. Hashes are prefix sums of random byte values times powers of an odd
number modulo 2**64, so the hash of any byte range costs one subtraction and
one product; they are mixed before use as a key.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from keelson.llm.common import SPACE_BYTES, text_bytes

_M = (1 << 64) - 1
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)
STEP = 0xD1B54A32D192ED03
_VALUES = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64)
#: Positions whose powers are kept; others are a product of two of them.
BLOCK = 1 << 16
_powers: dict[int, np.ndarray] = {}

IS_SPACE = np.zeros(256, bool)
IS_SPACE[list(SPACE_BYTES)] = True


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64 (kept for the next slice)."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        out = np.empty(size, np.uint64)
        out[0] = 1
        done = 1
        while done < size:
            step = min(done, size - done)
            out[done:done + step] = out[:step] * np.uint64(pow(base, done, 1 << 64))
            done += step
        have = _powers[base] = out
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def powers_at(base: int, at: np.ndarray) -> np.ndarray:
    """base**at modulo 2**64, from two tables of ``BLOCK`` powers."""
    high = powers(pow(base, BLOCK, 1 << 64), int(at.max(initial=0)) // BLOCK + 1)
    return powers(base, BLOCK)[at % BLOCK] * high[at // BLOCK]


def power_sums(values: np.ndarray, code=None) -> np.ndarray:
    """Prefix sums of value * BASE**position, of ``code(values)`` if given. Works
    block by block, so nothing but the sums is as long as the input."""
    n = len(values)
    sums = np.zeros(n + 1, np.uint64)
    for a in range(0, n, BLOCK):
        part = values[a:a + BLOCK]
        part = (part if code is None else code(part)) * powers(BASE, BLOCK)[:len(part)]
        part *= np.uint64(pow(BASE, a, 1 << 64))
        out = sums[a + 1:a + 1 + len(part)]
        np.cumsum(part, out=out)
        out += sums[a]
    return sums


def byte_sums(raw: np.ndarray) -> np.ndarray:
    return power_sums(raw, lambda part: _VALUES[part])


def range_hashes(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Mixed hash of the byte ranges [start, end) of ``byte_sums``' bytes."""
    h = (sums[end] - sums[start]) * powers_at(INVERSE, start)
    return mix(h + (end - start).astype(np.uint64))


def gathered(raw: np.ndarray, start: np.ndarray, end: np.ndarray,
             mark: int | None = 0x20) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of the ranges one after another, offset of each range); with
    ``mark``, that byte follows each range."""
    size = end - start + (mark is not None)
    at = np.zeros(len(start) + 1, np.int64)
    np.cumsum(size, out=at[1:])
    index = np.arange(at[-1]) + np.repeat(start - at[:-1], size)
    if mark is None:
        return raw[index], at
    out = raw[np.minimum(index, max(len(raw) - 1, 0))] if len(raw) else np.zeros(0, np.uint8)
    out[at[1:] - 1] = mark
    return out, at


def named(keys: np.ndarray) -> tuple[np.ndarray, int]:
    """Equal keys to equal numbers from 0 on, and how many there are."""
    found, name = np.unique(keys, return_inverse=True)
    return name.reshape(-1).astype(np.int64), len(found)


def exact_names(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A number for each byte range; two are equal where the bytes are."""
    data, at = gathered(raw, start, end, None)
    ranges = pa.Array.from_buffers(pa.large_binary(), len(start), [
        None, pa.py_buffer(np.ascontiguousarray(at, np.int64)), pa.py_buffer(data.tobytes())])
    return ranges.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)


class Texts:
    """The texts of one Arrow slice.

    ``at``: byte offsets of the texts in ``raw``; ``start``, ``end``: byte
    range of each word; ``first``: index of each text's first word (and the
    end).
    """

    def __init__(self, column, table: np.ndarray | None = None):
        offsets, raw = text_bytes(column)
        self.raw = raw[offsets[0]:offsets[-1]]
        if table is not None:
            self.raw = table[self.raw]
        self.at = offsets - offsets[0]
        self.n = len(self.at) - 1
        solid = ~IS_SPACE[self.raw] if table is None else self.raw != 0x20
        n = len(self.raw)
        edge = np.zeros(n + 1, bool)
        edge[self.at] = True
        begin = solid.copy()
        begin[1:] &= ~solid[:-1] | edge[1:n]
        stop = solid.copy()
        stop[:-1] &= ~solid[1:] | edge[1:n]
        self.solid = solid
        self.start = np.flatnonzero(begin)
        self.end = np.flatnonzero(stop) + 1
        self.first = np.searchsorted(self.start, self.at)
        self._sums = None

    def doc_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(self.n), np.diff(self.first))

    def hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Mixed hash of the byte ranges [start, end)."""
        if self._sums is None:
            self._sums = byte_sums(self.raw)
        return range_hashes(self._sums, start, end)

    def words(self) -> np.ndarray:
        return self.hashes(self.start, self.end)

    def windows(self, words: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """(hash of the window at each word, whether it fits its text)."""
        n = len(words)
        out = window_hashes(words, size)
        last = np.repeat(self.first[1:], np.diff(self.first))
        fits = np.arange(n) + size <= last
        return out, fits

    def per_text(self, values: np.ndarray) -> np.ndarray:
        """Sum over the words of each text of a value for each word."""
        sums = np.concatenate([[0], np.cumsum(values)])
        return sums[self.first[1:]] - sums[self.first[:-1]]


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of ``size`` words from each word on (partial ones at the end)."""
    n = len(words)
    out = np.zeros(n, np.uint64)
    for j in range(min(size, n)):
        out[:n - j] = out[:n - j] * np.uint64(STEP) + words[j:]
    return mix(out)


def covered(starts: np.ndarray, size: int, n: int) -> np.ndarray:
    """Which of n words lie in a window of ``size`` words from ``starts``."""
    change = np.zeros(n + 1, np.int32)
    np.add.at(change, starts, 1)
    np.add.at(change, np.minimum(starts + size, n), -1)
    return np.cumsum(change[:n]) > 0


def repeated(keys: np.ndarray) -> np.ndarray:
    """Which keys occur twice or more."""
    order = np.argsort(keys, kind="stable")
    s = keys[order]
    same = s[1:] == s[:-1]
    hit = np.zeros(len(keys), bool)
    hit[order[1:][same]] = True
    hit[order[:-1][same]] = True
    return hit
