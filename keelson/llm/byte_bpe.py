"""Byte-level BPE ids, each distinct pre-token merged once for each worker.

Pre-tokens never merge with their neighbours, so a text's ids are its
pre-tokens' ids in order, and the library's model merges each alone. The cut
is made with character classes that were checked against the library's, one
character at a time; texts with any other character, and texts with a special
string, are encoded by the library whole. Results are the library's for every
text.
"""

from __future__ import annotations

import json
import re
import struct

import numpy as np
import pyarrow as pa

from keelson.llm.vectors import gathered
from keelson.llm.token_count import LAST_CHECKED, WHITE, _byte_chars, _classes, _tokenizer

TABLE_ROWS = 700_000
SPACE, WHITE_KIND, LETTER, NUMBER, OTHER = range(5)


class BpeFile:
    """A tokenizers file and the facts proven about it on the driver."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            self.spec = f.read()
        tok = _tokenizer(self.spec)
        self.special = [t["content"] for t in json.loads(self.spec).get("added_tokens", [])]
        self.stand_in = {b: c for c, b in _byte_chars().items()}
        chars = [chr(i) for i in range(LAST_CHECKED + 1)]
        letters, numbers, white = _classes(chars)
        self.pattern = (f"'s|'t|'re|'ve|'m|'ll|'d| ?[{letters}]+| ?[{numbers}]+"
                        f"| ?[^{white}{letters}{numbers}]+"
                        f"|[{white}]+(?![^{white}])|[{white}]+")
        cut = re.compile(self.pattern)
        self.fast = "".join(
            c for c in chars
            if tok.normalizer is None and tok.pre_tokenizer is not None
            and all([x for x, _ in tok.pre_tokenizer.pre_tokenize_str(p)]
                    == [self.bytes_of(x) for x in cut.findall(p)]
                    for p in (f"a{c}b", f" {c}1", f".{c}{c} {c}", f"{c}'s{c} ")))

    def bytes_of(self, text: str) -> str:
        """The text as the model sees it: one printable character for each byte."""
        return text.encode().decode("latin-1").translate(self.stand_in)


class Encoder(dict):
    """Pre-token -> ids as packed little-endian uint32."""

    def __init__(self, facts: BpeFile):
        super().__init__()
        self.tok = _tokenizer(facts.spec)
        self.cut = re.compile(facts.pattern).findall
        self.other = re.compile(f"[^{re.escape(facts.fast)}]").search if facts.fast \
            else (lambda text: text)
        self.special = facts.special
        self.model, self.bytes_of = self.tok.model, facts.bytes_of
        self.kind = np.full(LAST_CHECKED + 1, OTHER, np.uint8)
        letters, numbers, _ = (set(x.replace("\\", "")) for x in _classes(
            [chr(i) for i in range(LAST_CHECKED + 1)]))
        for i in range(LAST_CHECKED + 1):
            c = chr(i)
            self.kind[i] = (SPACE if c == " " else WHITE_KIND if c in WHITE else
                            LETTER if c in letters else NUMBER if c in numbers else OTHER)

    def _ids(self, text: str) -> bytes:
        return np.array(self.tok.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def __missing__(self, pre: str) -> bytes:
        if len(self) > TABLE_ROWS:
            self.clear()
        tokens = self.model.tokenize(self.bytes_of(pre))
        ids = self[pre] = struct.pack(f"<{len(tokens)}I", *[t.id for t in tokens])
        return ids

    def encode(self, text: str) -> bytes:
        if self.other(text) or any(s in text for s in self.special):
            return self._ids(text)
        return self.joined(text)

    def joined(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, self.cut(text)))

    def encode_many(self, texts: list[str]) -> list[bytes]:
        """The ids of each text. Plain texts are cut together, and each
        distinct pre-token among them is looked up once."""
        plain = [k for k, t in enumerate(texts)
                 if "'" not in t and not self.other(t) and not any(s in t for s in self.special)]
        out = [b""] * len(texts)
        for k in set(range(len(texts))) - set(plain):
            out[k] = self.encode(texts[k])
        if plain:
            for k, ids in zip(plain, self._together([texts[k] for k in plain])):
                out[k] = ids
        return out

    def _together(self, texts: list[str]) -> list[bytes]:
        points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
        at = np.cumsum([0] + [len(t) for t in texts])
        start = token_starts(self.kind[points], at)
        if not len(start):
            return [b""] * len(texts)
        # distinct by their bytes, not by a hash: pre-tokens tile the texts
        raw = np.frombuffer("".join(texts).encode(), np.uint8)
        edges = np.append(start, len(points))
        if len(raw) > len(points):
            edges = np.append(np.flatnonzero((raw & 0xC0) != 0x80), len(raw))[edges]
        pieces = pa.Array.from_buffers(pa.large_string(), len(start), [
            None, pa.py_buffer(edges.astype(np.int64)), pa.py_buffer(raw)]).dictionary_encode()
        which = pieces.indices.to_numpy(zero_copy_only=False)
        ids = [self[x] for x in pieces.dictionary.to_pylist()]
        size = np.array([len(x) // 4 for x in ids])
        flat = np.frombuffer(b"".join(ids), "<u4")
        place = np.cumsum(size) - size
        values, offset = gathered(flat, place[which], (place + size)[which], None)
        edge = offset[np.searchsorted(start, at)]
        raw = values.tobytes()
        return [raw[4 * a:4 * b] for a, b in zip(edge[:-1].tolist(), edge[1:].tolist())]


def token_starts(kind: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Where pre-tokens begin in texts (at ``at``) without apostrophes.

    A run of letters, digits or other characters is one pre-token, with a
    space that stands before it. Of a run of white space before something
    else, the last character stands apart (a space joins what follows); at
    the end of a text the run is whole.
    """
    n = len(kind)
    white = kind <= WHITE_KIND
    edge = np.zeros(n + 1, bool)
    edge[at] = True
    group = np.where(white, np.uint8(WHITE_KIND), kind)
    begin = np.ones(n, bool)
    begin[1:] = group[1:] != group[:-1]
    begin[1:] &= white[1:] | (kind[:-1] != SPACE)
    last = white.copy()  # the last of its run, before something else
    last[:-1] &= ~white[1:] & ~edge[1:n]
    last[-1:] = False
    return np.flatnonzero(begin | last | edge[:n])


_encoders: dict[int, Encoder] = {}


def encoder(facts: BpeFile) -> Encoder:
    key = hash(facts.spec)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(facts)
    return _encoders[key]
