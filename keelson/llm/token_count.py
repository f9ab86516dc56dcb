"""Operator 3: token counts by the whole-token shortcut.

Offline, on the driver, every vocabulary string that can stand alone as a
pre-token is encoded once with the library; those that give exactly one id
form the *whole-token set*. In the tasks a text is normalised and cut into
pre-tokens, a pre-token in that set counts as one token without any merging,
and only the rest is merged (by the library, once for each distinct pre-token
that a Python worker meets).

The shortcut stands on per-character facts, so they are proven too: the fast
cut is used only for texts made of characters for which the library's
normaliser and pre-tokeniser were found to agree with ours. Every other text,
and every text that holds a special string, goes to the library whole. Counts
are therefore the library's for all texts.

NULL or empty text: 0 tokens. Memory: one slice of texts and a table of at
most ``TABLE_ROWS`` pre-tokens in each worker (emptied when full).
"""

from __future__ import annotations

import json
import os
import re
import unicodedata

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.llm.common import filled

TABLE_ROWS = 1_000_000
#: Characters up to here may take the fast cut (each is checked).
LAST_CHECKED = 0x24F
#: Unicode White_Space below LAST_CHECKED.
WHITE = "\t\n\x0b\x0c\r \x85\xa0"


def _tokenizer(spec: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    t = Tokenizer.from_str(spec)
    t.no_truncation()
    t.no_padding()
    return t


def _byte_chars() -> dict[str, int]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {chr(b): b for b in plain}
    out.update({chr(256 + i): b for i, b in
                enumerate(b for b in range(256) if b not in set(plain))})
    return out


def _classes(chars: list[str]) -> tuple[str, str, str]:
    esc = lambda cs: "".join(re.escape(c) for c in cs)
    letters = esc(c for c in chars if unicodedata.category(c)[0] == "L")
    numbers = esc(c for c in chars if unicodedata.category(c)[0] == "N")
    return letters, numbers, esc(WHITE)


class WholeTokens:
    """What the driver proves about a tokenizer file; small, sent to tasks.

    Works for files whose pre-tokeniser is the lower-casing word cut
    (contractions, letter runs, single digits, runs of other characters);
    ``fast`` is empty for any other file, whose texts then all go to the
    library.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            self.spec = f.read()
        tok = _tokenizer(self.spec)
        model = json.loads(self.spec)
        self.special = [t["content"] for t in model.get("added_tokens", [])]
        chars = [chr(i) for i in range(LAST_CHECKED + 1)]
        letters, numbers, white = _classes(chars)
        self.pattern = (f"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{numbers}]"
                        f"|[^{white}{letters}{numbers}]+")
        cut = re.compile(self.pattern)
        good = []
        for c in chars:
            probes = [f"a{c}b", f"A {c}", f".{c}1", f"{c}{c}'s{c}t"]
            if all(self._pieces(tok, p) == cut.findall(p.lower()) for p in probes):
                good.append(c)
        self.fast = "".join(good)
        back = _byte_chars()
        strings = []
        for piece in model["model"]["vocab"]:
            if not piece.endswith("</w>"):
                continue
            try:
                s = bytes(back[c] for c in piece[:-4]).decode("utf-8")
            except (KeyError, UnicodeDecodeError):
                continue
            if s and s not in self.special:
                strings.append(s)
        codes = tok.encode_batch(strings, add_special_tokens=False)
        self.whole = [s for s, e in zip(strings, codes)
                      if len(e.ids) == 1 and cut.findall(s) == [s]]

    @staticmethod
    def _pieces(tok, text: str) -> list[str]:
        norm = tok.normalizer.normalize_str(text) if tok.normalizer else text
        return [norm[a:b] for _, (a, b) in tok.pre_tokenizer.pre_tokenize_str(norm)]


class _Counter(dict):
    """Pre-token -> number of ids; unknown ones are merged once."""

    def __init__(self, facts: WholeTokens):
        super().__init__()
        self.tok = _tokenizer(facts.spec)
        self.base = dict.fromkeys(facts.whole, 1)
        self.cut = re.compile(facts.pattern).findall
        self.other = re.compile(f"[^{re.escape(facts.fast)}]").search
        self.special = facts.special
        self.update(self.base)

    def __missing__(self, pre: str) -> int:
        if len(self) > TABLE_ROWS + len(self.base):
            self.clear()
            self.update(self.base)
        n = self[pre] = len(self.tok.encode(pre, add_special_tokens=False).ids)
        return n

    def count(self, text: str) -> int:
        if self.other(text) or any(s in text for s in self.special):
            return len(self.tok.encode(text, add_special_tokens=False).ids)
        return sum(map(self.__getitem__, self.cut(text.lower())))


_counters: dict[int, _Counter] = {}


def count_tokens(docs: DataFrame, facts: WholeTokens, *, text_col: str = "text",
                 out_col: str = "n_tokens") -> DataFrame:
    """``docs`` with the token count of ``text_col`` appended as ``out_col``.

    Other columns pass through. A column of ``docs`` named ``out_col`` is
    replaced. One pass, no shuffle.
    """
    rest = [c for c in docs.columns if c != out_col]
    kept = docs.select(*rest)
    schema = kept.withColumn(out_col, F.lit(0).cast("long")).schema

    def run(batches):
        key = hash(facts.spec)
        if key not in _counters:
            _counters.clear()
            _counters[key] = _Counter(facts)
        count = _counters[key].count
        for b, texts in filled(batches, text_col):
            n = pa.array([count(t) for t in texts.to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column(c) for c in rest] + [n], names=[*rest, out_col])

    return kept.mapInArrow(run, schema)
