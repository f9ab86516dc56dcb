"""Operator 2: SentencePiece encoding and decoding by a distinct-chunk table.

When no piece of the vocabulary holds a whitespace marker behind another
character, no merge can ever join two marked words, so a text may be cut
before each run of markers and each chunk segmented alone. A line feed that
occurs in no longer piece is a border of the same kind. Both facts are proven
from the model file on the driver; without the first, texts are encoded whole.

In a task, each distinct chunk is segmented once and the ids are joined back
by position. Holding the table in the worker and not in a shuffled table is
deliberate: most tokens repeat the task's own frequent words, and a corpus
table would have to ship one row for each word position. The table holds at
most ``TABLE_ROWS`` chunks and is emptied when full, so memory is bounded.

NULL and empty texts: no ids, decoded text is empty.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelson.llm.common import filled, id_text, int_lists

TABLE_ROWS = 700_000
MARK = "▁"


class PieceModel:
    """A SentencePiece file and what follows from its vocabulary."""

    def __init__(self, path: str):
        import sentencepiece
        with open(path, "rb") as f:
            self.proto = f.read()
        sp = sentencepiece.SentencePieceProcessor(model_proto=self.proto)
        normal = [sp.id_to_piece(i) for i in range(sp.get_piece_size())
                  if not (sp.is_control(i) or sp.is_byte(i) or sp.is_unknown(i)
                          or sp.is_unused(i))]
        self.chunked = (not any(MARK in p.lstrip(MARK) for p in normal)
                        and sp.encode(" a ", out_type=str)[-1] == MARK
                        and sp.encode("  ") == [sp.piece_to_id(MARK * 3)])
        line = not any("\n" in p and len(p) > 1 for p in normal)
        self.line_border = line and len(sp.encode("\n")) == 2


class _Chunks(dict):
    """Chunk (spaces written as markers) -> its ids as packed int32."""

    def __init__(self, model: PieceModel):
        super().__init__()
        import sentencepiece
        self.sp = sentencepiece.SentencePieceProcessor(model_proto=model.proto)
        self.model = model
        self.mark = np.array([self.sp.piece_to_id(MARK)], np.int32).tobytes()
        stop = "\n" if model.line_border else ""
        self.cut = re.compile(f"{MARK}*[^{MARK}{stop}]+|{MARK}+"
                              + ("|\n" if stop else "")).findall

    def __missing__(self, chunk: str) -> bytes:
        if len(self) > TABLE_ROWS:
            self.clear()
        if chunk == MARK:
            ids = self.mark
        elif chunk[0] == MARK:  # the library puts the first marker itself
            ids = self._ids(chunk[1:].replace(MARK, " "))
        elif chunk == "\n":
            ids = self._ids(chunk)[4:]
        else:  # behind a line feed: drop the marker and the line feed
            ids = self._ids("\n" + chunk)[8:]
        self[chunk] = ids
        return ids

    def _ids(self, text: str) -> bytes:
        return np.array(self.sp.encode(text), np.int32).tobytes()

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        if not self.model.chunked:
            return self._ids(text)
        return b"".join(map(self.__getitem__, self.cut(MARK + text.replace(" ", MARK))))


_tables: dict[int, _Chunks] = {}


def _chunks(model: PieceModel) -> _Chunks:
    key = hash(model.proto)
    if key not in _tables:
        _tables.clear()
        _tables[key] = _Chunks(model)
    return _tables[key]


def encode(docs: DataFrame, model: PieceModel, *, text_col: str = "text",
           out_col: str = "ids", decoded_col: str | None = None) -> DataFrame:
    """``docs`` with the ids of ``text_col`` as array<int> in ``out_col``.

    With ``decoded_col`` the ids are decoded in the same pass and that column
    is added too. Other columns pass through; columns of ``docs`` with these
    names are replaced. One pass, no shuffle.
    """
    added = [out_col] + ([decoded_col] if decoded_col else [])
    rest = [c for c in docs.columns if c not in added or c == text_col]
    if text_col in added:
        raise ValueError("the text column cannot be replaced by its ids")
    kept = docs.select(*rest)
    schema = T.StructType(
        kept.schema.fields + [T.StructField(out_col, T.ArrayType(T.IntegerType()))]
        + ([T.StructField(decoded_col, T.StringType())] if decoded_col else []))

    def run(batches):
        table = _chunks(model)
        for b, texts in filled(batches, text_col):
            rows = [table.encode(t) for t in texts.to_pylist()]
            flat = np.frombuffer(b"".join(rows), np.int32)
            cols = [b.column(c) for c in rest]
            cols.append(int_lists(flat, [len(r) // 4 for r in rows]))
            if decoded_col:
                decode = table.sp.decode
                cols.append(pa.array(
                    [decode(np.frombuffer(r, np.int32).tolist()) if r else ""
                     for r in rows], pa.string()))
            yield pa.RecordBatch.from_arrays(cols, names=rest + added)

    return kept.mapInArrow(run, schema)


def decode(df: DataFrame, model: PieceModel, *, ids_col: str = "ids",
           out_col: str = "decoded") -> DataFrame:
    """``df`` with ``ids_col`` decoded by the library into ``out_col``.

    NULL ids decode to the empty text.
    """
    rest = [c for c in df.columns if c != out_col]
    kept = df.select(*rest)
    schema = T.StructType(kept.schema.fields + [T.StructField(out_col, T.StringType())])

    def run(batches):
        sp = _chunks(model).sp
        for b in batches:
            texts = [sp.decode(i) if i else "" for i in b.column(ids_col).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(c) for c in rest] + [pa.array(texts, pa.string())],
                names=[*rest, out_col])

    return kept.mapInArrow(run, schema)


def digests(docs: DataFrame, model: PieceModel) -> DataFrame:
    """doc_id, n_tokens, SHA-256 of the ids joined by commas and of the decoded text."""
    out = encode(id_text(docs), model, decoded_col="decoded")
    return out.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))
