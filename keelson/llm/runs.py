"""Periodic runs of words: recompression grammar, LCE queries, harmonic grid.

A run is a stretch of consecutive words with smallest period q and at least
``max(LEAST, 2 * q)`` words that no neighbouring word extends with period q.

Recompression. The words of many texts, with a mark between texts that equals
nothing else, are one sequence of symbols. Rounds of block compression (a
stretch of one symbol becomes a symbol for symbol and length) and pair
compression (symbols are dealt to a left and a right side; a left one before a
right one becomes one symbol) go on until each text is one symbol: a
run-length grammar of depth logarithmic in the longest text. Equal texts get
equal symbols wherever they stand, up to their edges.

LCE. Two places are extended together, forward or backward, by climbing the
grammar while both stand at symbol edges and the next symbols agree, then
descending into the first symbols that differ: a step or two for each level.

Candidates. A run of period q and length m has m - q >= max(LEAST - q, q)
places whose word equals the word q further on, one after another, so a grid
of that step meets each run. Grids of all periods together have n * ln(n)
places; those where the word or both neighbours differ are passed over, and
the LCE both ways gives the exact run. A run found again with a multiple of its
period keeps the least.

Texts: NULL counts as empty, an empty text has no run. Repeated rows give
repeated results; other columns of the input are never looked at. Memory
follows ``SLICE`` bytes of text, or the longest text alone.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.llm.common import id_text, slices
from keelson.llm.vectors import Texts, exact_names, gathered, mix, named

LEAST = 12
SLICE = 4 << 20
#: Candidates looked at together.
CHUNK = 1 << 20

RUNS = ("doc_id long, n_words long, "
        "runs array<struct<start: long, length: long, period: long>>, collapsed string")


class Grammar:
    """Run-length grammar of one sequence; ``marks`` flags the marks in it.

    ``symbol[v]``: the symbols of level v. ``first[v]``: where each symbol of
    level v + 1, and the end, begins in level v. ``edge[v]``: the same as flags;
    ``upper[v]``: the level v + 1 edge at each level v edge. ``block[v]``:
    whether level v + 1 comes from blocks.
    """

    def __init__(self, symbols: np.ndarray, marks: np.ndarray):
        self.symbol = [symbols.astype(np.int32)]
        self.first: list[np.ndarray] = []
        self.edge: list[np.ndarray] = []
        self.upper: list[np.ndarray] = []
        self.block: list[bool] = []
        # marks keep numbers below all others: -1, -2, ... on every level
        names = self.symbol[0].copy()
        names[marks] = -1 - np.arange(int(marks.sum()))
        self.symbol[0] = names
        turn = 0
        while not self._settled():
            if not self._blocks():
                turn += 1
                self._pairs(turn)

    def _settled(self) -> bool:
        marks = np.flatnonzero(self.symbol[-1] < 0)
        return not len(marks) or int(np.diff(marks).max(initial=0)) <= 2

    def _push(self, start: np.ndarray, symbols: np.ndarray, block: bool) -> None:
        n = len(self.symbol[-1])
        first = np.append(start, n).astype(np.int32)
        edge = np.zeros(n + 1, bool)
        edge[first] = True
        self.first.append(first)
        self.edge.append(edge)
        self.upper.append((np.cumsum(edge) - 1).astype(np.int32))
        self.block.append(block)
        self.symbol.append(symbols.astype(np.int32))

    def _blocks(self) -> bool:
        s = self.symbol[-1]
        start = np.flatnonzero(np.append(True, s[1:] != s[:-1]))
        if len(start) == len(s):
            return False
        size = np.diff(np.append(start, len(s)))
        key = s[start].astype(np.int64) << 32 | size
        out = s[start].copy()
        real = out >= 0
        out[real], _ = named(key[real])
        self._push(start, out, True)
        return True

    def _pairs(self, turn: int) -> None:
        s = self.symbol[-1]
        left = mix(s.astype(np.uint64) + np.uint64(turn << 40)) >> np.uint64(63) == 0
        real = s >= 0
        pair = real[:-1] & real[1:] & left[:-1] & ~left[1:]
        other = real[:-1] & real[1:] & ~left[:-1] & left[1:]
        if other.sum() > pair.sum():
            pair = other
        if not pair.any():
            return  # the next turn deals the sides anew
        alone = np.append(True, ~pair)  # starts a symbol of the next level
        start = np.flatnonzero(alone)
        joined = np.append(pair, False)[start]
        after = np.append(s[1:], 0)[start]
        key = s[start].astype(np.int64) << 32 | np.where(joined, after.astype(np.int64) + 1, 0)
        out = s[start].copy()
        keep = out >= 0
        out[keep], _ = named(key[keep])
        self._push(start, out, False)

    def lce(self, x: np.ndarray, y: np.ndarray, back: bool) -> np.ndarray:
        """Common length from edges x < y of level 0, forward or backward.

        x and y stand in one text, so the mark at its end stops them.
        """
        x0, out = x, np.zeros(len(x), np.int64)
        at = -1 if back else 0
        step = -1 if back else 1
        live = np.arange(len(x))
        parked: list[list[np.ndarray]] = []  # by level: (which, x, y) whose symbols differ
        top = len(self.first)
        x, y = x.astype(np.int64), y.astype(np.int64)
        for level in range(top + 1):
            s = self.symbol[level]
            if level < top:
                edge, upper = self.edge[level], self.upper[level]
                inside = ~(edge[x] & edge[y])
                if self.block[level]:
                    go = inside & (s[x + at] == s[y + at])
                    most = np.minimum(self._left(level, x, back), self._left(level, y, back))
                    x, y = x + step * np.where(go, most, 0), y + step * np.where(go, most, 0)
                    stop = ~(edge[x] & edge[y])
                else:
                    go = inside & (s[x + at] == s[y + at])
                    x, y = x + step * go, y + step * go
                    stop = inside & ~go
                # nothing is gained above where the next symbols differ
                stop |= s[x + at] != s[y + at]
            else:
                stop = np.ones(len(x), bool)  # one symbol a text: x meets it, y a mark
            parked.append([live[stop], x[stop], y[stop]])
            on = ~stop
            live, x, y = live[on], x[on], y[on]
            if level < top:
                x, y = upper[x].astype(np.int64), upper[y].astype(np.int64)
            if not len(live):
                break
        which, x, y = (np.zeros(0, np.int64) for _ in range(3))
        for level in range(len(parked) - 1, -1, -1):
            if level < top and len(which):
                first = self.first[level]
                x, y = first[x].astype(np.int64), first[y].astype(np.int64)
                s = self.symbol[level]
                go = s[x + at] == s[y + at]
                if self.block[level]:
                    most = np.minimum(self._left(level, x, back), self._left(level, y, back))
                    go = np.where(go, most, 0)
                x, y = x + step * go, y + step * go
            a, b, c = parked[level]
            which, x, y = np.append(which, a), np.append(x, b), np.append(y, c)
        out[which] = np.abs(x - x0[which])
        return out

    def _left(self, level: int, x: np.ndarray, back: bool) -> np.ndarray:
        """Symbols of the block at x from x to its end (or back to its start)."""
        first, upper, edge = self.first[level], self.upper[level], self.edge[level]
        if back:
            begin = first[np.maximum(np.where(edge[x], upper[x] - 1, upper[x]), 0)]
            return x - begin
        return first[np.minimum(upper[x] + 1, len(first) - 1)] - x


def _candidates(size: np.ndarray, begin: np.ndarray, least: int):
    """(place, period) of all grids, at most about ``CHUNK`` at once."""
    text = np.arange(len(size))
    most = np.where(size >= least, size // 2, 0)
    texts = np.repeat(text, most)
    period = np.arange(len(texts)) - np.repeat(np.cumsum(most) - most, most) + 1
    step = np.maximum(period, least - period)
    count = np.maximum(0, -(-(size[texts] - period) // step))
    total = np.cumsum(count)
    done = 0
    while done < len(texts):
        before = total[done - 1] if done else 0
        end = max(done + 1, int(np.searchsorted(total, before + CHUNK, side="right")))
        part = slice(done, end)
        c = count[part]
        k = np.arange(int(c.sum())) - np.repeat(np.cumsum(c) - c, c)
        yield (np.repeat(begin[texts[part]], c) + k * np.repeat(step[part], c),
               np.repeat(period[part], c))
        done = end


def find_runs(names: np.ndarray, first: np.ndarray, least: int = LEAST
              ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of the runs of texts, by start, then period.

    ``names``: the words of all texts as numbers; text t has the words
    ``first[t]`` to ``first[t + 1]``. Starts count in the whole sequence.
    """
    size = np.diff(first)
    none = np.zeros(0, np.int64)
    if not len(names) or size.max() < least:
        return none, none, none
    texts = len(size)
    shift = np.repeat(np.arange(texts), size) + 1
    symbols = np.zeros(len(names) + texts + 1, np.int64)
    marks = np.ones(len(symbols), bool)
    marks[np.arange(len(names)) + shift] = False
    symbols[~marks] = names
    grammar = Grammar(symbols, marks)
    w = grammar.symbol[0]
    found = []
    for place, period in _candidates(size, first[:-1] + np.arange(texts) + 1, least):
        hit = np.flatnonzero(w[place] == w[place + period])
        place, period = place[hit], period[hit]
        near = (w[place - 1] == w[place + period - 1]) | (w[place + 1] == w[place + period + 1])
        place, period = place[near], period[near]
        if not len(place):
            continue
        ahead = grammar.lce(place, place + period, back=False)
        behind = grammar.lce(place, place + period, back=True)
        length = ahead + behind + period
        good = length >= np.maximum(least, 2 * period)
        found.append(np.stack([(place - behind)[good], length[good], period[good]]))
    if not found:
        return none, none, none
    start, length, period = np.concatenate(found, 1)
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    # the first of equal stretches has their smallest period
    new = np.append(True, (np.diff(start) != 0) | (np.diff(length) != 0))[:len(start)]
    start, length, period = start[new], length[new], period[new]
    order = np.lexsort((period, start))
    start, length, period = start[order], length[order], period[order]
    text = np.searchsorted(first[:-1] + np.arange(texts) + 1, start, side="right") - 1
    return start - text - 1, length, period


def _run_rows(least: int):
    schema = pa.schema([
        ("doc_id", pa.int64()), ("n_words", pa.int64()),
        ("runs", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()),
                                     ("period", pa.int64())]))),
        ("collapsed", pa.large_string())])

    def work(batches):
        for part in slices(batches, most=SLICE):
            t = Texts(part.column("text"))
            names = exact_names(t.raw, t.start, t.end)
            start, length, period = find_runs(names, t.first, least)
            change = np.zeros(len(names) + 1, np.int64)
            np.add.at(change, start + period, 1)
            np.add.at(change, start + length, -1)
            kept = np.flatnonzero(np.cumsum(change[:-1]) == 0)
            data, at = gathered(t.raw, t.start[kept], t.end[kept])
            edge = at[np.searchsorted(kept, t.first)]
            words = data.tobytes()
            collapsed = [words[a:max(a, b - 1)].decode()
                         for a, b in zip(edge[:-1].tolist(), edge[1:].tolist())]
            runs_at = np.searchsorted(start, t.first).astype(np.int32)
            own = t.first[np.searchsorted(t.first, start, side="right") - 1]
            runs = pa.StructArray.from_arrays(
                [pa.array(start - own), pa.array(length), pa.array(period)],
                ["start", "length", "period"])
            yield pa.RecordBatch.from_arrays([
                part.column("doc_id"), pa.array(np.diff(t.first).astype(np.int64)),
                pa.ListArray.from_arrays(pa.array(runs_at), runs),
                pa.array(collapsed, pa.large_string())], schema=schema)
    return work


def runs(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """doc_id, n_words, runs (by start, then period) and the collapsed text:
    words that no run holds after its first period, joined by one space."""
    return id_text(docs).mapInArrow(_run_rows(least), RUNS)


def with_echo(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) with the tails that the query's contract repeats.

    Of h = crc32(doc_id), where h % 10 = 0: word i from a on becomes word
    a + (i - a) % p, a = g % n, p = 1 + floor((n - a) / (3 + g % 8)), g = floor(h / 10).
    A NULL id has no h: its text stays.
    """
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10).cast("long")
    words = F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))
    chosen = docs.withColumn("_words", F.when(h % 10 == 0, words))
    n = F.size("_words").cast("long")
    some = F.coalesce(F.col("_words").isNotNull() & (n > 0), F.lit(False))
    chosen = chosen.withColumn("_a", F.when(some, g % n))
    chosen = chosen.withColumn(
        "_p", F.when(some, 1 + F.floor((n - F.col("_a")) / (3 + g % 8)).cast("long")))
    a, p = F.col("_a"), F.col("_p")
    echoed = F.array_join(F.transform("_words", lambda w, i: F.when(i < a, w).otherwise(
        F.get("_words", (a + (i - a) % p).cast("int")))), " ")
    return chosen.select("doc_id", F.when(some, echoed).otherwise(F.col("text")).alias("text"))


def summary(found: DataFrame) -> DataFrame:
    """The digest columns of ``runs``: count, longest run, digests."""
    longest = F.try_element_at(F.array_sort("runs", lambda x, y: F.when(
        x["length"] != y["length"], y["length"] - x["length"]).when(
        x["start"] != y["start"], x["start"] - y["start"]).otherwise(
        x["period"] - y["period"]).cast("int")), F.lit(1))
    lines = F.transform("runs", lambda r: F.concat(
        r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","),
        r["period"].cast("string"), F.lit("\n")))
    top = found.withColumn("_top", longest)
    return top.select(
        "doc_id", "n_words", F.size("runs").cast("long").alias("n_runs"),
        F.col("_top.start").alias("start"), F.col("_top.length").alias("length"),
        F.col("_top.period").alias("period"),
        F.expr("1000 * _top.length div _top.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2(F.coalesce("collapsed", F.lit("")), 256).alias("collapsed_sha256"))
