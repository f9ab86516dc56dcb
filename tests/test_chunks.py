"""Chunked snapshot under a live feed against a replay, for any interleaving."""

import random

import pytest

from keelson.operators.apply import apply_changes
from keelson.operators.chunks import interleave, standing_rows

FEED = "_seq long, _op string, id long, name string"
CHUNK = "id long, name string, _low long, _high long"


@pytest.mark.parametrize("seed", range(4))
def test_any_interleaving_equals_the_source(spark, seed):
    rnd = random.Random(seed)
    state, seq, changes, chunks = {k: f"n{k}" for k in range(40)}, 0, [], []

    def happen(n):
        nonlocal seq
        for _ in range(n):
            seq += 1
            key, op = rnd.choice([3, rnd.randint(0, 60)]), rnd.choice("IUUD")
            changes.append((seq, op, key, None if op == "D" else f"v{seq}"))
            state.pop(key, None)
            if op != "D":
                state[key] = f"v{seq}"

    ranges = [(-1, 9), (10, 24), (25, 100)]
    rnd.shuffle(ranges)
    for lo, hi in [*ranges, ranges[0]]:  # one chunk is read again
        happen(rnd.randint(0, 15))
        low = seq
        happen(rnd.randint(0, 15))
        rows = [(k, v) for k, v in state.items() if lo <= k <= hi]
        happen(rnd.randint(0, 15))
        chunks += [(k, v, low, seq) for k, v in rows]
    happen(rnd.randint(0, 10))
    feed = interleave(spark.createDataFrame(chunks, CHUNK), spark.createDataFrame(changes, FEED), ["id"])
    empty = spark.createDataFrame([], "id long, name string")
    got = {r.id: r.name for r in apply_changes(empty, feed, ["id"]).collect()}
    assert got == state
    # in two parts, cut anywhere
    cut = rnd.randint(0, seq)
    first = apply_changes(empty, feed.where(f"_seq <= {cut}"), ["id"])
    both = apply_changes(first, feed.where(f"_seq > {cut}"), ["id"])
    assert {r.id: r.name for r in both.collect()} == state


def test_edges_of_the_window(spark):
    chunks = spark.createDataFrame([(k, "x", 10, 20) for k in range(1, 6)], CHUNK)
    changes = spark.createDataFrame(
        [(10, "U", 1, "a"), (11, "U", 2, "a"), (20, "U", 3, "a"), (21, "U", 4, "a")], FEED)
    assert sorted(r.id for r in standing_rows(chunks, changes, ["id"]).collect()) == [1, 4, 5]
    none = spark.createDataFrame([], FEED)
    assert standing_rows(chunks, none, ["id"]).count() == 5
    assert standing_rows(chunks.limit(0), changes, ["id"]).count() == 0
