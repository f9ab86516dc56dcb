"""Values carried forward along a feed (S5) and lineage of moved keys (X1),
against plain Python replays."""

import random

import pytest
from pyspark.sql import functions as F

from keelson.operators import unchanged as un
from keelson.operators.asof import carry_forward
from keelson.operators.unchanged import apply_with_unchanged


def in_force(rows, versions, inclusive):
    out = []
    for k, p, n in rows:
        best = [None, None]
        if k is not None and p is not None:
            for vk, vp, a, b in sorted(versions, key=lambda v: (v[1] is None, v[1])):
                if vk == k and vp is not None and (vp < p or (inclusive and vp == p)):
                    best = [a if a is not None else best[0], b if b is not None else best[1]]
        out.append((k, p, n, *best))
    return sorted(out, key=str)


@pytest.mark.parametrize("inclusive", [True, False])
def test_carry_forward_matches_replay(spark, inclusive):
    rnd = random.Random(4)
    key = lambda: rnd.choice(["hot"] * 6 + ["a", "b", None])
    rows = [(key(), rnd.choice([rnd.randint(0, 400), None, 7]), n) for n in range(600)]
    seen, versions = set(), []
    for _ in range(150):
        v = (key(), rnd.randint(0, 400))
        if v not in seen:
            seen.add(v)
            versions.append((*v, rnd.choice([None, rnd.random()]), rnd.choice([None, "x", "y"])))
    left = spark.createDataFrame(rows, "k string, p long, n long")
    right = spark.createDataFrame(versions, "k string, p long, a double, b string")
    for ranges in (1, 7):
        got = carry_forward(left, right, ["k"], ["p"], ["a", "b"], inclusive, ranges)
        assert got.columns == ["k", "p", "n", "a", "b"]
        assert sorted(map(tuple, got.collect()), key=str) == in_force(rows, versions, inclusive)


def test_carry_forward_of_nothing(spark):
    left = spark.createDataFrame([(1, 2)], "k long, p long")
    right = spark.createDataFrame([], "k long, p long, v string")
    assert carry_forward(left, right, ["k"], ["p"], ["v"]).collect() == [(1, 2, None)]
    assert carry_forward(left.limit(0), right, ["k"], ["p"], ["v"]).collect() == []


def test_one_key_with_many_versions_is_spread(spark):
    """One key holds everything: 100,000 rows, 10,000 versions, eight ranges."""
    rows = spark.range(100_000).select(F.lit(7).alias("oid"), (F.col("id") * 10 + 5).alias("_seq"))
    versions = spark.range(10_000).select(
        F.lit(7).alias("oid"), (F.col("id") * 100).alias("_seq"),
        F.struct(F.col("id").alias("n")).alias("v"))
    got = carry_forward(rows, versions, ["oid"], ["_seq"], ["v"], ranges=8)
    assert got.where(F.col("v.n") != F.floor(F.col("_seq") / 100)).count() == 0
    assert got.where("v is not null").count() == 100_000
    per_task = [r[0] for r in got.groupBy(F.spark_partition_id()).count().select("count").collect()]
    assert len(per_task) > 1
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "oid" not in "".join(line for line in plan.splitlines() if "Join" in line)


# -- moved keys ----------------------------------------------------------------

CHANGE = ("_seq long, _sub int, _op string, id long, name string, salary double, "
          "_unchanged array<string>, _from struct<id: long>")


def replay(base, events):
    """events: (seq, op, id, name, salary, unchanged, old id or None)."""
    value, alive = {k: list(v) for k, v in base.items()}, set(base)
    for _, op, key, name, salary, left, old in sorted(events, key=lambda e: e[0]):
        before = list(value.get(key if old is None else old, [None, None]))
        if old is not None:
            value[old] = [None, None]
            alive.discard(old)
        if op == "D":
            value[key] = [None, None]
            alive.discard(key)
            continue
        new = [name, salary]
        value[key] = [before[i] if c in left else new[i] for i, c in enumerate(("name", "salary"))]
        alive.add(key)
    return sorted((k, *value[k]) for k in alive)


def change_rows(events):
    out = []
    for seq, op, key, name, salary, left, old in events:
        vals = [None if "name" in left else name, None if "salary" in left else salary]
        if old is None:
            out.append((seq, 0, op, key, *vals, left, None))
        else:
            out.append((seq, 0, "D", old, None, None, [], None))
            out.append((seq, 1, "I", key, *vals, left, (old,)))
    return out


def applied(spark, base, events):
    b = spark.createDataFrame([(k, *v) for k, v in base.items()], "id long, name string, salary double")
    ch = spark.createDataFrame(change_rows(events), CHANGE)
    return sorted(map(tuple, apply_with_unchanged(b, ch, ["id"]).collect()))


@pytest.mark.parametrize("seed", range(4))
def test_moves_match_replay(spark, seed):
    rnd = random.Random(seed)
    base = {k: (f"n{k}", float(k)) for k in range(5)}
    alive, events, fresh = set(base), [], 100
    for seq in range(1, 160):
        left = [c for c in ("name", "salary") if rnd.random() < 0.5]
        name, salary = f"v{seq}", float(seq)
        kind = rnd.random()
        if kind < 0.5 and alive:
            old = rnd.choice(sorted(alive))
            key = fresh if rnd.random() < 0.6 else rnd.choice([fresh, *range(5)])
            if key in alive:
                key = fresh
            fresh += 1
            alive.discard(old)
            alive.add(key)
            events.append((seq, "U", key, name, salary, left, old))
        elif kind < 0.65 and alive:
            key = rnd.choice(sorted(alive))
            alive.discard(key)
            events.append((seq, "D", key, None, None, [], None))
        elif kind < 0.85 and alive:
            events.append((seq, "U", rnd.choice(sorted(alive)), name, salary, left, None))
        else:
            key = rnd.choice(range(8))
            if key not in alive:
                alive.add(key)
                events.append((seq, "I", key, name, salary, [], None))
    assert applied(spark, base, events) == replay(base, events)


def test_chain_of_a_thousand_moves_takes_few_rounds(spark, monkeypatch):
    """Pointers double: 1,000 moves in a row end after at most 11 rounds."""
    rounds, real = [], un.resolve_pointers
    monkeypatch.setattr(un, "resolve_pointers", lambda p: real(p, rounds.append))
    base = {0: ("first", 0.5)}
    events = [(s, "U", s, None, float(s), ["name"], s - 1) for s in range(1, 1001)]
    assert applied(spark, base, events) == [(1000, "first", 1000.0)]
    assert 1 <= len(rounds) <= 11


def test_moves_of_a_hot_key_make_no_quadratic_rows(spark):
    """100,000 changes of one key, 1,000 of them followed by a move away and
    back: what is carried to the moves grows with the changes, not their product."""
    n = 100_000
    ch = spark.range(1, n + 1).select(
        F.col("id").alias("_seq"), F.lit(0).alias("_sub"), F.lit("U").alias("_op"),
        F.lit(1).cast("long").alias("id"), F.concat(F.lit("v"), "id").alias("name"),
        F.col("id").cast("double").alias("salary"), F.array().cast("array<string>").alias("_unchanged"),
        F.lit(None).cast("struct<id: long>").alias("_from"))
    moves = spark.range(1, 1001).select((F.col("id") * 100 + 0).alias("_seq"), F.inline(F.array(
        F.struct(F.lit(1).alias("_sub"), F.lit("I").alias("_op"), (F.col("id") + 10).alias("id"),
                 F.lit(None).cast("string").alias("name"), F.lit(0.0).alias("salary"),
                 F.array(F.lit("name")).alias("_unchanged"),
                 F.struct(F.lit(1).cast("long").alias("id")).alias("_from")))))
    both = ch.unionByName(moves)
    got = un.move_pointers(both, ["id"], ["name", "salary"])
    assert got.count() == 1000
    assert got.where(F.col("_end_seq") != F.col("_node_seq") - 1).count() == 0
