"""Classes of similar things from candidate buckets, without all pairs.

``linked_classes`` takes (key, node) rows: nodes that share a key are
candidates. It tests pairs in rounds. In each round every bucket names a few
leaders, members of its smallest classes so far, and each leader is tested
against the bucket's members of other classes. Tested leaders leave the
bucket, and a bucket is done when its members are all of one class. So at the
end any two nodes of a bucket either were tested or are in the same class
already: no link between classes is lost, and a bucket of n similar nodes
costs about n tests for each first leader instead of n * (n - 1) / 2. The
number of leaders grows by a factor each round, which bounds the rounds by
the logarithm of the largest bucket. How many there are at first trades tests
for rounds and changes no result.

``first_links`` is a cheaper pass before the rounds: it finds most of a large
group of similar nodes, and the buckets that hold only that group (``mixed``
tells) never enter a round.

Everything is a DataFrame; rounds are cut by tables in the shared folder.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keelson.llm.common import persisted

SIEVE_BITS = 22
GROWTH = 4
#: Tables of the rounds are far narrower than documents, so they are written by
#: one task for so many shuffle partitions.
NARROW = 8


def components(edges: DataFrame) -> DataFrame:
    """(node, root): connected components by alternating star contractions.

    ``edges``: columns a, b (long). Roots are the least nodes; roots
    themselves are not listed.
    """
    cur = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")) \
        .where("u <> v").distinct()
    mark, of_u = None, Window.partitionBy("u")
    while True:
        both = cur.unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (both.withColumn("m", F.least(F.min("v").over(of_u), "u")).where("v > u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        small = (large.withColumn("m", F.min("v").over(of_u))
                 .select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v"))
                         .alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        cur = persisted(small, "components", narrow=NARROW)
        now = cur.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == mark or not now[0]:
            return cur.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = now


def shared(rows: DataFrame) -> DataFrame:
    """The distinct (key, node) rows whose key has several nodes."""
    ends = rows.groupBy("key").agg(F.min("node").alias("lo"), F.max("node").alias("hi"))
    rows = rows.join(ends.where("lo <> hi").select("key"), "key", "left_semi").distinct()
    return persisted(rows, "shared")


def first_links(rows: DataFrame, verify: Callable[[DataFrame], DataFrame],
                near: Callable[[str, str], Column]) -> DataFrame:
    """(node, root) after each node of a bucket was tested against the least one.

    ``rows``: key, node and the columns that ``near`` looks at. One partial
    aggregate names the leaders, and a group of similar nodes costs one pair
    for each node and leader, whatever the number of its buckets.
    """
    more = [c for c in rows.columns if c not in ("key", "node")]
    lead = rows.groupBy("key").agg(F.min(F.struct("node", *more)).alias("lead"),
                                   F.max("node").alias("hi")).where("lead.node <> hi")
    lead = lead.select("key", "lead.*")
    meet = (F.col("r.key") == F.col("l.key")) & (F.col("r.node") != F.col("l.node"))
    pairs = (rows.alias("r").join(lead.alias("l"), meet & near("r", "l"))
             .select(F.col("l.node").alias("a"), F.col("r.node").alias("b")).distinct())
    return components(persisted(verify(persisted(pairs, "pairs", narrow=NARROW)), "links"))


def mixed(rows: DataFrame) -> DataFrame:
    """The distinct rows of (key, node, class, ...) whose key has several classes."""
    ends = rows.groupBy("key").agg(F.min("class").alias("lo"), F.max("class").alias("hi"))
    return rows.join(ends.where("lo <> hi").select("key"), "key", "left_semi").distinct()


def linked_classes(rows: DataFrame, verify: Callable[[DataFrame], DataFrame],
                   leaders: int = 2, near: Callable[[str, str], Column] | None = None,
                   growth: int = GROWTH, roots: DataFrame | None = None) -> DataFrame:
    """(node, root) of the nodes that are not their class's least node.

    ``rows``: key, node (long), distinct (``shared``). ``verify`` gets a DataFrame of pairs (a, b)
    with a < b and returns those that are linked. ``leaders``: of each bucket
    in the first round; ``growth``: how many times as many in the next. ``near``: a necessary
    condition of a link, on more columns of ``rows`` (it gets the aliases of the two sides); pairs
    that fail it are settled inside the join and never made. ``roots``: links known already, as
    (node, root) of ``first_links``; then ``rows`` has the column class too (``mixed``).
    """
    known = roots is not None
    more = [c for c in rows.columns if c not in ("key", "node", "class")]
    rows = persisted(rows.select("key", "node", F.col("class" if known else "node").alias("class"),
                                 *more), "buckets")
    tested = None
    while not rows.isEmpty():
        sized = rows.withColumn("class_size", F.count("*").over(
            Window.partitionBy("key", "class")) if tested is not None or known else F.lit(1))
        order = Window.partitionBy("key").orderBy("class_size", "class", "node")
        lead = (sized.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= leaders)
                .select("key", F.col("node").alias("lead"), F.col("class").alias("lead_class"), *more))
        lead = persisted(lead, "leaders", narrow=NARROW)
        meet = (F.col("r.key") == F.col("l.key")) & (F.col("class") != F.col("lead_class"))
        if near is not None:
            meet = meet & near("r", "l")
        pairs = (rows.alias("r").join(lead.alias("l"), meet)
                 .select(F.least("node", "lead").alias("a"), F.greatest("node", "lead").alias("b"))
                 .distinct())
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = persisted(pairs, "pairs", narrow=NARROW)
        tested = pairs if tested is None else tested.unionByName(pairs)
        found = persisted(verify(pairs), "links")
        edges = found if roots is None else found.unionByName(
            roots.select(F.col("root").alias("a"), F.col("node").alias("b")))
        roots = components(edges)
        left = rows.join(lead.select("key", F.col("lead").alias("node")), ["key", "node"],
                         "left_anti").drop("class").join(roots, "node", "left")
        left = left.select("key", "node", F.coalesce("root", "node").alias("class"), *more)
        open_ = left.groupBy("key").agg(F.min("class").alias("lo"), F.max("class").alias("hi"))
        rows = persisted(left.join(open_.where("lo <> hi").select("key"), "key", "left_semi"),
                         "buckets", narrow=NARROW)
        leaders *= growth
    if roots is None:
        return rows.select("node", F.col("class").alias("root"))
    return roots


def sieve(nodes: DataFrame, hashed: bool = False) -> np.ndarray:
    """A table of ``2**SIEVE_BITS`` flags that is set for every node (and, by
    chance, for some others). Its size does not depend on the data. Nodes that
    are hashes already (``hashed``) take the slot of their low bits."""
    slot = F.col("node").bitwiseAND(F.lit((1 << SIEVE_BITS) - 1)) if hashed \
        else sieve_slot("node").cast("long")
    rows = (nodes.select(slot.alias("s")).groupBy(F.shiftright("s", 6).alias("w"))
            .agg(F.bit_or(F.expr("shiftleft(1L, cast(s & 63 as int))")).alias("bits")).collect())
    flags = np.zeros(1 << (SIEVE_BITS - 6), np.int64)
    for r in rows:
        flags[r.w] = r.bits
    return np.unpackbits(flags.view(np.uint8), bitorder="little").astype(bool)


def sieve_slot(node: str) -> Column:
    return F.xxhash64(node).bitwiseAND(F.lit((1 << SIEVE_BITS) - 1)).cast("int")
