"""The value in force at a position, carried forward.

An as-of join without a join on the key: rows and versions are put into one
order of (key, position) and cut into ranges, the last version of each range
is carried over to the ranges behind it by a table of one row for each range,
and inside a range the last version so far is looked up by a window. The cost
is rows plus versions, whatever the number of versions of a key, and a key
that holds most rows is spread over many ranges like any other.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .sizing import materialize


def carry_forward(rows: DataFrame, versions: DataFrame, by: Sequence[str],
                  at: Sequence[str], values: Sequence[str], inclusive: bool = True,
                  ranges: int | None = None) -> DataFrame:
    """``rows`` with the columns ``values`` (structs or simple values) of
    ``versions`` that are in force at the row's position ``at`` for its key
    ``by``. Each value is carried on its own: a version in which it is NULL
    leaves it as it was. A row without an earlier version gets NULL, and so
    does a row with a NULL key or position.

    ``inclusive``: a version at a row's own position counts for it. Versions
    of one key and position should be one; of several, the last non-NULL value
    in the order of the values themselves counts. ``ranges``: their number
    (default: as the session's shuffle partitions and sizes say).
    """
    by, at, values = list(by), list(at), list(values)
    keys = [f"_by{i}" for i in range(len(by))]
    spots = [f"_at{i}" for i in range(len(at))]
    found = [f"_v{i}" for i in range(len(values))]

    def laid(df: DataFrame, tag: int, row: Column, vals: list[Column]) -> DataFrame:
        return df.select(*[F.col(c).alias(k) for c, k in zip(by + at, keys + spots)],
                         F.lit(tag).alias("_tag"), row.alias("_row"),
                         *[v.alias(n) for v, n in zip(vals, found)])

    def known(c: str) -> Column:
        return F.col(c).isNotNull()

    kinds = [versions.schema[v].dataType for v in values]
    no_row = F.lit(None).cast(rows.select(F.struct(*rows.columns).alias("r")).schema["r"].dataType)
    usable = reduce(lambda a, b: a & b, [known(c) for c in by + at])
    both = laid(rows, 1 if inclusive else 0, F.struct(*rows.columns),
                [F.lit(None).cast(k) for k in kinds]).unionByName(
        laid(versions.where(usable), 0 if inclusive else 1, no_row,
             [F.col(v) for v in values]))
    order = [F.col(c) for c in (*keys, *spots, "_tag")]
    ranged = both.repartitionByRange(ranges, *order) if ranges else \
        both.repartitionByRange(*order)
    cut = materialize(ranged.withColumn("_range", F.spark_partition_id()))

    # The last value of each range and its key: what the ranges behind it
    # start with, if they go on with that key.
    place = F.struct(*order)
    key = F.struct(*keys)
    last = cut.groupBy("_range").agg(*[
        F.max_by(F.when(known(v), F.struct(key.alias("key"), F.col(v).alias("value"))),
                 F.when(known(v), place)).alias(f"_last{v}") for v in found])
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    carried = last.select("_range", *[
        F.last(f"_last{v}", ignorenulls=True).over(before).alias(f"_carry{v}") for v in found])

    so_far = (Window.partitionBy("_range").orderBy(*order)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    own_key = reduce(lambda a, b: a & b, [known(k) for k in keys])
    own_spot = reduce(lambda a, b: a & b, [known(s) for s in spots])
    out = cut.join(carried, "_range")
    out = out.withColumns({f"_here{v}": F.last(F.when(known(v), F.struct(
        key.alias("key"), F.col(v).alias("value"))), ignorenulls=True).over(so_far)
        for v in found})

    def value(v: str) -> Column:
        best = F.coalesce(F.col(f"_here{v}"), F.col(f"_carry{v}"))
        return F.when(own_key & own_spot & (best["key"] == key), best["value"])

    return out.where(F.col("_row").isNotNull()).select(
        "_row.*", *[value(v).alias(name) for v, name in zip(found, values)])
