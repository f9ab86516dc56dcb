"""Change feeds and base tables derived from the driver's parquet tables.

The test data has no captured change log, so one is derived from
``events`` (one change per event, ordered by ``event_id``):

* ``_seq`` = ``event_id``; key ``id`` = ``user_id``, or a key that no base row
  has (``NEW_KEY`` more) where ``event_id % 5 = 0``;
* ``_op`` = D when ``event_id % 97 = 0``, I for ``signup``, U otherwise;
* ``name`` = ``event_type``, ``salary`` = ``value``.

The base ("employee" shaped: id, name, salary) comes from ``customer``.
A feed over a wider key set maps each event onto ``orders``.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.changes import DELETE, INSERT, UPDATE

EMPLOYEE_KEYS = ["id"]
ORDER_KEYS = ["o_orderkey"]

# Fixed values of the derived feed (shared with the oracle SQL).
DELETE_EVERY = 97       # event_id % 97 = 0 -> delete
INSERT_EVENT = "signup"  # this event type is an insert, others update
KEY_SPREAD = 7919       # wide key set: (event_id * 7919) % (5/4 of count(orders))
NEW_KEY_EVERY = 5       # every fifth change is of a key outside the base
NEW_KEY = 1_000_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def op_expr() -> F.Column:
    return (F.when(F.col("event_id") % DELETE_EVERY == 0, F.lit(DELETE))
            .when(F.col("event_type") == INSERT_EVENT, F.lit(INSERT))
            .otherwise(F.lit(UPDATE)))


def employee_changes(spark: SparkSession, sf_dir: str,
                     keep: tuple[str, ...] = ()) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.select(
        *keep,
        F.col("event_id").alias("_seq"),
        F.lit(0).alias("_sub"),
        op_expr().alias("_op"),
        F.when(F.col("event_id") % NEW_KEY_EVERY == 0, F.col("user_id") + NEW_KEY)
        .otherwise(F.col("user_id")).alias("id"),
        F.col("event_type").alias("name"),
        F.col("value").alias("salary"),
    )


def employee_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    cu = table(spark, sf_dir, "customer")
    return cu.select(F.col("c_custkey").alias("id"),
                     F.col("c_name").alias("name"),
                     F.col("c_acctbal").alias("salary"))


def order_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders")


def order_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event rewritten as a change to one order row; the key spreads
    the 10x-smaller event set over the order key space and a quarter more."""
    ev = table(spark, sf_dir, "events")
    n = table(spark, sf_dir, "orders").count()
    return ev.select(
        F.col("event_id").alias("_seq"),
        F.lit(0).alias("_sub"),
        op_expr().alias("_op"),
        ((F.col("event_id") * KEY_SPREAD) % (n + n // 4)).alias("o_orderkey"),
        F.col("user_id").alias("o_custkey"),
        F.substring("event_type", 1, 1).alias("o_orderstatus"),
        F.col("value").alias("o_totalprice"),
        F.col("ts").alias("o_orderdate"),
        F.col("event_type").alias("o_orderpriority"),
    )
