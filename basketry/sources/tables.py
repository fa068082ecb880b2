"""Basket views over the parquet tables (transaction pairs with repeats).

Each view returns raw ``(basket, item)`` rows, one per source row; repeats are
kept so that row-count filters see them.  Only the needed columns are read,
so the parquet scans prune columns.  Dimension joins are left to the planner:
AQE broadcasts ``part`` only when its runtime size is under the threshold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def order_brand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Basket = order, item = brand of each line's part."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    return li.join(part, li.l_partkey == part.p_partkey).select(
        F.col("l_orderkey").alias("basket"), F.col("p_brand").alias("item"))


def part_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inverted view: basket = part, item = supplier key as text."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.col("l_partkey").alias("basket"), F.col("l_suppkey").cast("string").alias("item"))


def day_user_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Composite basket ``date-user`` over events, item = event type."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.concat_ws("-", F.to_date("ts").cast("string"), F.col("user_id").cast("string")).alias("basket"),
        F.col("event_type").alias("item"))


def date_customer_brand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Retail-style view: basket = ``order date-customer``, item = brand."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    j = li.join(o, li.l_orderkey == o.o_orderkey).join(part, li.l_partkey == part.p_partkey)
    return j.select(
        F.concat_ws("-", F.to_date("o_orderdate").cast("string"), F.col("o_custkey").cast("string")).alias("basket"),
        F.col("p_brand").alias("item"))


def event_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events rendered as quoted retail-style text lines (``value`` column):
    field 0 date, field 1 user, field 5 event type; used to exercise the
    positional parser on table-derived text."""
    ev = table(spark, sf_dir, "events")

    def q(c):
        return F.concat(F.lit('"'), c.cast("string"), F.lit('"'))

    return ev.select(F.concat_ws(",", q(F.to_date("ts")), q(F.col("user_id")), q(F.lit("")),
                                 q(F.lit("")), q(F.lit("")), q(F.col("event_type"))).alias("value"))


def customer_part(spark: SparkSession, d: str) -> DataFrame:
    """Basket = customer, item = part: more possible pairs of items than pairs that occur."""
    li = table(spark, d, "lineitem").select("l_orderkey", "l_partkey")
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    return li.join(o, li["l_orderkey"] == o["o_orderkey"]).select(
        F.col("o_custkey").alias("basket"), F.col("l_partkey").cast("string").alias("item"))
