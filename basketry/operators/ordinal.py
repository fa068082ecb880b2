"""A global position for every row of an order, without a single-task window.

The rows are range-partitioned on the order and sorted in their partitions; the
partitions' row counts, one row a partition, give each partition its offset.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry.plans.physical import stable

ROW_IN_PARTITION = (1 << 33) - 1


def numbered(df: DataFrame, order: Sequence[str], out: str = "at") -> tuple[DataFrame, DataFrame]:
    """``df`` with the position ``out`` (from 0) of each row in ``order``, in that order over the partitions.

    Also returned: the checkpointed rows behind it, for ``release``.  Rows that
    tie in ``order`` get neighbouring positions in any order."""
    runs = stable(df.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "*", F.spark_partition_id().alias("__run"),
        F.monotonically_increasing_id().bitwiseAND(F.lit(ROW_IN_PARTITION)).alias("__row")))
    before = Window.orderBy("__run").rowsBetween(Window.unboundedPreceding, -1)
    per_run = runs.groupBy("__run").agg(F.count(F.lit(1)).alias("__n"))
    # One row per partition meets in one task and goes to every other.
    offsets = per_run.select("__run", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    placed = runs.join(F.broadcast(offsets), "__run").withColumn(out, F.col("__before") + F.col("__row"))
    return placed.drop("__run", "__row", "__before"), runs
