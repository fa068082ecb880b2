"""FP-growth from Spark's ML library, as a cross-check of the other strategies.

MLlib keeps itemsets with ``freq >= ceil(minSupport * n)``; ``minSupport`` is
set to ``(s - 0.5) / n`` so that the ceiling is exactly ``s``.  It needs each
basket as an array of distinct items, so the widest basket is counted first,
on the distinct pairs: a basket wider than ``tuning.hot_basket_items`` is an
error, before any array is built.  The other strategies have no such bound.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.operators.baskets import distinct_pairs, normalised_pairs
from basketry.operators.levels import ITEMSET_SCHEMA
from basketry.plans.physical import DEFAULT_TUNING, Tuning, release, stable


def mine_fpgrowth(pairs: DataFrame, support: int, num_partitions: int | None = None,
                  tuning: Tuning = DEFAULT_TUNING) -> DataFrame:
    from pyspark.ml.fpm import FPGrowth

    if support < 1:
        raise ValueError("support must be at least 1")
    empty = pairs.sparkSession.createDataFrame([], ITEMSET_SCHEMA)
    dist = stable(distinct_pairs(normalised_pairs(pairs)).select("basket", "item"))
    width = dist.groupBy("basket").agg(F.count(F.lit(1)).alias("w"))
    n, widest = width.agg(F.count(F.lit(1)), F.max("w")).first()
    if n == 0 or support > n:
        return empty
    if widest > tuning.hot_basket_items:
        raise ValueError(f"a basket of {widest} items is too wide for fpgrowth (limit {tuning.hot_basket_items}); "
                         "use strategy 'levels' or 'son'")
    fp = FPGrowth(itemsCol="items", minSupport=(support - 0.5) / n, minConfidence=1.0)
    if num_partitions:
        fp = fp.setNumPartitions(num_partitions)
    baskets = dist.groupBy("basket").agg(F.collect_list("item").alias("items")).select("items").persist()
    out = stable(fp.fit(baskets).freqItemsets.select(
        F.size("items").cast("int").alias("k"), F.array_sort("items").alias("itemset"),
        F.col("freq").cast("long").alias("support")).where(F.col("support") >= F.lit(support)))
    baskets.unpersist()
    release(dist)
    return empty.union(out)
