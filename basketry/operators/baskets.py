"""Baskets: projections to (basket, item) pairs, the basket table, size filter,
chunk assignment.

The mining operators work on pairs, never on collected basket arrays, so a
basket that holds a large share of all rows is never one value in one task.
``basket_table`` is the display view of the reference's basket lists, one basket a
row; ``basket_segments`` is the same in rows of bounded length.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from basketry.functions.columns import chunk_of, composite_key
from basketry.operators.ordinal import numbered
from basketry.plans.physical import release, stable

# Stands for a null integer basket key.
NULL_KEY = -(2 ** 63)
# Items in a row of basket_segments.
SEGMENT_ITEMS = 4096


def make_pairs(df: DataFrame, basket_cols: str | Sequence[str], item_col: str) -> DataFrame:
    """Project raw rows to ``(basket, item)``; several basket columns form a
    composite key joined by '-'.  Items are text; nulls become '' (the
    reference keeps empty fields as items)."""
    if isinstance(basket_cols, str):
        basket_cols = [basket_cols]
    if not basket_cols:
        raise ValueError("at least one basket column is needed")
    if len(basket_cols) == 1:
        basket = F.col(basket_cols[0])
    else:
        basket = composite_key(*[F.col(c).cast("string") for c in basket_cols])
    return df.select(basket.alias("basket"),
                     F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"))


def normalised_pairs(pairs: DataFrame) -> DataFrame:
    """Pairs as every strategy reads them: items are text, and no key is null.

    A null item is the empty item.  Null baskets are one basket: the empty key
    among text keys, the smallest long among integer keys."""
    if isinstance(pairs.schema["basket"].dataType, IntegralType):
        basket = F.coalesce(F.col("basket").cast("bigint"), F.lit(NULL_KEY).cast("bigint"))
    else:
        basket = F.coalesce(F.col("basket").cast("string"), F.lit(""))
    return pairs.withColumns({"basket": basket, "item": F.coalesce(F.col("item").cast("string"), F.lit(""))})


def row_weight(pairs: DataFrame) -> Column:
    """Raw rows behind each input row: 1 for raw pairs, ``n_rows`` for pairs
    that are already aggregated (``prepared_pairs``)."""
    return F.sum("n_rows") if "n_rows" in pairs.columns else F.count(F.lit(1))


def distinct_pairs(pairs: DataFrame, *group: str) -> DataFrame:
    """Distinct ``(basket, [group..], item)`` with the number of raw rows behind each.

    A partial (map-side) aggregate runs before the shuffle, so hot keys are
    combined early.  Already aggregated input is summed, not counted."""
    return pairs.groupBy("basket", *group, "item").agg(row_weight(pairs).alias("n_rows"))


def prepared_pairs(pairs: DataFrame, min_rows: int | None = None) -> DataFrame:
    """Distinct ``(basket, item, n_rows)`` of the kept baskets, materialised once.

    Keeps the baskets with **more than** ``min_rows`` rows; the row count
    includes repeated items.  The source scan, its joins and the filter run
    once, whatever reads the baskets afterwards.  The source joins stay
    adaptive (AQE splits skewed keys), so the partitioning is not pinned."""
    d = distinct_pairs(normalised_pairs(pairs))
    if min_rows is not None:
        keep = (d.groupBy("basket").agg(F.sum("n_rows").alias("r"))
                .where(F.col("r") > F.lit(int(min_rows))).select("basket"))
        d = d.join(keep, "basket", "left_semi")
    return stable(d)


def basket_sizes(pairs: DataFrame) -> DataFrame:
    """Per basket: raw row count (repeats included) and distinct item count."""
    return (distinct_pairs(pairs).groupBy("basket")
            .agg(F.sum("n_rows").alias("n_rows"), F.count(F.lit(1)).alias("n_items")))


def basket_table(pairs: DataFrame) -> DataFrame:
    """``(basket, n_rows, n_items, items)`` with ``items`` sorted and distinct.

    This is the display form of a basket; the array holds one basket's
    distinct items, built from the already-distinct pairs."""
    d = distinct_pairs(pairs)
    return d.groupBy("basket").agg(
        F.sum("n_rows").alias("n_rows"),
        F.count(F.lit(1)).alias("n_items"),
        F.array_sort(F.collect_list("item")).alias("items"),
    )


def basket_segments(pairs: DataFrame, width: int = SEGMENT_ITEMS) -> DataFrame:
    """``(basket, segment, n_rows, items)``: each basket's sorted distinct items, ``width`` a row.

    Segments count from 0 in a basket; all but its last are full.  ``n_rows`` counts
    the raw rows behind a segment's items.  An item's place in its basket comes from
    a distributed ordinal over (basket, item), so a basket with a third of all rows
    is spread over the partitions like the rest, and no array is longer than ``width``."""
    if width < 1:
        raise ValueError("width must be at least 1")
    d = distinct_pairs(normalised_pairs(pairs)).select("basket", "item", "n_rows")
    rows, held = numbered(d, ["basket", "item"])
    starts = rows.groupBy("basket").agg(F.min("at").alias("start"))  # pre-aggregated in each task
    placed = rows.join(starts, "basket").withColumn("segment", F.expr(f"(at - start) div {int(width)}"))
    out = stable(placed.groupBy("basket", "segment").agg(
        F.sum("n_rows").alias("n_rows"), F.array_sort(F.collect_list("item")).alias("items")))
    release(held)
    return out


def assign_chunk(pairs: DataFrame, p: int, method: str = "auto") -> DataFrame:
    """Add the logical ``chunk`` column (a function of the basket key)."""
    dtype = pairs.schema["basket"].dataType
    return pairs.withColumn("chunk", chunk_of(F.col("basket"), p, method, dtype))


def chunk_sizes(pairs: DataFrame, p: int, method: str = "auto") -> DataFrame:
    """Per chunk: baskets, distinct pairs and raw rows."""
    d = assign_chunk(distinct_pairs(pairs), p, method)
    return d.groupBy("chunk").agg(
        F.countDistinct("basket").alias("n_baskets"),
        F.count(F.lit(1)).alias("n_pairs"),
        F.sum("n_rows").alias("n_rows"),
    )


def chunk_item_counts(pairs: DataFrame, support: int, p: int, method: str = "auto",
                      count_repeats: bool = True) -> DataFrame:
    """Local singleton counts per chunk with the scaled threshold ``n * p >= s``.

    With ``count_repeats`` an item repeated inside a basket counts each time,
    as in the reference's first pass; otherwise each basket counts once."""
    d = assign_chunk(distinct_pairs(pairs), p, method)
    n = F.sum("n_rows") if count_repeats else F.count(F.lit(1))
    return (d.groupBy("chunk", "item").agg(n.alias("n"))
            .where(F.col("n") * F.lit(p) >= F.lit(support)))
