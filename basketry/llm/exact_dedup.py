"""Exact dedup with a heavy-hitter split.

1. One text scan turns each row into ``(doc_id, digest)`` (SHA-256), checkpointed.
2. A frequent-items sketch finds the frequent digests: Spark's ``approx_top_k``
   keeps Misra-Gries counters (new items decrement all counters when the table
   is full), is filled map-side and merges, so nothing but the sketch moves.
3. The candidates' groups are counted exactly (map-side partial sums, at most
   ``tracked`` rows per task): these verified winners are broadcast, and rows
   of frequent digests are decided map-side without being shuffled.
4. The remaining digests use one ordinary shuffle and a window.

The broadcast has at most ``top`` rows, whatever the input size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm.common import durable, utf8, whole_text

TOP = 1024
TRACKED = 16384


def exact_groups(docs: DataFrame, top: int = TOP, tracked: int = TRACKED) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256``: one row per input row.

    Texts are equal when their UTF-8 bytes are; a null text counts as empty.
    The row with the largest doc_id of a group stays (nulls are smallest; a
    group of only null ids has a null ``keep_id`` and keeps its rows).  Input
    rows that repeat a doc_id with the same text carry the same decision.
    Other columns are not read; an empty table gives no rows.
    """
    rows = durable(docs.select(
        "doc_id", F.unhex(F.sha2(utf8(whole_text()), 256)).alias("digest")))
    frequent = (rows.agg(F.expr(f"approx_top_k(hex(digest), {top}, {tracked})").alias("found"))
                .select(F.explode("found").alias("f"))
                .select(F.unhex("f.item").alias("digest")))
    group = [F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")]
    winners = durable(
        rows.join(F.broadcast(frequent), "digest").groupBy("digest").agg(*group)
        .where(F.col("group_size") > 1))
    split = rows.join(F.broadcast(winners), "digest", "left")
    hot = split.where(F.col("group_size").isNotNull())
    same = Window.partitionBy("digest")
    rest = split.where(F.col("group_size").isNull()).select("doc_id", "digest").select(
        "doc_id", "digest", F.max("doc_id").over(same).alias("keep_id"),
        F.count(F.lit(1)).over(same).alias("group_size"))
    return hot.select(rest.columns).union(rest).select(
        "doc_id", "keep_id", F.col("group_size").cast("long").alias("group_size"),
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))


def exact_dedup(docs: DataFrame, **params) -> DataFrame:
    """The documents that stay, with all their columns.

    Rows repeating a kept doc_id with the same text all stay."""
    keep = exact_groups(docs, **params).where("kept").select(
        F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__sha")).distinct()
    on = docs["doc_id"].eqNullSafe(keep["__id"]) & (F.sha2(utf8(whole_text()), 256) == keep["__sha"])
    return docs.join(keep, on, "left_semi")
