"""Benchmark decontamination as a prefix-filtered set join.

An item's windows (``WINDOW`` consecutive words; a shorter item is one window)
are sets of word shingles, and a document contains a window when it contains
all of them in place.  For containment the necessary prefix of a window under
any global order is one shingle, so

1. one pass over the documents joins their shingles with the items' shingles
   and keeps, for each match, the words around it (at most two windows);
2. the matches give every shingle's document-side frequency: shingles are
   ordered by rarity and each window's prefix is its rarest shingle (a window
   with a shingle that no document has cannot occur and is dropped);
3. matches meet the windows on the prefix shingle alone; the length and
   positional bounds (the window must begin at word 0 or later and end by the
   document's last word) discard candidates before
4. the words themselves are compared over the item-sized window.

The items' side is broadcast when its measured size allows, else shuffled.
All steps are DataFrame functions.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm.common import ascii_lower, durable, fits, small, text_key, whole_text

WINDOW = 10
SHINGLE = 3
WORD_BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
RAW_BREAK = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"  # before lower-casing


def words_of(col: str = "text") -> Column:
    return F.array_remove(F.split(ascii_lower(whole_text(col)), WORD_BREAK), "")


def _shingles(size: int) -> Column:
    """Hash of the ``size`` words from each position of ``words`` that has so many."""
    def one(word: Column, at: Column) -> Column:
        return F.xxhash64(word, *[F.get("words", at + i) for i in range(1, size)])
    return F.transform(F.slice("words", F.lit(1), F.greatest(F.size("words") - (size - 1), F.lit(0))), one)


def item_windows(items: DataFrame, window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """Distinct windows ``(wid, wwords, wlen)`` and their items ``(wid, item_id)``."""
    length = F.least(F.size("words"), F.lit(window))
    cut = (items.select("item_id", words_of().alias("words")).where(F.size("words") > 0)
           .select("item_id", "words", length.alias("wlen"),
                   F.explode(F.sequence(F.lit(1), F.size("words") - length + 1)).alias("at"))
           .select("item_id", F.slice("words", F.col("at"), F.col("wlen")).alias("wwords"), "wlen").distinct())
    cut = durable(cut)
    windows = durable(cut.select("wwords", "wlen").distinct()
                      .select(F.monotonically_increasing_id().alias("wid"), "wwords", "wlen"))
    owners = durable(cut.join(windows, ["wwords", "wlen"]).select("wid", "item_id").distinct())
    return windows, owners


def _matches(docs: DataFrame, grams: DataFrame, size: int, window: int) -> DataFrame:
    """Every document shingle that an item has, with the words that may be needed around it."""
    base = docs.select("doc_id", text_key().alias("th"), words_of().alias("words"))
    base = base.select("doc_id", "th", "words", F.size("words").alias("n"), _shingles(size).alias("grams"))
    # The outer form keeps the optimiser from filtering on the array's size, which would
    # move the shingling below the word split and split again for every word.
    each = base.select("doc_id", "th", "words", "n", F.posexplode_outer("grams").alias("pos", "gram"))
    begin = F.greatest(F.col("pos") - (window - size), F.lit(0))
    around = F.slice("words", begin + 1, F.lit(2 * window - size))
    local = fits(grams, F.lit(64))
    if not local:  # the words must travel, so cut them first
        each = each.select("doc_id", "th", "n", "pos", "gram", begin.alias("from"), around.alias("around"))
        return each.join(grams, "gram", "left_semi")
    each = each.join(F.broadcast(grams), "gram")
    return each.select("doc_id", "th", "n", "pos", "gram", begin.alias("from"), around.alias("around"))


def occurrences(docs: DataFrame, windows: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, th, start, wlen, wid``: where the windows occur in the documents (words from 0)."""
    sizes = [r[0] for r in windows.select(F.least("wlen", F.lit(shingle)).alias("s")).distinct().collect()]
    found = []
    for size in sorted(sizes):  # at most ``shingle`` sizes; only items shorter than that need more than one
        fit = F.col("wlen") >= size if size == shingle else F.col("wlen") == size
        mine = windows.where(fit).select("wid", "wlen", F.col("wwords").alias("words"))
        grams = durable(mine.select("wid", "wlen", F.posexplode(_shingles(size)).alias("off", "gram")))
        matches = durable(_matches(docs, durable(grams.select("gram").distinct()), size, window))
        rarity = matches.groupBy("gram").agg(F.count(F.lit(1)).alias("freq"))
        order = F.struct("freq", "off", "gram")
        prefix = (grams.join(rarity, "gram").groupBy("wid", "wlen")
                  .agg(F.count(F.lit(1)).alias("known"), F.min(order).alias("rarest"))
                  .where(F.col("known") == F.col("wlen") - (size - 1))
                  .select("wid", "wlen", F.col("rarest.gram").alias("gram"), F.col("rarest.off").alias("off")))
        prefix = durable(prefix.join(windows.select("wid", "wwords"), "wid"))
        start = F.col("pos") - F.col("off")
        candidates = matches.join(small(prefix, F.lit(64) + 16 * F.col("wlen")), "gram").where(
            (start >= 0) & (start + F.col("wlen") <= F.col("n")))
        found.append(candidates.where(
            F.slice("around", start - F.col("from") + 1, F.col("wlen")) == F.col("wwords")
        ).select("doc_id", "th", start.alias("start"), "wlen", "wid"))
    if not found:
        key = docs.select("doc_id", text_key().alias("th")).limit(0)
        return key.selectExpr("doc_id", "th", "0 as start", "0 as wlen", "0L as wid")
    return reduce(DataFrame.union, found)


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated``: one row per input row.

    Null and empty texts have no words and no hits.  An item without words has
    no window; items with equal windows are all counted; null item ids are not
    counted.  Rows that repeat a doc_id are judged by their own text.  Other
    columns are not read.  Without items nothing is contaminated; without
    documents there are no rows.
    """
    windows, owners = item_windows(items, window)
    hits = durable(occurrences(docs, windows, window, shingle))
    doc = ["doc_id", "th"]
    before = Window.partitionBy(*doc).orderBy("start", F.desc("wlen")).rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("start") + F.col("wlen")
    covered = F.coalesce(F.max(end).over(before), F.lit(0))
    hit_words = (hits.select(*doc, F.greatest(end - F.greatest(F.col("start"), covered), F.lit(0)).alias("new"))
                 .groupBy(*doc).agg(F.sum("new").alias("n_hit")))
    by_item = (hits.select(*doc, "wid").distinct().join(small(owners, F.lit(64)), "wid")
               .select(*doc, F.col("item_id").cast("string").alias("item")).distinct()
               .groupBy(*doc).agg(F.count("item").alias("n_items"),
                                  F.array_join(F.array_sort(F.collect_list("item")), ",").alias("items")))
    found = hit_words.withColumnRenamed("doc_id", "hid").withColumnRenamed("th", "hth").alias("h").join(
        by_item.withColumnRenamed("doc_id", "iid").withColumnRenamed("th", "ith"),
        F.col("hid").eqNullSafe(F.col("iid")) & (F.col("hth") == F.col("ith")), "left")
    base = docs.select("doc_id", text_key().alias("th"),
                       F.size(F.array_remove(F.split(whole_text(), RAW_BREAK), "")).cast("long").alias("n_words"))
    out = base.join(found, F.col("doc_id").eqNullSafe(F.col("hid")) & (F.col("th") == F.col("hth")), "left")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return out.select("doc_id", "n_words", n_hit.alias("n_hit"),
                      F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
                      F.sha2(F.coalesce("items", F.lit("")), 256).alias("items_sha256"),
                      (n_hit > 0).alias("contaminated"))


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """The documents without any window of an item, with all their columns."""
    windows, _ = item_windows(items, window)
    bad = occurrences(docs, windows, window, shingle).select(
        F.col("doc_id").alias("__id"), F.col("th").alias("__th")).distinct()
    on = docs["doc_id"].eqNullSafe(bad["__id"]) & (text_key() == bad["__th"])
    return docs.join(bad, on, "left_anti")
