"""Level-wise (A-Priori) mining expressed as DataFrame joins and aggregates.

Data layout
-----------
* Items get a ``long`` id, rare items first, and every itemset of a level gets
  one too.  The rows that scale with the data are fixed width: pairs
  ``(basket, item, sid)`` and occurrences ``(basket, set, last)``.  Text appears
  in the item table and the result only.
* Pairs of ordinary baskets are written once as a table bucketed on the basket;
  so are the occurrences, which lie in the same partitions already, and the
  level join never shuffles.
* Where few items make many equal baskets, one basket stands for its equals: the
  rows carry their number ``n``, and supports are sums of it.  The work of the levels
  then grows with the different baskets.  With up to ``MARK_ITEMS`` items a basket is
  a few words of bits, and only the different ones are ever written as pairs.
* A basket with more than ``hot_basket_items`` frequent items is joined apart,
  in blocks: its items and its occurrences are cut into blocks of that size,
  the join key is (basket, block pair), and a row is copied once per block of
  the other side.  No join key holds more than one pair of blocks.

Level step k
------------
``ext = occ ⋈ pairs on basket where item > last`` is restricted, evaluated once
and persisted.  ``count`` by itemset and the support filter give the level, which is
checkpointed; the occurrences of the level are the persisted rows whose
itemset it keeps, and are written only once the next level has candidates.  An
empty candidate list or level ends the loop.

* Level 2 has every pair of frequent items as a candidate.  Where these could be
  more than a bucket array, one pass counts the pairs of all baskets by hash (PCY),
  and only pairs in buckets that reach the threshold are materialised.  Where the
  buckets would be too full to tell pairs apart, a basket sends each of its sets once,
  with the later items, to where the set is counted, and only frequent pairs are materialised.
* From level 3 on ``ext`` meets the A-Priori candidates (prefix self-join, subset
  prune): broadcast where they fit; else they are shuffled, after a Bloom filter of
  the candidates has met the rows where these lie.

``group=["chunk"]`` and ``scale=p`` give the local levels of the two-pass
strategy (``n * p >= s`` per chunk); ``count_listed`` runs the same loop over
the prefix tree of a given list of itemsets.  With a ``Journal`` the finished
levels stay in a folder, and a run that failed goes on after the last one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.operators.baskets import distinct_pairs, normalised_pairs, row_weight
from basketry.operators.bitfilter import SEGMENT_WORDS, KeySet, PairCounts, words_for
from basketry.plans.journal import Journal
from basketry.plans.physical import (
    DEFAULT_TUNING,
    ROW_OVERHEAD,
    Tuning,
    bucketed,
    maybe_broadcast,
    measured,
    observed,
    partition_count,
    release,
    stable,
    text_bytes,
)

ITEMSET_SCHEMA = "k int, itemset array<string>, support bigint"
# Bytes of a lookup row of three longs in a hash relation.
KEY_BYTES = ROW_OVERHEAD + 24
# Most frequent items for which a basket is merged as words of 64 bits.
MARK_ITEMS = 256


@dataclass
class Levels:
    """Result of a level-wise run (global or per chunk)."""

    spark: SparkSession
    group: list[str]
    table: DataFrame | None = None                  # all levels, checkpointed
    sizes: list[int] = field(default_factory=list)  # rows of each level

    def itemsets(self) -> DataFrame:
        """``(group.., k, itemset, support)``: every itemset kept by the run."""
        lead = "".join(f"{g} int, " for g in self.group)
        empty = self.spark.createDataFrame([], lead + ITEMSET_SCHEMA)
        return empty if self.table is None else empty.union(self.table.select(*empty.columns))

    def candidates(self) -> DataFrame:
        """``(k, itemset)``: distinct itemsets over all groups (the candidate list)."""
        return self.itemsets().select("k", "itemset").distinct()

    def release(self) -> None:
        """Delete the result's files, once nothing reads it any more."""
        release(self.table)


@dataclass
class Encoded:
    """The pair table of one run; several loops may read it."""

    group: list[str]
    items: DataFrame                # item (text), id
    item_bytes: int
    first: DataFrame                # level 1: group.., text, id (of the set), item (its id), prefix, ids, support
    n_first: int
    pairs: DataFrame | None = None  # ordinary baskets: basket, item, sid[, n]; partitioned on the basket
    hot: DataFrame | None = None    # baskets joined in blocks
    hot_width: DataFrame | None = None
    parts: int = 1
    n_items: int = 0
    n_ext: int = 0                  # pairs of frequent items over all baskets: the rows of level 2's extension, unmerged

    @property
    def weight(self) -> list[str]:
        """The column of the ordinary rows that says how many equal baskets they stand for, if there is one."""
        return ["n"] if self.pairs is not None and "n" in self.pairs.columns else []

    def release(self) -> None:
        release(self.items, self.first, self.pairs, self.hot, self.hot_width)


def frequent_items(pairs: DataFrame, support: int) -> DataFrame:
    """``(k, itemset, support)`` of the frequent single items: a plain count."""
    counts = distinct_pairs(normalised_pairs(pairs)).groupBy("item").agg(F.count(F.lit(1)).alias("support"))
    return counts.where(F.col("support") >= support).select(
        F.lit(1).alias("k"), F.array("item").alias("itemset"), "support")


def frequent_pairs(pairs: DataFrame, support: int) -> DataFrame:
    """Frequent 2-sets as a level table ``(prefix, item, ids, support)``: a plain self-join and count."""
    d = distinct_pairs(normalised_pairs(pairs)).select("basket", "item")
    d = stable(d.join(frequent_items(pairs, support).select(F.col("itemset")[0].alias("item")), "item", "left_semi"))
    other = d.select("basket", F.col("item").alias("second"))
    return (d.join(other, "basket").where(F.col("second") > F.col("item")).groupBy("item", "second")
            .agg(F.count(F.lit(1)).alias("support")).where(F.col("support") >= support)
            .select(F.array("item").alias("prefix"), F.col("second").alias("item"),
                    F.array("item", "second").alias("ids"), "support"))


def generate_candidates(level: DataFrame, k: int, group: Sequence[str] = (), prune: bool = True) -> DataFrame:
    """A-Priori candidates of size ``k`` from the frequent (k-1)-sets ``level``.

    Two sets with the same (k-2)-prefix and last items ``a < b`` give the
    candidate ``prefix + a + b``; with ``prune`` every other (k-1)-subset must
    be in ``level`` too (semi-join plus a count).  Output:
    ``(group.., prefix, item, ids)`` with ``prefix = prefix + a`` and ``item = b``,
    and ``set``, the id of ``prefix``, where ``level`` has ids.
    """
    group = list(group)
    ident = ["set"] if "id" in level.columns else []
    a = level.select(*group, "prefix", F.col("item").alias("a_item"), F.col("ids").alias("a_ids"),
                     *[F.col("id").alias(c) for c in ident])
    b = level.select(*group, "prefix", F.col("item").alias("b_item"))
    cand = (a.join(b, [*group, "prefix"]).where(F.col("b_item") > F.col("a_item"))
            .select(*group, F.col("a_ids").alias("prefix"), F.col("b_item").alias("item"),
                    F.concat("a_ids", F.array("b_item")).alias("ids"), *ident))
    if not prune or k < 3:
        return cand
    # (k-1)-subsets that drop one prefix element (dropping a or b gives the two parents).
    subs = cand.select(*group, "prefix", "item", "ids",
                       F.posexplode(F.slice("ids", 1, k - 2)).alias("pos", "dropped"))
    subs = subs.select(*group, "prefix", "item",
                       F.concat(F.slice("ids", F.lit(1), F.col("pos")),
                                F.slice("ids", F.col("pos") + 2, F.lit(k))).alias("sub"))
    have = level.select(*group, F.col("ids").alias("sub"))
    ok = (subs.join(have, [*group, "sub"], "left_semi")
          .groupBy(*group, "prefix", "item").agg(F.count(F.lit(1)).alias("n"))
          .where(F.col("n") == k - 2).select(*group, "prefix", "item"))
    return cand.join(ok, [*group, "prefix", "item"], "left_semi")


# ---------------------------------------------------------------- pair table
def _rows_and_bytes(df: DataFrame, text: str) -> tuple[DataFrame, int, int]:
    """``df`` checkpointed, its rows, and its bytes in a hash relation."""
    kept, seen = observed(df, n=F.count(F.lit(1)), b=F.coalesce(F.sum(text_bytes(text).cast("long")), F.lit(0)))
    return kept, seen["n"], seen["b"]


def encode(pairs: DataFrame, support: int, group: Sequence[str] = (), scale: int = 1, count_repeats: bool = False,
           tuning: Tuning = DEFAULT_TUNING) -> Encoded:
    """Level 1 and the encoded pairs of the items that are frequent in some group.

    ``pairs`` carrying ``n_rows`` are distinct already (``prepared_pairs``);
    others are made distinct first.  ``sid`` is the pair's level-1 set, null
    where the item is frequent in other groups only."""
    group = list(group)
    dist = pairs if "n_rows" in pairs.columns else distinct_pairs(pairs, *group).persist()
    one = row_weight(dist) if count_repeats else F.count(F.lit(1))
    counts = (dist.groupBy(*group, "item").agg(one.cast("long").alias("support"), F.count(F.lit(1)).alias("n"))
              .where(F.col("support") * scale >= support))
    none = F.array().cast("array<bigint>")
    ident = F.monotonically_increasing_id()
    if group:
        first, n_first, level_bytes = _rows_and_bytes(counts, "item")
        # Ids grow along the global sort, rare items first.
        items, n_items, item_bytes = _rows_and_bytes(
            first.groupBy("item").agg(F.max("support").alias("s")).orderBy("s", "item").select("item", ident.alias("id")), "item")
        level = stable(first.join(maybe_broadcast(items.toDF("item", "last"), item_bytes, tuning), "item").select(
            *group, F.col("item").alias("text"), F.col("last").alias("item"), none.alias("prefix"),
            F.array("last").alias("ids"), "support", "n").withColumn("id", ident))
        release(first)
    else:  # a set is an item: one sort gives both their ids
        level, n_first, item_bytes = _rows_and_bytes(
            counts.orderBy("support", "item").select(F.col("item").alias("text"), "support", "n", ident.alias("item")).select(
                "text", "item", none.alias("prefix"), F.array("item").alias("ids"), "support", "n",
                F.col("item").alias("id")), "text")
        items, n_items, level_bytes = level.select(F.col("text").alias("item"), F.col("item").alias("id")), n_first, item_bytes
    enc = Encoded(group, items, item_bytes, level, n_first, n_items=n_items)
    if n_first == 0:
        return enc
    n_rows = level.agg(F.sum("n")).first()[0]
    most = n_rows * (n_items - 1) // 2  # pairs of items in baskets, at most
    if tuning.merge_from and most >= tuning.merge_from and n_items <= min(MARK_ITEMS, tuning.hot_basket_items):
        _merge_marked(enc, dist, level_bytes, tuning)
        if dist is not pairs:
            dist.unpersist()
        return enc
    look = level.select(*group, F.col("text").alias("item"), F.col("item").alias("iid"), F.col("id").alias("sid"))
    if group:
        rows = (dist.join(maybe_broadcast(items, item_bytes, tuning), "item")
                .join(maybe_broadcast(look.drop("iid"), level_bytes, tuning), [*group, "item"], "left")
                .select("basket", F.col("id").alias("item"), "sid"))
    else:
        rows = dist.join(maybe_broadcast(look, item_bytes, tuning), "item").select(
            "basket", F.col("iid").alias("item"), "sid")
    enc.parts = partition_count(pairs.sparkSession, n_rows, tuning)
    enc.pairs = bucketed(rows.repartition(enc.parts, "basket"), enc.parts, "basket", tuning)
    if dist is not pairs:
        dist.unpersist()
    # The widths are counted where the buckets lie, without an exchange.
    block = tuning.hot_basket_items
    width = enc.pairs.groupBy("basket").agg(F.count(F.lit(1)).alias("w"), F.bit_xor(F.xxhash64("item", "sid")).alias("mark"))
    hot = F.col("w") > block
    squared = F.col("w") * (F.col("w") - 1) / 2
    st = width.agg(F.sum("w").alias("n"), F.sum(F.when(hot, 1).otherwise(0)).alias("hot"), F.sum(squared).alias("all"),
                   F.sum(F.when(~hot, squared)).alias("ext"), F.sum(F.when(hot, 0).otherwise(1)).alias("usual"),
                   F.approx_count_distinct(F.when(~hot, F.struct("w", "mark"))).alias("kinds")).first()
    enc.n_ext = int(st["all"] or 0)
    # Sized for the larger of the pairs and the level-2 extensions (exact).
    size = int(max(st["n"] or 0, st["ext"] or 0))
    merge = tuning.merge_from and (st["ext"] or 0) >= tuning.merge_from and 2 * st["kinds"] <= st["usual"]
    if merge:  # about
        size = size * st["kinds"] // st["usual"]
    parts = partition_count(pairs.sparkSession, size, tuning)
    if st["hot"] or merge or parts > 2 * enc.parts:
        every, usual = enc.pairs, enc.pairs
        if st["hot"]:
            enc.hot_width = stable(width.where(hot))
            wide = maybe_broadcast(enc.hot_width.select("basket"), st["hot"] * KEY_BYTES, tuning)
            enc.hot = stable(every.join(wide, "basket", "left_semi"))
            usual = every.join(wide, "basket", "left_anti")
        if merge:
            usual = _merged(usual)
        enc.parts = parts
        enc.pairs = bucketed(usual.repartition(parts, "basket"), parts, "basket", tuning)
        release(every)
    return enc


def _merge_marked(enc: Encoded, dist: DataFrame, level_bytes: int, tuning: Tuning) -> None:
    """Gives ``enc`` its pairs ``basket, item, sid, n``, merged before any is written: a basket is its items' bits.

    Baskets of a group with the same words are one, under a new key.  Words have a fixed width and are
    combined in each task first, so a basket with very many rows is no array and no task of its own."""
    words = [f"w{i}" for i in range(-(-enc.n_items // 64))]
    # At most MARK_ITEMS rows.
    places = enc.items.agg(F.sort_array(F.collect_list(F.struct("id", "item"))).alias("x")).select(F.posexplode("x").alias("at", "x"))
    bits = stable(places.select("x.id", "x.item", *[
        F.expr(f"if(at div 64 = {i}, shiftleft(1L, cast(at % 64 as int)), 0L)").alias(w) for i, w in enumerate(words)]))
    look = maybe_broadcast(bits.drop("id"), enc.item_bytes + 8 * len(words) * enc.n_items, tuning)
    marks = dist.join(look, "item").groupBy("basket", *enc.group).agg(*[F.bit_or(w).alias(w) for w in words])
    kinds = marks.groupBy(*enc.group, *words).agg(F.count(F.lit(1)).alias("n")).withColumn(
        "w", sum((F.bit_count(w) for w in words), F.lit(0)).cast("long"))
    squared = F.expr("w * (w - 1) div 2")
    kinds, seen = observed(kinds, rows=F.sum("w"), ext=F.sum(squared), all=F.sum(F.col("n") * squared))
    enc.n_ext = int(seen["all"])
    enc.parts = partition_count(dist.sparkSession, int(max(seen["rows"], seen["ext"])), tuning)
    keyed = kinds.withColumn("basket", F.monotonically_increasing_id().cast(dist.schema["basket"].dataType))
    has = F.expr(" or ".join(f"(k.{w} & b.{w}) != 0" for w in words))
    rows = keyed.alias("k").join(F.broadcast(bits.alias("b")), has).select("basket", *enc.group, F.col("id").alias("item"), "n")
    if enc.group:
        sids = enc.first.select(*enc.group, "item", F.col("id").alias("sid"))
        rows = rows.join(maybe_broadcast(sids, level_bytes, tuning), [*enc.group, "item"], "left")
    else:
        rows = rows.withColumn("sid", F.col("item"))
    rows = rows.select("basket", "item", "sid", "n")
    enc.pairs = bucketed(rows.repartition(enc.parts, "basket"), enc.parts, "basket", tuning)
    release(kinds, bits)


def _merged(pairs: DataFrame) -> DataFrame:
    """``basket, item, sid, n``: of ``n`` baskets with the same pairs the one with the smallest key.

    An array holds the items of one ordinary basket; baskets of different groups differ in a ``sid``
    or have no set at all."""
    content = pairs.groupBy("basket").agg(F.sort_array(F.collect_list(F.struct("item", "sid"))).alias("content"))
    kinds = content.groupBy("content").agg(F.min("basket").alias("basket"), F.count(F.lit(1)).alias("n"))
    return kinds.select("basket", F.explode("content").alias("x"), "n").select("basket", "x.item", "x.sid", "n")


def _blocked(occ: DataFrame, items: DataFrame, width: DataFrame, tuning: Tuning) -> DataFrame:
    """``occ ⋈ items`` of hot baskets on (basket, block pair)."""
    block = tuning.hot_basket_items
    sizes = width.join(occ.groupBy("basket").agg(F.count(F.lit(1)).alias("o")), "basket").select(
        "basket", F.ceil(F.col("w") / block).cast("int").alias("ni"), F.ceil(F.col("o") / block).cast("int").alias("no"))
    sizes = stable(sizes)
    sized = maybe_broadcast(sizes, sizes.count() * KEY_BYTES, tuning)
    left = occ.join(sized, "basket").select(
        "basket", "set", "last", F.pmod(F.xxhash64("set"), F.col("no")).cast("int").alias("bo"),
        F.explode(F.sequence(F.lit(0), F.col("ni") - 1)).alias("bi"))
    right = items.join(sized, "basket").select(
        "basket", "item", F.pmod(F.xxhash64("item"), F.col("ni")).cast("int").alias("bi"),
        F.explode(F.sequence(F.lit(0), F.col("no") - 1)).alias("bo"))
    return left.join(right, ["basket", "bi", "bo"]).where(F.col("item") > F.col("last"))


# ---------------------------------------------------------------- the loop
class _Loop:
    """Occurrences of the current level over ordinary and hot baskets."""

    def __init__(self, enc: Encoded, occ: DataFrame, hot: DataFrame | None, local: bool, tuning: Tuning,
                 journal: Journal | None = None) -> None:
        self.enc, self.occ, self.hot, self.tuning, self.journal = enc, occ, hot, tuning, journal
        self.pairs, self.parts = enc.pairs, enc.parts
        self.n = enc.weight
        self.local = F.col("sid").isNotNull() if local else F.lit(True)
        self.made: list[DataFrame] = []
        self.ext: list[DataFrame] = []

    def joined(self, sets: DataFrame | None = None, items: DataFrame | None = None) -> list[DataFrame]:
        """``(basket, set, item[, n])``: occurrences (of ``sets``) and the later items (out of ``items``) of their baskets."""
        def only(df: DataFrame, keys: DataFrame | None) -> DataFrame:
            return df if keys is None else df.join(keys, keys.columns, "left_semi")

        parts = [only(self.occ, sets).join(only(self.pairs.where(self.local).select("basket", "item"), items), "basket")
                 .where(F.col("item") > F.col("last"))]
        if self.hot is not None:
            parts.append(_blocked(only(self.hot, sets), only(self.enc.hot.where(self.local), items), self.enc.hot_width,
                                  self.tuning))
        return [_weighed(p, self.n).select("basket", "set", "item", *self.n) for p in parts]

    def tally(self, rows: DataFrame, *keys) -> DataFrame:
        """Per key its ``support`` in baskets, and ``rows``, the rows behind it."""
        if not self.n:
            return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("support")).withColumn("rows", F.col("support"))
        return rows.groupBy(*keys).agg(F.sum("n").alias("support"), F.count(F.lit(1)).alias("rows"))

    def _pair_words(self, support: int, scale: int) -> tuple[int, bool]:
        """Words of the bucket array of level 2's pairs, 0 where they are no more than the buckets; whether it is too full.

        Four buckets for each pair that could be frequent.  With less than half of them,
        as ``pair_buckets`` or the budget has it, too many pairs share a bucket."""
        least = -(-support // scale)  # baskets that a pair needs
        possible = self.enc.n_first * (self.enc.n_items - 1) // 2
        wanted = 4 * self.enc.n_ext // max(1, least)
        n_words = words_for(min(wanted, self.tuning.pair_buckets), self.tuning.broadcast_bytes)
        if not self.tuning.pair_buckets or possible <= 64 * n_words:
            return 0, False
        return n_words, wanted > 128 * n_words

    def crowded(self, support: int, scale: int) -> bool:
        """Whether level 2 has more pairs than a bucket array could tell apart."""
        n_words, full = self._pair_words(support, scale)
        return n_words > 0 and full

    def count_crowded(self) -> DataFrame:
        """``set, item, support, rows`` of all pairs of level 2, without a row for each pair of a basket in a shuffle.

        A basket sends each of its sets once, with the array of its later items; items
        are in the order of their support, so frequent ones have short arrays.  The pairs of sets in
        very many baskets, which would meet in one task, are counted map-side first."""
        first = self.enc.first.where(F.col("support") > self.tuning.rows_per_partition // 16).select(F.col("id").alias("set"))
        heavy = maybe_broadcast(first, first.count() * KEY_BYTES, self.tuning)
        content = self.pairs.where(self.local).groupBy("basket", *self.n).agg(
            F.sort_array(F.collect_list(F.struct("item", "sid"))).alias("x"))  # one ordinary basket
        later = F.slice("items", F.col("at") + 2, F.size("items")).alias("later")
        sent = content.select(F.col("x.item").alias("items"), *self.n, F.posexplode("x.sid").alias("at", "set")).select(
            "set", later, *self.n).where(F.size("later") > 0)
        if self.hot is not None:
            blocks = _blocked(self.hot, self.enc.hot.where(self.local), self.enc.hot_width, self.tuning)
            sent = sent.union(_weighed(blocks.select("set", F.array("item").alias("later")), self.n))
        parts = partition_count(sent.sparkSession, self.enc.n_ext, self.tuning)
        # Rows of a set lie in one partition: no exchange for the count.
        met = sent.join(heavy, "set", "left_anti").repartition(parts, "set").select("set", F.explode("later").alias("item"), *self.n)
        return _union([self.tally(met, "set", "item"), self.tally(_union(self.joined(sets=heavy)), "set", "item")])

    def remake(self, level: DataFrame, n_level: int) -> None:
        """The extension of level 2 after ``count_crowded``, from the sets and items of the kept pairs only."""
        n_bytes = n_level * KEY_BYTES
        self.kept = n_bytes <= self.tuning.broadcast_bytes
        self.ext = self.joined(*[maybe_broadcast(level.select(c).distinct(), n_bytes, self.tuning) for c in ("set", "item")])

    def count_pairs(self, support: int, scale: int) -> PairCounts | None:
        """Hashed counts of level 2's pairs (PCY), where the pairs could be more than the buckets."""
        n_words, full = self._pair_words(support, scale)
        if not n_words or full:
            return None
        return PairCounts.of(_union(self.joined()), ("set", "item"), n_words, F.col("n") * scale >= support, *self.n)

    def extend(self, cand: DataFrame | None, n_cand: int, counted: PairCounts | None = None) -> DataFrame:
        """Evaluate ``ext`` once; rows ``(basket, set, item[, n])``, ``set`` being the candidate's id where there are any."""
        self.kept = cand is None or n_cand * KEY_BYTES <= self.tuning.broadcast_bytes
        keys = None
        if not self.kept and self.tuning.candidate_bits:
            n_words = words_for(n_cand * self.tuning.candidate_bits, self.tuning.broadcast_bytes)
            keys = KeySet.of(cand, ("set", "item"), n_words) if n_words else None
        out = []
        for p in self.joined():
            if counted is not None:
                p = counted.ask(p)
            if keys is not None:  # before the shuffle to the candidates
                p = keys.ask(p)
            if cand is not None:
                look = maybe_broadcast(cand.select("set", "item", "id"), n_cand * KEY_BYTES, self.tuning)
                p = p.join(look, ["set", "item"]).select("basket", F.col("id").alias("set"), "item", *self.n)
            out.append(p.persist())
        self.ext = out
        return _union(out)

    def follow(self, level: DataFrame, n_level: int, n_occ: int, by_pair: bool, name: str | None = None,
               note=lambda: None) -> None:
        """Occurrences of the kept sets: ``level`` has ``id`` and, ``by_pair``, their ``set, item``.

        With a journal they are written under ``name``; ``note`` is called before what they replace goes."""
        on = ["set", "item"] if by_pair else ["set"]
        look = level.select("set", "item", "id") if by_pair else level.select(F.col("id").alias("set"), "id")
        fits = n_level * KEY_BYTES <= self.tuning.broadcast_bytes
        look = maybe_broadcast(look, n_level * KEY_BYTES, self.tuning)
        rows = [p.join(look, on).select("basket", F.col("id").alias("set"), F.col("item").alias("last"), *n)
                for p, n in zip(self.ext, (self.n, []))]
        parts = partition_count(level.sparkSession, n_occ, self.tuning)
        if parts > 2 * self.parts:  # the occurrences have outgrown the pairs' partitions
            pairs = bucketed(self.pairs.repartition(parts, "basket"), parts, "basket", self.tuning)
            self.made.append(pairs)
            self.pairs, self.parts, self.kept = pairs, parts, False
        # Without a shuffle join on the itemset the rows are in the pairs' partitions still.
        usual = rows[0] if fits and self.kept else rows[0].repartition(self.parts, "basket")
        if self.journal is not None:
            occ = self.journal.keep_buckets(f"{name}-occ", usual, self.parts, "basket")
            hot = self.journal.keep(f"{name}-hot", rows[1]) if self.hot is not None else None
        else:
            occ = bucketed(usual, self.parts, "basket", self.tuning)
            hot = stable(rows[1]) if self.hot is not None else None
        note()
        self.drop()
        self.occ, self.hot = occ, hot
        if self.journal is None:
            self.made += [occ] if hot is None else [occ, hot]

    def drop(self) -> None:
        """Let the persisted extension and the superseded occurrences go."""
        for p in self.ext:
            p.unpersist()
        self.ext = []
        keep = [f for f in self.made if f is self.pairs]
        release(*[f for f in self.made if f is not self.pairs])
        self.made = keep

    def close(self) -> None:
        self.drop()
        release(*self.made)


def _weighed(rows: DataFrame, weight: list[str]) -> DataFrame:
    """``rows`` with the columns ``weight``: a basket that stands for no other counts once."""
    return rows.withColumns({c: F.lit(1).cast("long") for c in weight if c not in rows.columns})


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.union(f)
    return out


def _decoded(levels: list[DataFrame], enc: Encoded, tuning: Tuning) -> DataFrame:
    """``(group.., k, itemset, support)`` with sorted text, from ``(group.., id, ids, support)`` per level."""
    table = None
    for k, lv in enumerate(levels, 1):
        lv = lv.select(*enc.group, F.lit(k).alias("k"), "id", "ids", "support")
        table = lv if table is None else table.union(lv)
    text = enc.items.select(F.col("id").alias("iid"), "item")
    key = [*enc.group, "k", "id", "support"]
    return (table.select(*key, F.explode("ids").alias("iid"))
            .join(maybe_broadcast(text, enc.item_bytes, tuning), "iid")
            .groupBy(*key).agg(F.array_sort(F.collect_list("item")).alias("itemset"))  # k items
            .select(*enc.group, "k", "itemset", "support"))


def grow(enc: Encoded, support: int, scale: int = 1, tuning: Tuning = DEFAULT_TUNING,
         journal: Journal | None = None) -> Levels:
    """All levels of ``enc`` whose sets reach the threshold in their group.

    With a ``journal`` of an earlier run the loop goes on after the last level noted in it."""
    out = Levels(enc.items.sparkSession, enc.group)
    if enc.n_first == 0:
        return out
    levels, sizes = [enc.first], [enc.n_first]
    occ = [f.where("sid is not null").select("basket", F.col("sid").alias("set"), F.col("item").alias("last"), *n)
           if f is not None else None for f, n in ((enc.pairs, enc.weight), (enc.hot, []))]
    loop = _Loop(enc, *occ, local=True, tuning=tuning, journal=journal)
    made = []
    try:
        if journal is not None and journal.state["level"] > 1:
            sizes = journal.state["sizes"]
            levels += [journal.read(f"level-{k}") for k in range(2, len(sizes) + 1)]
            loop.parts = journal.state["parts"]
            kind = dict(enc.pairs.dtypes)["basket"]
            more = "".join(f", {c} bigint" for c in enc.weight)
            loop.occ = journal.read_buckets(f"level-{len(sizes)}-occ", f"basket {kind}, `set` bigint, last bigint{more}",
                                            loop.parts, "basket")
            loop.hot = journal.read(f"level-{len(sizes)}-hot") if enc.hot is not None else None
            if loop.parts != enc.parts:
                loop.pairs = bucketed(enc.pairs.repartition(loop.parts, "basket"), loop.parts, "basket", tuning)
                loop.made.append(loop.pairs)
        follow = None  # the occurrences of the level found last, still to be written
        while sizes[-1] >= 2:  # a next level needs two sets
            k = len(sizes) + 1
            cand, n_cand, counted = None, 0, None
            crowded = k == 2 and loop.crowded(support, scale)
            if k > 2:
                cand, seen = observed(generate_candidates(levels[-1], k, enc.group).withColumn(
                    "id", F.monotonically_increasing_id()), n=F.count(F.lit(1)))
                made.append(cand)
                n_cand = seen["n"]
                if n_cand == 0:
                    break
                if follow is not None:
                    follow()
            else:
                counted = loop.count_pairs(support, scale)
                if counted is not None:
                    made.append(counted.words)
                    if counted.frequent == 0:
                        break
            if crowded:
                counts = loop.count_crowded()
            else:
                counts = loop.tally(loop.extend(cand, n_cand, counted), *(["set", "item"] if cand is None else ["set"]))
            counts = counts.where(F.col("support") * scale >= support)
            if cand is None:
                look = enc.first.select(*enc.group, F.col("id").alias("set"), F.col("ids").alias("prefix"))
                level = counts.join(look, "set").select(
                    *enc.group, "set", "item", "prefix", F.concat("prefix", F.array("item")).alias("ids"), "support", "rows")
                level = level.withColumn("id", F.monotonically_increasing_id())
            else:
                level = counts.withColumnRenamed("set", "id").join(cand.drop("set"), "id").select(
                    *enc.group, "id", "item", "prefix", "ids", "support", "rows")
            if journal is None:
                level, seen = observed(level, n=F.count(F.lit(1)), occ=F.coalesce(F.sum("rows"), F.lit(0)))
                made.append(level)
                n, n_occ = seen["n"], seen["occ"]
            else:
                level = journal.keep(f"level-{k}", level)
                n, n_occ = level.agg(F.count(F.lit(1)), F.coalesce(F.sum("rows"), F.lit(0))).first()
            if n == 0:
                break
            levels.append(level)
            sizes.append(n)
            if crowded:
                loop.remake(level, n)

            def follow(level=level, n=n, n_occ=n_occ, k=k, by_pair=cand is None) -> None:
                def note() -> None:
                    if journal is not None:
                        journal.note(k, sizes=list(sizes), parts=loop.parts, **_facts(enc))

                loop.follow(level, n, n_occ, by_pair, f"level-{k}", note)
                if journal is not None and k > 2:
                    journal.drop(f"level-{k - 1}-occ")
                    journal.drop(f"level-{k - 1}-hot")
        out.table = stable(_decoded(levels, enc, tuning))
        out.sizes = sizes
    finally:  # also when a step fails, only the result (or the journal) stays
        loop.close()
        release(*made)
    return out


def _facts(enc: Encoded) -> dict:
    """What a journal's notes say of the encoded pairs."""
    return {"pair_parts": enc.parts, "item_bytes": enc.item_bytes, "n_first": enc.n_first, "n_items": enc.n_items,
            "n_ext": enc.n_ext, "hot": enc.hot is not None, "weight": enc.weight, "basket": dict(enc.pairs.dtypes)["basket"] if enc.pairs else "",
            "group": enc.group}


def _journalled(pairs: DataFrame, make, journal: Journal, tuning: Tuning) -> Encoded:
    """The encoded pairs of a journal, or ``make()`` kept in it."""
    if journal.state is None:
        enc = make()
        if enc.n_first:
            kept = Encoded(enc.group, journal.keep("items", enc.items), enc.item_bytes, journal.keep("level-1", enc.first),
                           enc.n_first, journal.keep_buckets("pairs", enc.pairs, enc.parts, "basket"),
                           parts=enc.parts, n_items=enc.n_items, n_ext=enc.n_ext)
            if enc.hot is not None:
                kept.hot, kept.hot_width = journal.keep("hot", enc.hot), journal.keep("hot-width", enc.hot_width)
            enc.release()
            enc = kept
        journal.note(1, sizes=[enc.n_first], parts=enc.parts, **_facts(enc))
        return enc
    st = journal.state
    if not st["n_first"]:
        return make()
    more = "".join(f", {c} bigint" for c in st.get("weight", []))
    enc = Encoded(st["group"], journal.read("items"), st["item_bytes"], journal.read("level-1"), st["n_first"],
                  journal.read_buckets("pairs", f"basket {st['basket']}, item bigint, sid bigint{more}", st["pair_parts"], "basket"),
                  parts=st["pair_parts"], n_items=st["n_items"], n_ext=st["n_ext"])
    if st["hot"]:
        enc.hot, enc.hot_width = journal.read("hot"), journal.read("hot-width")
    return enc


def count_listed(enc: Encoded, listed: DataFrame, support: int, tuning: Tuning = DEFAULT_TUNING) -> DataFrame:
    """``(k, itemset, support)``: the listed itemsets with at least ``support`` baskets.

    The list may hold anything: itemsets are sorted and made distinct, those
    with an item outside ``enc`` cannot occur, and the prefix tree of the rest
    is walked level by level, so each row is one (basket, tree node it
    contains) and nothing scales with list x baskets."""
    spark = enc.items.sparkSession
    empty = spark.createDataFrame([], ITEMSET_SCHEMA)
    if enc.n_first == 0:
        return empty
    sets = stable(listed.select(F.array_distinct(F.transform("itemset", lambda x: F.coalesce(x, F.lit("")))).alias("s"))
                  .where(F.size("s") > 0).select(F.array_sort("s").alias("s")).distinct()
                  .withColumn("c", F.monotonically_increasing_id()))
    named = (sets.select("c", F.size("s").alias("n"), F.explode("s").alias("item"))
             .join(maybe_broadcast(enc.items, enc.item_bytes, tuning), "item")
             .groupBy("c", "n").agg(F.array_sort(F.collect_list("id")).alias("ids")).where(F.size("ids") == F.col("n")))
    tree = named.select("ids", F.explode(F.sequence(F.lit(1), F.size("ids"))).alias("k")).select(
        "k", F.slice("ids", F.lit(1), F.col("k")).alias("node"), (F.col("k") == F.size("ids")).alias("mine"))
    tree = stable(tree.groupBy("k", F.col("node").alias("ids")).agg(F.max("mine").alias("mine"))
                  .withColumn("id", F.monotonically_increasing_id()))
    above = tree.select((F.col("k") + 1).alias("k"), F.col("ids").alias("up"), F.col("id").alias("set"))
    nodes = stable(tree.withColumn("up", F.slice("ids", F.lit(1), F.col("k") - 1)).join(above, ["k", "up"], "left")
                   .select("k", "id", "set", F.element_at("ids", -1).alias("item"), "ids", "mine"))
    per_k = {r["k"]: r["n"] for r in nodes.groupBy("k").agg(F.count(F.lit(1)).alias("n")).collect()}
    found, made = [], [sets, tree, nodes]
    loop = None
    try:
        for k in range(1, max(per_k, default=0) + 1):
            here = nodes.where(F.col("k") == k)
            if k == 1:
                look = maybe_broadcast(here.select("item", "id"), per_k[k] * KEY_BYTES, tuning)
                occ = [f.join(look, "item").select("basket", F.col("id").alias("set"), F.col("item").alias("last"), *n)
                       if f is not None else None for f, n in ((enc.pairs, enc.weight), (enc.hot, []))]
                occ = [bucketed(occ[0], enc.parts, "basket", tuning), None if occ[1] is None else stable(occ[1])]
                loop = _Loop(enc, *occ, local=False, tuning=tuning)
                loop.made += [f for f in occ if f is not None]
                rows = loop.occ if loop.hot is None else loop.occ.union(_weighed(loop.hot, loop.n))
            else:
                rows = loop.extend(here, per_k[k])
            counts = loop.tally(rows, F.col("set").alias("id"))
            level, seen = observed(counts.where(F.col("support") >= support).join(here.select("id", "ids", "mine"), "id"),
                                   n=F.count(F.lit(1)), occ=F.coalesce(F.sum("rows"), F.lit(0)))
            made.append(level)
            n, n_occ = seen["n"], seen["occ"]
            found.append(level)
            if n == 0:
                break
            if k > 1 and k < max(per_k):
                loop.follow(level, n, n_occ, by_pair=False)
        if not found:
            return empty
        plain = Encoded([], enc.items, enc.item_bytes, enc.first, enc.n_first)
        return empty.union(stable(_decoded([lv.where("mine") for lv in found], plain, tuning)))
    finally:
        if loop is not None:
            loop.close()
        release(*made)


def mine_levels(pairs: DataFrame, support: int, *, group: Sequence[str] = (), scale: int = 1,
                count_repeats: bool = False, tuning: Tuning = DEFAULT_TUNING, resume: str | None = None) -> Levels:
    """Frequent itemsets of ``pairs`` (``basket, item`` [+ group columns]).

    Support counts baskets (each basket once).  An itemset is kept in a group
    when ``support * scale >= support_threshold``.  ``group`` columns must be
    functions of the basket (the chunk).  ``count_repeats`` makes level 1
    count raw rows instead of baskets (the reference's first-pass singletons).
    Null items are the empty item; null baskets are one basket.

    ``resume`` names a folder that all executors share.  Each finished level is
    kept there until the run ends; a run that failed, in this or another session,
    goes on from the last one when it is called again with the same folder,
    parameters and input.  Other parameters or input files are an error.
    """
    if support < 1:
        raise ValueError("support must be at least 1")

    def make() -> Encoded:
        return encode(normalised_pairs(pairs), support, group, scale, count_repeats, tuning)

    if resume is None:
        enc = make()
        try:
            return grow(enc, support, scale, tuning)
        finally:
            enc.release()
    journal = Journal(pairs.sparkSession, resume, {
        "support": support, "group": list(group), "scale": scale, "count_repeats": count_repeats,
        "columns": pairs.dtypes, "files": hashlib.sha256("\n".join(sorted(pairs.inputFiles())).encode()).hexdigest()}, tuning)
    try:
        out = grow(_journalled(pairs, make, journal, tuning), support, scale, tuning, journal)
        journal.finish()
        return out
    finally:
        journal.let_go()
