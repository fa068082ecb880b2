"""Bit filters over hashed keys, as frames: built by aggregates, asked by a broadcast join.

A filter is ``n_words`` words of 64 bits, ``SEGMENT_WORDS`` a row, so a broadcast
of it takes about an eighth of a byte a bit whatever the keys are.  ``PairCounts``
is the bucket array of a hashed pair count (a bit per bucket that reached a
threshold); ``KeySet`` a blocked Bloom filter (each key sets ``KEY_BITS`` bits of one
word).  Neither ever loses a key; what a filter lets through by chance is left to
the exact join or count that follows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.plans.physical import observed, release

SEGMENT_WORDS = 64
KEY_BITS = 3


def _segments(words: DataFrame, n_words: int) -> DataFrame:
    """``seg, bits`` from ``word, mask`` rows; words without a row are zero."""
    zero = words.sparkSession.range(n_words).select(F.col("id").alias("word"), F.lit(0).cast("long").alias("mask"))
    one = words.union(zero).groupBy("word").agg(F.bit_or("mask").alias("m"))
    seg = F.expr(f"cast(word div {SEGMENT_WORDS} as int)").alias("seg")
    return one.select(seg, F.struct("word", "m").alias("x")).groupBy("seg").agg(
        F.transform(F.array_sort(F.collect_list("x")), lambda x: x["m"]).alias("bits"))  # SEGMENT_WORDS entries


def _ask(df: DataFrame, segments: DataFrame, word: Column, mask: Column) -> DataFrame:
    """Rows of ``df`` whose ``mask`` is set in their ``word``."""
    columns = df.columns
    df = df.withColumns({"__word": word, "__mask": mask})
    at = F.expr(f"cast(__word div {SEGMENT_WORDS} as int)")
    hit = F.get("bits", F.expr(f"cast(__word % {SEGMENT_WORDS} as int)")).bitwiseAND(F.col("__mask")) == F.col("__mask")
    return (df.withColumn("seg", at).join(F.broadcast(segments), "seg").where(hit)).select(*columns)


def words_for(bits: int, budget_bytes: int) -> int:
    """Words for about ``bits`` bits, a power of two, within a broadcast budget; 0 where not one segment fits."""
    most = budget_bytes // 8 // SEGMENT_WORDS
    if most < 1:
        return 0
    wanted = max(1, -(-bits // 64 // SEGMENT_WORDS))
    return SEGMENT_WORDS * min(1 << (wanted - 1).bit_length(), 1 << (most.bit_length() - 1))


def _bit(at: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), at.cast("int"))


@dataclass
class PairCounts:
    """Which buckets of hashed ``keys`` reach a count."""

    segments: DataFrame
    n_words: int
    keys: tuple[str, ...]
    frequent: int  # buckets that reached it
    words: DataFrame  # checkpointed, behind the segments

    @staticmethod
    def _bucket(keys, n_words: int) -> Column:
        return F.pmod(F.xxhash64(*keys), F.lit(64 * n_words).cast("long"))

    @classmethod
    def of(cls, rows: DataFrame, keys: tuple[str, ...], n_words: int, reached, weight: str | None = None) -> PairCounts:
        """Count ``rows`` by bucket, map-side first; ``reached`` is the condition on the count column ``n``.

        With a column ``weight`` a row counts that often."""
        one = F.lit(1) if weight is None else F.col(weight)
        counts = rows.select(cls._bucket(keys, n_words).alias("b"), one.alias("one")).groupBy("b").agg(
            F.count(F.lit(1)).alias("n") if weight is None else F.sum("one").alias("n"))
        words = counts.where(reached).select(F.shiftright("b", 6).alias("word"),
                                             _bit(F.col("b").bitwiseAND(F.lit(63))).alias("mask"))
        kept, seen = observed(words, n=F.count(F.lit(1)))
        return cls(_segments(kept, n_words), n_words, tuple(keys), seen["n"], kept)

    def release(self) -> None:
        release(self.words)

    def ask(self, df: DataFrame) -> DataFrame:
        bucket = self._bucket(self.keys, self.n_words)
        return _ask(df, self.segments, F.shiftright(bucket, 6), _bit(bucket.bitwiseAND(F.lit(63))))


@dataclass
class KeySet:
    """A blocked Bloom filter of ``keys``."""

    segments: DataFrame
    n_words: int
    keys: tuple[str, ...]

    @staticmethod
    def _place(keys, n_words: int) -> tuple[Column, Column]:
        h = F.xxhash64(*keys)
        g, mask = F.xxhash64(h), F.lit(0).cast("long")
        for i in range(KEY_BITS):
            mask = mask.bitwiseOR(_bit(F.shiftright(g, 6 * i).bitwiseAND(F.lit(63))))
        return F.pmod(h, F.lit(n_words).cast("long")), mask

    @classmethod
    def of(cls, rows: DataFrame, keys: tuple[str, ...], n_words: int) -> KeySet:
        word, mask = cls._place(keys, n_words)
        return cls(_segments(rows.select(word.alias("word"), mask.alias("mask")), n_words), n_words, tuple(keys))

    def ask(self, df: DataFrame) -> DataFrame:
        return _ask(df, self.segments, *self._place(self.keys, self.n_words))
