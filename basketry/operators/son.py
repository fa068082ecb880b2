"""Two-pass (SON) strategy: local candidates per chunk, then an exact count.

Pass 1 runs the level loop with ``group=["chunk"]`` and the scaled threshold
``n * p >= s``: an itemset is a candidate when it reaches ``s / p`` in at least
one chunk.  Every frequent itemset is one, whatever the chunking, so pass 2,
an exact count of the candidates over all baskets, gives the frequent
itemsets.  The chunk is a column computed from the basket key, never the
physical partition, and both passes read one encoded pair table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from basketry.operators.baskets import assign_chunk, normalised_pairs
from basketry.operators.levels import Encoded, Levels, count_listed, encode, grow
from basketry.plans.physical import DEFAULT_TUNING, Tuning, stable


def _local(pairs: DataFrame, support: int, p: int, method: str, count_repeats: bool, tuning: Tuning) -> Encoded:
    if support < 1:
        raise ValueError("support must be at least 1")
    chunked = assign_chunk(normalised_pairs(pairs), p, method)
    return encode(chunked, support, ["chunk"], p, count_repeats, tuning)


def son_levels(pairs: DataFrame, support: int, p: int, *, method: str = "auto", count_repeats: bool = False,
               tuning: Tuning = DEFAULT_TUNING) -> Levels:
    """Pass 1: local levels per chunk (``chunk, k, itemset, support``)."""
    enc = _local(pairs, support, p, method, count_repeats, tuning)
    try:
        return grow(enc, support, p, tuning)
    finally:
        enc.release()


def son_candidates(pairs: DataFrame, support: int, p: int, **kwargs) -> DataFrame:
    """The candidate list ``(k, itemset)``: distinct over chunks."""
    return son_levels(pairs, support, p, **kwargs).candidates()


def count_candidates(pairs: DataFrame, candidates: DataFrame, support: int = 1,
                     tuning: Tuning = DEFAULT_TUNING) -> DataFrame:
    """Exact support of the itemsets of ``candidates`` over all baskets.

    The list (column ``itemset``) need not be closed, sorted or distinct; each
    different set is counted once and returned when ``support`` baskets hold
    it (1: every set found in some basket)."""
    enc = encode(normalised_pairs(pairs), 1, tuning=tuning)
    try:
        return count_listed(enc, candidates, support, tuning)
    finally:
        enc.release()


def mine_son(pairs: DataFrame, support: int, p: int, *, method: str = "auto", count_repeats: bool = False,
             tuning: Tuning = DEFAULT_TUNING) -> tuple[DataFrame, DataFrame]:
    """Both passes: returns ``(candidates, frequent)``, frequent = ``support >= s``."""
    enc = _local(pairs, support, p, method, count_repeats, tuning)
    try:
        local = grow(enc, support, p, tuning)
        cands = stable(local.candidates())
        local.release()
        return cands, count_listed(enc, cands, support, tuning)
    finally:
        enc.release()
