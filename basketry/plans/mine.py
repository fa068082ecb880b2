"""End-to-end plans: ``mine`` (pairs/rows -> frequent itemsets) and the two
jobs of the reference (pair file by case; wide retail file with a basket
size filter), each returning DataFrames and optionally writing the report."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.functions.columns import n_chunks as chunk_rule_count
from basketry.operators.baskets import make_pairs, prepared_pairs
from basketry.operators.fpgrowth import mine_fpgrowth
from basketry.operators.levels import mine_levels
from basketry.operators.report import report_lines, write_report
from basketry.operators.son import mine_son
from basketry.plans.physical import DEFAULT_TUNING, Tuning, release
from basketry.sources.text import read_pairs, read_retail

STRATEGIES = ("levels", "son", "fpgrowth")


def frequent_itemsets(pairs: DataFrame, support: int, *, strategy: str = "levels", min_rows: int | None = None,
                      n_chunks: int | None = None, chunk_rule: str = "half", chunk_method: str = "auto",
                      tuning: Tuning = DEFAULT_TUNING, resume: str | None = None) -> DataFrame:
    """Frequent itemsets ``(k, itemset, support)`` of raw ``(basket, item)`` rows.

    Every strategy gives the same rows; ``n_chunks``, ``chunk_rule`` and
    ``chunk_method`` only divide the work of ``son``.  ``resume`` is the folder in
    which ``levels`` keeps its finished levels (see ``mine_levels``)."""
    if support < 1:
        raise ValueError("support must be at least 1")
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy must be one of {STRATEGIES}, got {strategy!r}")
    if resume is not None and (strategy != "levels" or min_rows is not None):
        raise ValueError("resume needs strategy 'levels' and pairs that are filtered already")
    prepared = None
    if min_rows is not None:
        pairs = prepared = prepared_pairs(pairs, min_rows)
    try:
        if strategy == "levels":
            return mine_levels(pairs, support, tuning=tuning, resume=resume).itemsets()
        if strategy == "fpgrowth":
            return mine_fpgrowth(pairs, support, tuning=tuning)
        p = n_chunks or chunk_rule_count(support, chunk_rule)
        cands, out = mine_son(pairs, support, p, method=chunk_method, tuning=tuning)
        release(cands)
        return out
    finally:
        release(prepared)


def mine(df: DataFrame, basket_cols: str | Sequence[str], item_col: str, support: int, **kwargs) -> DataFrame:
    """Project ``df`` to baskets and mine it (see ``frequent_itemsets``)."""
    return frequent_itemsets(make_pairs(df, basket_cols, item_col), support, **kwargs)


@dataclass
class JobResult:
    candidates: DataFrame
    frequent: DataFrame
    lines: DataFrame


def run_two_pass(pairs: DataFrame, support: int, *, min_rows: int | None = None, n_chunks: int | None = None,
                 chunk_rule: str = "half", chunk_method: str = "auto", count_repeats: bool = False,
                 out: str | None = None, tuning: Tuning = DEFAULT_TUNING) -> JobResult:
    """The reference's job skeleton: basket filter, two passes, report."""
    if support < 1:
        raise ValueError("support must be at least 1")
    prepared = None
    if min_rows is not None:
        pairs = prepared = prepared_pairs(pairs, min_rows)
    p = n_chunks or chunk_rule_count(support, chunk_rule)
    try:
        cands, freq = mine_son(pairs, support, p, method=chunk_method, count_repeats=count_repeats, tuning=tuning)
    finally:
        release(prepared)
    lines = report_lines(cands, freq)
    if out:
        write_report(cands, freq, out)
    return JobResult(cands, freq, lines)


def pair_job(spark: SparkSession, path: str, case: str | int, support: int, out: str | None = None,
             **kwargs) -> JobResult:
    """Job 1: two-column file, basket per user (case 1) or per business (case 2)."""
    return run_two_pass(read_pairs(spark, path, case), support, out=out, **kwargs)


def retail_job(spark: SparkSession, path: str, min_rows: int, support: int, out: str | None = None,
               **kwargs) -> JobResult:
    """Job 2: wide quoted retail file, basket per date-customer, baskets with
    more than ``min_rows`` rows."""
    return run_two_pass(read_retail(spark, path), support, min_rows=min_rows, out=out, **kwargs)


def sizes_by_k(itemsets: DataFrame) -> DataFrame:
    """Per size: number of itemsets and the support range."""
    return itemsets.groupBy("k").agg(
        F.count(F.lit(1)).alias("n_itemsets"),
        F.min("support").alias("min_support"),
        F.max("support").alias("max_support"),
    )
