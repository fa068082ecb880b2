"""basketry: exact frequent-itemset mining on Spark DataFrames.

Transaction rows become ``(basket, item)`` pairs; itemsets whose absolute
support (number of baskets holding all their items) reaches a threshold are
returned with exact counts as a DataFrame ``(k, itemset, support)``.
"""

from basketry.operators.baskets import (
    assign_chunk,
    basket_segments,
    basket_sizes,
    basket_table,
    chunk_item_counts,
    chunk_sizes,
    distinct_pairs,
    make_pairs,
    normalised_pairs,
    prepared_pairs,
)
from basketry.operators.fpgrowth import mine_fpgrowth
from basketry.operators.levels import Levels, frequent_items, frequent_pairs, generate_candidates, mine_levels
from basketry.operators.report import report_lines, report_rows, write_report
from basketry.operators.son import count_candidates, mine_son, son_candidates, son_levels
from basketry.plans.mine import frequent_itemsets, mine, pair_job, retail_job, run_two_pass, sizes_by_k
from basketry.plans.physical import Tuning

__all__ = [
    "Levels",
    "Tuning",
    "assign_chunk",
    "basket_segments",
    "basket_sizes",
    "basket_table",
    "chunk_item_counts",
    "chunk_sizes",
    "count_candidates",
    "distinct_pairs",
    "frequent_items",
    "frequent_itemsets",
    "frequent_pairs",
    "generate_candidates",
    "make_pairs",
    "mine",
    "mine_fpgrowth",
    "mine_levels",
    "mine_son",
    "normalised_pairs",
    "pair_job",
    "prepared_pairs",
    "report_lines",
    "report_rows",
    "retail_job",
    "run_two_pass",
    "sizes_by_k",
    "son_candidates",
    "son_levels",
    "write_report",
]
