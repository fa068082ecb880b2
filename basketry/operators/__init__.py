"""Operators: baskets, level-wise mining, the two-pass strategy, FP-growth, report."""
