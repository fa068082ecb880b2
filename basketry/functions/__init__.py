"""Column expressions used across the library (all JVM-side, no Python UDF)."""

from basketry.functions.columns import (
    chunk_of,
    composite_key,
    contains_all,
    itemset_literal,
    itemset_text,
    java_string_hash,
    n_chunks,
    normalise_item_id,
    strip_quotes,
)

__all__ = [
    "chunk_of",
    "composite_key",
    "contains_all",
    "itemset_literal",
    "itemset_text",
    "java_string_hash",
    "n_chunks",
    "normalise_item_id",
    "strip_quotes",
]
