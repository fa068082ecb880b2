"""Scalar column expressions: parsing, keys, chunk assignment, itemset text."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_quotes(c) -> Column:
    """Drop the first and the last character (a quoted CSV field), like ``s[1:-1]``."""
    c = _col(c)
    return F.when(F.length(c) >= 2, F.substring(c, F.lit(2), F.length(c) - 2)).otherwise(F.lit(""))


def composite_key(*cols, sep: str = "-") -> Column:
    """Basket key made of several text fields joined by ``sep`` (date + customer).

    A null field is the empty field, so every part keeps its place."""
    return F.concat_ws(sep, *[F.coalesce(_col(c).cast("string"), F.lit("")) for c in cols])


def normalise_item_id(c) -> Column:
    """Text id -> integer -> text, dropping leading zeros ("0047" -> "47").

    Integers may have any number of digits.  A value that is not an integer
    fails under ANSI mode, as the reference's ``int()`` does; with ANSI off it
    becomes null.
    """
    c = F.trim(_col(c))
    plain = F.regexp_replace(F.regexp_replace(c, r"^\+", ""), r"^(-?)0+(?=\d)", "$1")
    return F.when(c.rlike(r"^[+-]?\d+$"), F.when(plain == "-0", F.lit("0")).otherwise(plain)).otherwise(
        c.cast("bigint").cast("string"))


def n_chunks(support: int, rule: str = "half") -> int:
    """Chunk count of the two-pass strategy.

    ``half``: ``min(support // 2, 8)``; ``sqrt``: ``round(sqrt(support))``.
    Both are floored at one chunk (the first rule gives 0 for support 1).
    """
    if support < 1:
        raise ValueError("support must be at least 1")
    if rule == "half":
        p = min(support // 2, 8)
    elif rule == "sqrt":
        p = round(math.sqrt(support))
    else:
        raise ValueError(f"unknown chunk rule {rule!r}")
    return max(1, int(p))


def java_string_hash(c) -> Column:
    """Java ``String.hashCode`` of a text column as a signed 32-bit value.

    ``h = 31 * h + ch`` over the characters, wrapped to 32 bits.  Characters are
    taken as code points, which equals Java's UTF-16 units inside the BMP.
    """
    c = _col(c)
    two32 = 4294967296
    h = F.aggregate(
        F.sequence(F.lit(1), F.greatest(F.length(c), F.lit(1))),
        F.lit(0).cast("bigint"),
        lambda acc, i: F.when(
            i <= F.length(c), F.pmod(acc * 31 + F.ascii(F.substring(c, i, 1)).cast("bigint"), F.lit(two32))
        ).otherwise(acc),
    )
    return F.when(h >= 2147483648, h - two32).otherwise(h).cast("int")


def chunk_of(c, p: int, method: str = "auto", dtype=None) -> Column:
    """Logical chunk of a basket key: an int in ``[0, p)``.

    ``mod``: ``pmod(key, p)`` for integer keys; ``xxhash``: ``pmod(xxhash64(key), p)``;
    ``java``: floor-mod of the Java string hash (reproduces a Scala HashPartitioner);
    ``auto``: ``mod`` when ``dtype`` is integral, else ``xxhash``.
    The chunk is a column, never the physical partition, which AQE may change.
    """
    c = _col(c)
    if method == "auto":
        method = "mod" if isinstance(dtype, IntegralType) else "xxhash"
    if method == "mod":
        return F.pmod(c.cast("bigint"), F.lit(p)).cast("int")
    if method == "xxhash":
        return F.pmod(F.xxhash64(c), F.lit(p)).cast("int")
    if method == "java":
        return F.pmod(java_string_hash(c.cast("string")).cast("bigint"), F.lit(p)).cast("int")
    raise ValueError(f"unknown chunk method {method!r}")


def itemset_literal(c) -> Column:
    """Report literal of a sorted itemset: ``('a')`` or ``('a', 'b')``."""
    return F.concat(F.lit("('"), F.array_join(_col(c), "', '"), F.lit("')"))


def itemset_text(c) -> Column:
    """Comma-joined itemset, the flat form used in query results."""
    return F.array_join(_col(c), ",")


def contains_all(itemset, items) -> Column:
    """Containment predicate: every element of ``itemset`` is in ``items``."""
    items = _col(items)
    return F.forall(_col(itemset), lambda x: F.array_contains(items, x))
