"""

``entry(spark)`` runs the flagship query at sf0.001; ``queries()`` maps every
registered operator/query to a callable ``(spark, sf_dir) -> DataFrame``;
``oracle_sql()`` gives the DuckDB SQL for each of them over the same tables.
Itemsets are returned as comma-joined text (``itemset``) so both sides hash
the same values; every computed column carries the same alias on both sides.
"""

from __future__ import annotations

import os
import re
import sys
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from basketry.functions.columns import contains_all, itemset_text, normalise_item_id  # noqa: E402
from basketry.operators.baskets import (  # noqa: E402
    basket_segments,
    basket_sizes,
    basket_table,
    chunk_item_counts,
    chunk_sizes,
    prepared_pairs,
)
from basketry.operators.levels import frequent_items, frequent_pairs, generate_candidates  # noqa: E402
from basketry.operators.report import report_lines, report_rows  # noqa: E402
from basketry.operators.son import count_candidates, mine_son, son_candidates  # noqa: E402
from basketry.plans.mine import frequent_itemsets, sizes_by_k  # noqa: E402
from basketry.plans.physical import Tuning, delete_path, stable  # noqa: E402
from basketry.session import ensure_checkpoint_dir, local_scratch  # noqa: E402
from basketry.sources import tables as V  # noqa: E402
from basketry.sources.text import read_pairs, read_retail, retail_pairs  # noqa: E402

try:  # the training-data operators are optional: everything else works without them
    from basketry.llm import queries as LLM  # noqa: E402
except ModuleNotFoundError as missing:
    print(f"the training-data queries are left out: {missing}", file=sys.stderr)
    LLM = None

# Fixed query parameters (support thresholds, chunk count, size filters).
ORDER_BRAND_SUPPORT = 330
ORDER_BRAND_LOW_SUPPORT = 30
PART_SUPPLIER_SUPPORT = 150
CUSTOMER_PART_SUPPORT = 5
DAY_USER_MIN_ROWS = 3
DAY_USER_SUPPORT = 30
RETAIL_MIN_ROWS = 5
RETAIL_SUPPORT = 60
CHUNKS = 4
ID_WIDTH = 12
REPORT_PIECE = 50
SEGMENT_WIDTH = 8
# Neither closed nor sorted nor distinct, and one item that no basket has.
CONTAINMENT_LIST = [("Brand#5", "Brand#11"), ("Brand#7", "Brand#23", "Brand#14"), ("Brand#12",), ("Brand#11", "Brand#5"),
                    ("Brand#13", "none"), ("Brand#16", "Brand#19", "Brand#2", "Brand#4")]


def _flat(df: DataFrame) -> DataFrame:
    """(k, itemset text, support) with stable types."""
    cols = [F.col("k").cast("int").alias("k"), itemset_text("itemset").alias("itemset")]
    if "support" in df.columns:
        cols.append(F.col("support").cast("long").alias("support"))
    return df.select(*cols)


def _basket_view(df: DataFrame) -> DataFrame:
    t = basket_table(df)
    return t.select("basket", F.col("n_rows").cast("long").alias("n_rows"),
                    F.col("n_items").cast("long").alias("n_items"),
                    F.array_join("items", ",").alias("items"))


# ---------------------------------------------------------------- queries
def q_transaction_pairs(spark, d):
    return V.order_brand(spark, d)


def q_baskets_by_user(spark, d):
    return _basket_view(V.order_brand(spark, d))


def q_baskets_inverted(spark, d):
    return _basket_view(V.part_supplier(spark, d))


def q_composite_baskets(spark, d):
    pairs = retail_pairs(V.event_lines(spark, d), normalise=False)
    return _basket_view(pairs)


def q_item_id_normalised(spark, d):
    li = V.table(spark, d, "lineitem")
    raw = F.lpad(F.col("l_partkey").cast("string"), ID_WIDTH, "0")
    return li.select(F.col("l_orderkey").alias("basket"), raw.alias("item_raw"),
                     normalise_item_id(raw).alias("item"))


def q_basket_size_filter(spark, d):
    s = basket_sizes(V.day_user_event(spark, d))
    return s.where(F.col("n_rows") > DAY_USER_MIN_ROWS).select(
        "basket", F.col("n_rows").cast("long").alias("n_rows"), F.col("n_items").cast("long").alias("n_items"))


def q_chunk_sizes(spark, d):
    c = chunk_sizes(V.order_brand(spark, d), CHUNKS)
    return c.select(F.col("chunk").cast("int").alias("chunk"), F.col("n_baskets").cast("long").alias("n_baskets"),
                    F.col("n_pairs").cast("long").alias("n_pairs"), F.col("n_rows").cast("long").alias("n_rows"))


def q_chunk_item_counts(spark, d):
    c = chunk_item_counts(V.order_brand(spark, d), ORDER_BRAND_SUPPORT, CHUNKS)
    return c.select(F.col("chunk").cast("int").alias("chunk"), "item", F.col("n").cast("long").alias("n"))


def q_item_support(spark, d):
    return _flat(frequent_items(V.order_brand(spark, d), ORDER_BRAND_SUPPORT))


def q_candidate_join(spark, d):
    cand = generate_candidates(frequent_pairs(V.order_brand(spark, d), ORDER_BRAND_SUPPORT), 3)
    return cand.select(F.lit(3).alias("k"), itemset_text("ids").alias("itemset"))


def q_itemset_containment(spark, d):
    pairs = prepared_pairs(V.order_brand(spark, d))
    cands = son_candidates(pairs, ORDER_BRAND_SUPPORT, CHUNKS)
    return _flat(count_candidates(pairs, cands))


def q_son_candidates(spark, d):
    return _flat(son_candidates(V.order_brand(spark, d), ORDER_BRAND_SUPPORT, CHUNKS))


def q_frequent_case1(spark, d):
    return _flat(frequent_itemsets(V.order_brand(spark, d), ORDER_BRAND_SUPPORT, strategy="levels"))


def q_frequent_case2(spark, d):
    return _flat(frequent_itemsets(V.part_supplier(spark, d), PART_SUPPLIER_SUPPORT, strategy="levels"))


def q_frequent_filtered(spark, d):
    return _flat(frequent_itemsets(V.day_user_event(spark, d), DAY_USER_SUPPORT, strategy="levels",
                                   min_rows=DAY_USER_MIN_ROWS))


def q_frequent_son(spark, d):
    return _flat(frequent_itemsets(V.order_brand(spark, d), ORDER_BRAND_SUPPORT, strategy="son",
                                   n_chunks=CHUNKS))


def q_frequent_fpgrowth(spark, d):
    return _flat(frequent_itemsets(V.order_brand(spark, d), ORDER_BRAND_SUPPORT, strategy="fpgrowth"))


def q_frequent_retail(spark, d):
    return _flat(frequent_itemsets(V.date_customer_brand(spark, d), RETAIL_SUPPORT, strategy="son",
                                   min_rows=RETAIL_MIN_ROWS, chunk_rule="half"))


def q_frequent_low_support(spark, d):
    return _flat(frequent_itemsets(V.order_brand(spark, d), ORDER_BRAND_LOW_SUPPORT, strategy="levels"))


def q_frequent_customer_part(spark, d):
    """Pairs of parts that customers share: counted by hash before any is made."""
    return _flat(frequent_itemsets(V.customer_part(spark, d), CUSTOMER_PART_SUPPORT))


def q_frequent_small_broadcast(spark, d):
    """Candidates beyond the broadcast budget: filtered where the rows lie, then shuffled."""
    return _flat(frequent_itemsets(V.order_brand(spark, d), ORDER_BRAND_LOW_SUPPORT, tuning=Tuning(broadcast_bytes=16 << 10)))


def q_frequent_resumable(spark, d):
    """Levels kept in a folder until the run ends."""
    folder = f"{ensure_checkpoint_dir(spark)}/levels-{uuid.uuid4().hex}"
    return _flat(frequent_itemsets(V.order_brand(spark, d), ORDER_BRAND_LOW_SUPPORT, resume=folder))


def q_itemsets_per_size(spark, d):
    s = sizes_by_k(frequent_itemsets(V.order_brand(spark, d), ORDER_BRAND_LOW_SUPPORT))
    return s.select(F.col("k").cast("int").alias("k"), F.col("n_itemsets").cast("long").alias("n_itemsets"),
                    F.col("min_support").cast("long").alias("min_support"),
                    F.col("max_support").cast("long").alias("max_support"))


def q_itemset_report(spark, d):
    pairs = V.order_brand(spark, d)
    cands, freq = mine_son(pairs, ORDER_BRAND_SUPPORT, CHUNKS)
    return report_lines(cands, freq, REPORT_PIECE)


def q_report_rows(spark, d):
    return report_rows(*mine_son(V.order_brand(spark, d), ORDER_BRAND_LOW_SUPPORT, CHUNKS))


def q_basket_segments(spark, d):
    s = basket_segments(V.part_supplier(spark, d), SEGMENT_WIDTH)
    return s.select("basket", "segment", F.col("n_rows").cast("long").alias("n_rows"),
                    F.array_join("items", ",").alias("items"))


def _text_folder(spark, lines: DataFrame, header: str) -> str:
    """Write table-derived lines as a folder of text files; the first file begins with the header."""
    path = f"{ensure_checkpoint_dir(spark)}/lines-{uuid.uuid4().hex}"
    head = spark.createDataFrame([(header,)], "value string").coalesce(1)
    head.union(lines.select("value")).write.text(path)
    return path


def _read_once(spark, path: str, frame: DataFrame) -> DataFrame:
    """The rows read from a scratch folder; the folder goes."""
    rows = stable(frame)
    delete_path(spark, path)
    return rows


def _pair_lines(spark, d):
    rows = V.order_brand(spark, d)
    return rows.select(F.concat_ws(",", F.col("basket").cast("string"), "item").alias("value"))


def q_text_pairs_case1(spark, d):
    path = _text_folder(spark, _pair_lines(spark, d), "user_id,business_id")
    return _read_once(spark, path, read_pairs(spark, path, 1))


def q_text_pairs_case2(spark, d):
    path = _text_folder(spark, _pair_lines(spark, d), "user_id,business_id")
    return _read_once(spark, path, read_pairs(spark, path, "2"))


def q_text_retail(spark, d):
    o = V.table(spark, d, "orders")
    fields = [F.to_date("o_orderdate").cast("string"), F.col("o_custkey").cast("string"), F.lit("x"), F.lit(""), F.lit(""),
              F.lpad((F.col("o_orderkey") % 1000).cast("string"), 24, "0")]
    lines = o.select(F.concat_ws(",", *[F.concat(F.lit('"'), f, F.lit('"')) for f in fields]).alias("value"))
    path = _text_folder(spark, lines, '"date","customer","a","b","c","product"')
    return _read_once(spark, path, read_retail(spark, path))


def q_son_candidates_repeats(spark, d):
    return _flat(son_candidates(V.order_brand(spark, d), ORDER_BRAND_SUPPORT, CHUNKS, count_repeats=True))


def q_containment_any(spark, d):
    listed = spark.createDataFrame([(list(x),) for x in CONTAINMENT_LIST], "itemset array<string>")
    return _flat(count_candidates(V.order_brand(spark, d), listed))


def q_basket_contains(spark, d):
    t = basket_table(V.order_brand(spark, d))
    wanted = F.array(*[F.lit(x) for x in CONTAINMENT_LIST[0]])
    return t.where(contains_all(wanted, "items")).select("basket", F.col("n_items").cast("long").alias("n_items"))


_QUERIES = {
    "transaction_pairs": q_transaction_pairs,
    "baskets_by_user": q_baskets_by_user,
    "baskets_inverted": q_baskets_inverted,
    "composite_baskets": q_composite_baskets,
    "item_id_normalised": q_item_id_normalised,
    "basket_size_filter": q_basket_size_filter,
    "chunk_sizes": q_chunk_sizes,
    "chunk_item_counts": q_chunk_item_counts,
    "item_support": q_item_support,
    "candidate_join": q_candidate_join,
    "itemset_containment": q_itemset_containment,
    "son_candidates": q_son_candidates,
    "frequent_case1": q_frequent_case1,
    "frequent_case2": q_frequent_case2,
    "frequent_filtered": q_frequent_filtered,
    "frequent_son": q_frequent_son,
    "frequent_fpgrowth": q_frequent_fpgrowth,
    "frequent_retail": q_frequent_retail,
    "frequent_low_support": q_frequent_low_support,
    "frequent_customer_part": q_frequent_customer_part,
    "frequent_small_broadcast": q_frequent_small_broadcast,
    "frequent_resumable": q_frequent_resumable,
    "itemsets_per_size": q_itemsets_per_size,
    "itemset_report": q_itemset_report,
    "report_rows": q_report_rows,
    "basket_segments": q_basket_segments,
    "text_pairs_case1": q_text_pairs_case1,
    "text_pairs_case2": q_text_pairs_case2,
    "text_retail": q_text_retail,
    "son_candidates_repeats": q_son_candidates_repeats,
    "containment_any": q_containment_any,
    "basket_contains": q_basket_contains,
}


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: frequent itemsets of order x brand at support 30, sf0.001."""
    local_scratch(spark)
    pairs = V.order_brand(spark, "/root/testdata/sf0.001")
    return _flat(frequent_itemsets(pairs, ORDER_BRAND_LOW_SUPPORT, strategy="levels"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def wrap(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            local_scratch(spark)
            return fn(spark, sf_dir)
        run.__name__ = fn.__name__
        return run
    every = _QUERIES | (LLM.queries() if LLM else {})
    return {name: wrap(fn) for name, fn in every.items()}


# ---------------------------------------------------------------- oracle SQL
VIEW_SQL = {
    "order_brand": "SELECT l_orderkey AS basket, p_brand AS item FROM lineitem JOIN part ON l_partkey = p_partkey",
    "part_supplier": "SELECT l_partkey AS basket, CAST(l_suppkey AS VARCHAR) AS item FROM lineitem",
    "customer_part": ("SELECT o_custkey AS basket, CAST(l_partkey AS VARCHAR) AS item FROM lineitem "
                      "JOIN orders ON l_orderkey = o_orderkey"),
    "day_user_event": ("SELECT CAST(CAST(ts AS DATE) AS VARCHAR) || '-' || CAST(user_id AS VARCHAR) AS basket, "
                       "event_type AS item FROM events"),
    "date_customer_brand": (
        "SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) || '-' || CAST(o_custkey AS VARCHAR) AS basket, "
        "p_brand AS item FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey"),
}


def _pairs_cte(view: str, min_rows: int | None = None) -> str:
    raw = f"raw AS ({VIEW_SQL[view]})"
    if min_rows is None:
        return f"{raw}, p AS (SELECT DISTINCT basket, item FROM raw)"
    return (f"{raw}, kept AS (SELECT basket FROM raw GROUP BY basket HAVING count(*) > {min_rows}), "
            f"p AS (SELECT DISTINCT basket, item FROM raw WHERE basket IN (SELECT basket FROM kept))")


def _levels_ctes(support: int, depth: int, chunked: bool = False, scale: int = 1,
                 f: str = "f", q: str = "q") -> list[str]:
    """CTEs {f}1..{f}D (frequent sets, columns i1..ik, [chunk], support) and
    {q}1..{q}(D-1) (their occurrences per basket), unrolled level by level."""
    g = "chunk, " if chunked else ""
    ga = "a.chunk, " if chunked else ""
    src = "pc" if chunked else "p"
    cond = f"count(*) * {scale} >= {support}"
    ctes = [f"{f}1 AS (SELECT {g}item AS i1, count(*) AS support FROM {src} GROUP BY {g}item HAVING {cond})",
            f"{q}1 AS (SELECT x.basket, {'x.chunk, ' if chunked else ''}x.item AS i1 FROM {src} x "
            f"JOIN {f}1 ON x.item = {f}1.i1{f' AND x.chunk = {f}1.chunk' if chunked else ''})"]
    for k in range(2, depth + 1):
        prev = ", ".join(f"a.i{j}" for j in range(1, k))
        ctes.append(
            f"{f}{k} AS (SELECT {ga}{prev}, b.i1 AS i{k}, count(*) AS support FROM {q}{k - 1} a JOIN {q}1 b "
            f"ON a.basket = b.basket AND b.i1 > a.i{k - 1} GROUP BY {ga}{prev}, b.i1 HAVING {cond})")
        if k < depth:
            on = " AND ".join([f"ff.i{j} = a.i{j}" for j in range(1, k)] + [f"ff.i{k} = b.i1"]
                              + (["ff.chunk = a.chunk"] if chunked else []))
            ctes.append(
                f"{q}{k} AS (SELECT a.basket, {ga}{prev}, b.i1 AS i{k} FROM {q}{k - 1} a JOIN {q}1 b "
                f"ON a.basket = b.basket AND b.i1 > a.i{k - 1} JOIN {f}{k} ff ON {on})")
    return ctes


def _itemset_expr(k: int, prefix: str = "") -> str:
    return " || ',' || ".join(f"{prefix}i{j}" for j in range(1, k + 1))


def _frequent_sql(view: str, support: int, depth: int, min_rows: int | None = None) -> str:
    ctes = [_pairs_cte(view, min_rows)] + _levels_ctes(support, depth)
    sel = " UNION ALL ".join(
        f"SELECT CAST({k} AS INTEGER) AS k, {_itemset_expr(k)} AS itemset, support FROM f{k}"
        for k in range(1, depth + 1))
    return "WITH " + ", ".join(ctes) + " " + sel


def _materialised(sql: str) -> str:
    """Each level evaluated once, where the chain of levels is deep and wide."""
    return re.sub(r"\b([cfgqr]\d|p|pc|raw) AS \(", r"\1 AS MATERIALIZED (", sql)


def _son_ctes(view: str, support: int, p: int, depth: int) -> list[str]:
    ctes = [_pairs_cte(view), f"pc AS (SELECT basket, item, CAST(basket % {p} AS INTEGER) AS chunk FROM p)"]
    ctes += _levels_ctes(support, depth, chunked=True, scale=p)
    for k in range(1, depth + 1):
        keys = ", ".join(f"i{j}" for j in range(1, k + 1))
        ctes.append(f"c{k} AS (SELECT DISTINCT {keys} FROM f{k})")
    return ctes


def _son_candidates_sql(view: str, support: int, p: int, depth: int) -> str:
    ctes = _son_ctes(view, support, p, depth)
    sel = " UNION ALL ".join(
        f"SELECT CAST({k} AS INTEGER) AS k, {_itemset_expr(k)} AS itemset FROM c{k}" for k in range(1, depth + 1))
    return "WITH " + ", ".join(ctes) + " " + sel


def _containment_sql(view: str, support: int, p: int, depth: int) -> str:
    """Exact support of every SON candidate (found in at least one basket)."""
    ctes = _son_ctes(view, support, p, depth)
    parts = []
    for k in range(1, depth + 1):
        joins = " ".join(f"JOIN p x{j} ON x{j}.basket = x1.basket AND x{j}.item = c.i{j}" for j in range(2, k + 1))
        keys = ", ".join(f"c.i{j}" for j in range(1, k + 1))
        parts.append(
            f"SELECT CAST({k} AS INTEGER) AS k, {_itemset_expr(k, 'c.')} AS itemset, count(*) AS support "
            f"FROM c{k} c JOIN p x1 ON x1.item = c.i1 {joins} GROUP BY {keys}")
    return "WITH " + ", ".join(ctes) + " " + " UNION ALL ".join(parts)


def _listed_sql(view: str) -> str:
    """Exact support of each different set of ``CONTAINMENT_LIST`` that some basket holds."""
    parts = []
    for items in sorted({tuple(sorted(x)) for x in CONTAINMENT_LIST}):
        has = " AND ".join(f"bool_or(item = '{x}')" for x in items)
        parts.append(f"SELECT CAST({len(items)} AS INTEGER) AS k, '{','.join(items)}' AS itemset, count(*) AS support "
                     f"FROM (SELECT basket FROM p GROUP BY basket HAVING {has}) HAVING count(*) > 0")
    return f"WITH {_pairs_cte(view)} " + " UNION ALL ".join(parts)


def _literal_sql(k: int) -> str:
    q = 2 * "'"  # a quote inside an SQL string
    return f"'({q}' || " + f" || '{q}, {q}' || ".join(f"i{j}" for j in range(1, k + 1)) + f" || '{q})'"


def _placed_ctes(view: str, support: int, p: int, depth: int) -> list[str]:
    """CTE ``placed(section, k, line, ordinal, literal)`` of both passes."""
    ctes = _son_ctes(view, support, p, depth) + _levels_ctes(support, depth, f="g", q="r")
    for name, table in (("candidates", "c"), ("frequent", "g")):
        ctes.append(f"{name} AS (" + " UNION ALL ".join(
            f"SELECT '{name}' AS section, {k} AS k, row_number() OVER (ORDER BY {', '.join(f'i{j}' for j in range(1, k + 1))}) - 1 "
            f"AS ordinal, {_literal_sql(k)} AS literal FROM {table}{k}" for k in range(1, depth + 1)) + ")")
    ctes.append("nc AS (SELECT coalesce(max(k), 0) AS n FROM candidates)")
    # Lines: the header, then a line and a blank one for each size; the second section follows a blank line.
    ctes.append("base AS (SELECT CASE WHEN n > 0 THEN 2 * n + 1 ELSE 2 END AS b FROM nc)")
    ctes.append("placed AS (SELECT section, k, 2 * k - 1 AS line, ordinal, literal FROM candidates "
                "UNION ALL SELECT section, k, b + 2 * k - 1, ordinal, literal FROM frequent, base)")
    return ctes


def _report_rows_sql(view: str, support: int, p: int, depth: int) -> str:
    return ("WITH " + ", ".join(_placed_ctes(view, support, p, depth)) +
            " SELECT section, CAST(k AS INTEGER) AS k, CAST(line AS INTEGER) AS line, CAST(ordinal AS BIGINT) AS ordinal, "
            "literal FROM placed")


def _report_sql(view: str, support: int, p: int, depth: int) -> str:
    """The report's lines in pieces of ``REPORT_PIECE`` literals."""
    ctes = _placed_ctes(view, support, p, depth)
    ctes.append(f"cut AS (SELECT line, ordinal // {REPORT_PIECE} AS piece, string_agg(literal, ',' ORDER BY ordinal) AS text "
                "FROM placed GROUP BY 1, 2)")
    body = (
        "SELECT CAST(0 AS INTEGER) AS ordinal, CAST(0 AS INTEGER) AS piece, 'Candidates:' AS line "
        "UNION ALL SELECT CAST(b - 1 AS INTEGER), 0, '' FROM base "
        "UNION ALL SELECT CAST(b AS INTEGER), 0, 'Frequent Itemsets:' FROM base "
        "UNION ALL SELECT CAST(line + 1 AS INTEGER), 0, '' FROM (SELECT section, line, max(line) OVER (PARTITION BY section) "
        "AS last FROM placed GROUP BY section, line) WHERE line < last "
        "UNION ALL SELECT CAST(line AS INTEGER), CAST(piece AS INTEGER), text || CASE WHEN piece < max(piece) OVER "
        "(PARTITION BY line) THEN ',' ELSE '' END FROM cut")
    return "WITH " + ", ".join(ctes) + " " + body


def _basket_view_sql(view: str) -> str:
    return (f"WITH raw AS ({VIEW_SQL[view]}) SELECT basket, count(*) AS n_rows, count(DISTINCT item) AS n_items, "
            "array_to_string(list_sort(list_distinct(list(item))), ',') AS items FROM raw GROUP BY basket")


def oracle_sql() -> dict[str, str]:
    ob, s, lo = "order_brand", ORDER_BRAND_SUPPORT, ORDER_BRAND_LOW_SUPPORT
    f_ob = _frequent_sql(ob, s, 4)
    return (LLM.oracle_sql() if LLM else {}) | {
        "transaction_pairs": VIEW_SQL[ob],
        "baskets_by_user": _basket_view_sql(ob),
        "baskets_inverted": _basket_view_sql("part_supplier"),
        "composite_baskets": _basket_view_sql("day_user_event"),
        "item_id_normalised": (
            f"SELECT l_orderkey AS basket, lpad(CAST(l_partkey AS VARCHAR), {ID_WIDTH}, '0') AS item_raw, "
            f"CAST(CAST(lpad(CAST(l_partkey AS VARCHAR), {ID_WIDTH}, '0') AS BIGINT) AS VARCHAR) AS item "
            "FROM lineitem"),
        "basket_size_filter": (
            f"WITH raw AS ({VIEW_SQL['day_user_event']}) SELECT basket, count(*) AS n_rows, "
            f"count(DISTINCT item) AS n_items FROM raw GROUP BY basket HAVING count(*) > {DAY_USER_MIN_ROWS}"),
        "chunk_sizes": (
            f"WITH raw AS ({VIEW_SQL[ob]}) SELECT CAST(basket % {CHUNKS} AS INTEGER) AS chunk, "
            "count(DISTINCT basket) AS n_baskets, count(DISTINCT (basket, item)) AS n_pairs, count(*) AS n_rows "
            "FROM raw GROUP BY 1"),
        "chunk_item_counts": (
            f"WITH raw AS ({VIEW_SQL[ob]}) SELECT CAST(basket % {CHUNKS} AS INTEGER) AS chunk, item, count(*) AS n "
            f"FROM raw GROUP BY 1, 2 HAVING count(*) * {CHUNKS} >= {s}"),
        "item_support": _frequent_sql(ob, s, 1),
        "candidate_join": (
            "WITH " + ", ".join([_pairs_cte(ob)] + _levels_ctes(s, 2)) +
            " SELECT CAST(3 AS INTEGER) AS k, a.i1 || ',' || a.i2 || ',' || b.i2 AS itemset "
            "FROM f2 a JOIN f2 b ON a.i1 = b.i1 AND b.i2 > a.i2 "
            "WHERE EXISTS (SELECT 1 FROM f2 c WHERE c.i1 = a.i2 AND c.i2 = b.i2)"),
        "itemset_containment": _containment_sql(ob, s, CHUNKS, 4),
        "son_candidates": _son_candidates_sql(ob, s, CHUNKS, 4),
        "frequent_case1": f_ob,
        "frequent_case2": _frequent_sql("part_supplier", PART_SUPPLIER_SUPPORT, 11),
        "frequent_filtered": _frequent_sql("day_user_event", DAY_USER_SUPPORT, 6, min_rows=DAY_USER_MIN_ROWS),
        "frequent_son": f_ob,
        "frequent_fpgrowth": f_ob,
        "frequent_retail": _frequent_sql("date_customer_brand", RETAIL_SUPPORT, 5, min_rows=RETAIL_MIN_ROWS),
        "frequent_low_support": _frequent_sql(ob, lo, 6),
        "frequent_customer_part": _materialised(_frequent_sql("customer_part", CUSTOMER_PART_SUPPORT, 5)),
        "frequent_small_broadcast": _frequent_sql(ob, lo, 6),
        "frequent_resumable": _frequent_sql(ob, lo, 6),
        "itemsets_per_size": (
            "WITH fi AS (" + _frequent_sql(ob, lo, 6) + ") SELECT k, count(*) AS n_itemsets, "
            "min(support) AS min_support, max(support) AS max_support FROM fi GROUP BY k"),
        "itemset_report": _report_sql(ob, s, CHUNKS, 4),
        "report_rows": _materialised(_report_rows_sql(ob, lo, CHUNKS, 7)),
        "basket_segments": (
            f"WITH raw AS ({VIEW_SQL['part_supplier']}), d AS (SELECT basket, item, count(*) AS c FROM raw GROUP BY 1, 2), "
            "o AS (SELECT *, row_number() OVER (PARTITION BY basket ORDER BY item) - 1 AS i FROM d) "
            f"SELECT basket, CAST(i // {SEGMENT_WIDTH} AS BIGINT) AS segment, CAST(sum(c) AS BIGINT) AS n_rows, "
            f"string_agg(item, ',' ORDER BY item) AS items FROM o GROUP BY basket, i // {SEGMENT_WIDTH}"),
        "text_pairs_case1": f"SELECT CAST(basket AS VARCHAR) AS basket, item FROM ({VIEW_SQL[ob]})",
        "text_pairs_case2": f"SELECT item AS basket, CAST(basket AS VARCHAR) AS item FROM ({VIEW_SQL[ob]})",
        "text_retail": ("SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) || '-' || CAST(o_custkey AS VARCHAR) AS basket, "
                        "CAST(o_orderkey % 1000 AS VARCHAR) AS item FROM orders"),
        "son_candidates_repeats": (
            f"WITH c AS ({_son_candidates_sql(ob, s, CHUNKS, 4)}), raw AS ({VIEW_SQL[ob]}) "
            "SELECT k, itemset FROM c WHERE k > 1 UNION ALL SELECT DISTINCT CAST(1 AS INTEGER) AS k, item AS itemset FROM "
            f"(SELECT basket % {CHUNKS} AS chunk, item FROM raw GROUP BY 1, 2 HAVING count(*) * {CHUNKS} >= {s})"),
        "containment_any": _listed_sql(ob),
        "basket_contains": (
            f"WITH raw AS ({VIEW_SQL[ob]}) SELECT basket, count(DISTINCT item) AS n_items FROM raw GROUP BY basket HAVING "
            + " AND ".join(f"bool_or(item = '{x}')" for x in CONTAINMENT_LIST[0])),
    }
