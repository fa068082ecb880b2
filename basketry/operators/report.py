"""Plain-text report: candidates and frequent itemsets, one line per size.

Layout (lines count from 0)::

    Candidates:
    ('a'),('b'),...          <- size 1
                             <- blank line between sizes
    ('a', 'b'),...           <- size 2
    ...
                             <- blank line
    Frequent Itemsets:
    ('a'),...
    ...

A line can hold any number of literals, so no frame here holds a line as one
value: ``report_rows`` has one literal a row with its place in the report, from a
distributed ordinal; ``report_lines`` has the lines in pieces of bounded length;
``write_report`` writes the very bytes of the report, in parallel, as part files
that make the report when read one after the other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.functions.columns import itemset_literal
from basketry.operators.ordinal import numbered
from basketry.plans.physical import release, stable

CANDIDATES_HEADER = "Candidates:"
FREQUENT_HEADER = "Frequent Itemsets:"
CANDIDATES, FREQUENT = "candidates", "frequent"
# Literals of one piece of a line in report_lines.
PIECE = 1000


class _Layout:
    """Where each size's line is: one row per section and size, known from a count."""

    def __init__(self, sizes: dict[tuple[str, int], int]) -> None:
        self.candidates = sorted(k for s, k in sizes if s == CANDIDATES)
        self.frequent = sorted(k for s, k in sizes if s == FREQUENT)
        self.line: dict[tuple[str, int], int] = {}
        self.fixed = [(0, CANDIDATES_HEADER)]
        at = self._section(CANDIDATES, self.candidates, 1)
        self.fixed += [(at, ""), (at + 1, FREQUENT_HEADER)]
        self._section(FREQUENT, self.frequent, at + 2)

    def _section(self, name: str, ks: list[int], at: int) -> int:
        for i, k in enumerate(ks):
            if i:
                self.fixed.append((at, ""))
                at += 1
            self.line[name, k] = at
            at += 1
        return at


def _literals(candidates: DataFrame, frequent: DataFrame) -> DataFrame:
    both = None
    for name, sets in ((CANDIDATES, candidates), (FREQUENT, frequent)):
        part = sets.select(F.lit(name).alias("section"), F.col("k").cast("int").alias("k"), "itemset")
        both = part if both is None else both.union(part)
    return both


def _placed(candidates: DataFrame, frequent: DataFrame) -> tuple[DataFrame, _Layout, DataFrame]:
    """``section, k, line, ordinal, literal`` in the report's order; its layout; rows to release."""
    rows, held = numbered(_literals(candidates, frequent), ["section", "k", "itemset"])
    # A row per section and size: the only rows that come to the driver.
    starts = {(r["section"], r["k"]): (r["at"], r["n"]) for r in rows.groupBy("section", "k").agg(
        F.min("at").alias("at"), F.count(F.lit(1)).alias("n")).collect()}
    layout = _Layout({key: n for key, (_, n) in starts.items()})
    spark = rows.sparkSession
    lines = spark.createDataFrame([(s, k, layout.line[s, k], at) for (s, k), (at, _) in starts.items()],
                                  "section string, k int, line int, start long")
    placed = rows.join(F.broadcast(lines), ["section", "k"]).select(
        "section", "k", "line", (F.col("at") - F.col("start")).alias("ordinal"), itemset_literal("itemset").alias("literal"))
    return placed, layout, held


def report_rows(candidates: DataFrame, frequent: DataFrame) -> DataFrame:
    """``section, k, line, ordinal, literal``: one row per itemset of ``(k, itemset)`` frames.

    ``line`` is the literal's line in the report and ``ordinal`` its place in that
    line, from 0.  Rows come in the report's order.  Empty frames give no rows."""
    placed, _, held = _placed(candidates, frequent)
    out = stable(placed)
    release(held)
    return out


def report_lines(candidates: DataFrame, frequent: DataFrame, piece: int = PIECE) -> DataFrame:
    """``ordinal, piece, line``: the report's lines in pieces of at most ``piece`` literals.

    ``ordinal`` is the line's number, ``piece`` counts from 0 in it.  A piece that
    another one follows ends with the comma between them, so the pieces of a line
    joined are the line; headers and blank lines are one piece each."""
    placed, layout, held = _placed(candidates, frequent)
    n = placed.select("line", F.expr(f"cast(ordinal div {int(piece)} as int)").alias("piece"), "ordinal", "literal")
    last = n.groupBy("line").agg(F.max("piece").alias("last"))
    pieces = (n.groupBy("line", "piece").agg(F.array_sort(F.collect_list(F.struct("ordinal", "literal"))).alias("x"))
              .join(F.broadcast(last), "line")  # a row per line
              .select(F.col("line").alias("ordinal"), "piece", F.concat(
                  F.array_join(F.col("x.literal"), ","), F.when(F.col("piece") < F.col("last"), ",").otherwise("")
              ).alias("line")))
    fixed = pieces.sparkSession.createDataFrame([(at, 0, text) for at, text in layout.fixed],
                                                "ordinal int, piece int, line string")
    out = stable(fixed.union(pieces))
    release(held)
    return out


def write_report(candidates: DataFrame, frequent: DataFrame, path: str) -> None:
    """Write the report to the folder ``path``: its part files, read in name order, are its bytes.

    Every literal ends with a parenthesis, which the writer sets as the end of a
    row; a row begins with what stands before its literal: a comma, a blank line or a
    header.  So rows need no neighbour and are written in parallel, in order.  A
    report without frequent itemsets ends with the header, in a part file of its own
    after the others."""
    placed, layout, held = _placed(candidates, frequent)
    opening = {}
    for name, ks, header in ((CANDIDATES, layout.candidates, CANDIDATES_HEADER), (FREQUENT, layout.frequent, FREQUENT_HEADER)):
        opening.update({(name, k): "\n\n" for k in ks[1:]})
        if ks:
            opening[name, ks[0]] = f"{header}\n"
    if layout.frequent:
        before = "\n\n" if layout.candidates else f"{CANDIDATES_HEADER}\n\n"
        opening[FREQUENT, layout.frequent[0]] = before + opening[FREQUENT, layout.frequent[0]]
    lead = F.lit(",")
    for (name, k), text in opening.items():
        here = (F.col("ordinal") == 0) & (F.col("section") == name) & (F.col("k") == k)
        lead = F.when(here, F.lit(text)).otherwise(lead)
    rows = placed.select(F.concat(lead, F.expr("substring(literal, 1, length(literal) - 1)")).alias("value"))
    rows.write.mode("overwrite").option("lineSep", ")").text(path)
    if not layout.frequent:
        at = held.rdd.getNumPartitions()
        end = f"\n\n{FREQUENT_HEADER}" if layout.candidates else f"{CANDIDATES_HEADER}\n\n{FREQUENT_HEADER}"
        spark = placed.sparkSession
        tail = spark.range(0, at + 1, 1, at + 1).where(F.col("id") == at).select(F.lit(end[:-1]).alias("value"))
        tail.write.mode("append").option("lineSep", end[-1]).text(path)  # after the last part
    release(held)
