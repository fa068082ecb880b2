"""The report: one literal a row, lines in pieces, and the file, whatever the sizes; baskets in segments."""

import random

import pytest
from mining_helpers import written
from pyspark.sql import functions as F

from basketry import basket_segments, basket_table, report_lines, report_rows, write_report
from basketry.operators.ordinal import numbered


def sets(spark, rows):
    return spark.createDataFrame([(len(r), sorted(r)) for r in rows], "k int, itemset array<string>")


def text(candidates, frequent):
    """The whole report, in memory."""
    def section(rows):
        ks = sorted({len(r) for r in rows})
        return "\n\n".join(",".join("('" + "', '".join(r) + "')" for r in sorted(sorted(x) for x in rows if len(x) == k)) for k in ks)
    return ("Candidates:" + "".join(["\n", section(candidates)] if candidates else []) + "\n\nFrequent Itemsets:"
            + "".join(["\n", section(frequent)] if frequent else []))


def some(n, seed):
    rng = random.Random(seed)
    return list({tuple(sorted(rng.sample([f"i{j}" for j in range(40)], rng.choice([1, 2, 2, 2, 3, 5])))) for _ in range(n)})


CASES = {"plain": (some(300, 1), some(100, 2)), "one": ([("a",)], [("a",)]), "none": ([], []), "no_frequent": (some(20, 3), []),
         "no_candidates": ([], some(20, 4)), "signs": ([("a)b",), ("x,y", "('z')")], [("a)b",)]), "gaps": ([("a", "b", "c")], [("q", "r")])}


@pytest.mark.parametrize("case", sorted(CASES))
def test_report_is_the_text(spark, tmp_path, case):
    cand, freq = CASES[case]
    c, f = sets(spark, cand), sets(spark, freq)
    want = text(cand, freq)
    out = str(tmp_path / "report")
    write_report(c, f, out)
    assert written(out) == want
    if case == "one":
        write_report(c, f, out)  # again: it replaces the old one
        assert written(out) == want
    for piece in (7, 1000):
        rows = report_lines(c, f, piece).collect()
        lines = {}
        for r in sorted(rows, key=lambda r: (r["ordinal"], r["piece"])):
            lines[r["ordinal"]] = lines.get(r["ordinal"], "") + r["line"]
        assert "\n".join(lines[i] for i in range(len(lines))) == want
        assert max(r["line"].count("('") for r in rows) <= piece or case == "signs"
    rows = report_rows(c, f).collect()
    assert len(rows) == len(cand) + len(freq)
    split = want.split("\n")
    if case != "signs":
        for r in rows:
            assert split[r["line"]].replace("),(", ")\n(").split("\n")[r["ordinal"]] == r["literal"]


def test_report_spreads_one_size_over_tasks(spark):
    """A single size is written by many tasks, none of which holds the line."""
    many = spark.range(20_000).select(F.lit(1).alias("k"), F.array(F.format_string("i%05d", "id")).alias("itemset"))
    prior = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed, held = numbered(many, ["itemset"])
        per_task = placed.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", prior)
    assert len(per_task) > 2 and max(r["count"] for r in per_task) < 12_000
    rows = placed.orderBy("at").collect()
    assert [r["at"] for r in rows] == list(range(20_000)) and rows[777]["itemset"] == ["i00777"]


@pytest.mark.parametrize("width", [1, 3, 4096])
def test_segments_of_a_wide_basket(spark, width):
    """One basket holds a third of all rows; no array is longer than the width."""
    rows = [("wide", f"i{j:03d}") for j in range(200)] + [("wide", "i000"), (None, "x"), ("n", None)]
    rows += [(f"b{i}", f"i{j:03d}") for i in range(100) for j in range(i, i + 4)]
    pairs = spark.createDataFrame(rows, "basket string, item string")
    got = basket_segments(pairs, width).collect()
    assert max(len(r["items"]) for r in got) <= width
    whole, n = {}, {}
    for r in sorted(got, key=lambda r: (r["basket"], r["segment"])):
        assert r["segment"] * width == len(whole.get(r["basket"], []))  # all segments but the last are full
        whole.setdefault(r["basket"], []).extend(r["items"])
        n[r["basket"]] = n.get(r["basket"], 0) + r["n_rows"]
    want = {r["basket"]: r for r in basket_table(pairs.fillna("")).collect()}
    assert whole == {b: r["items"] for b, r in want.items()} and n == {b: r["n_rows"] for b, r in want.items()}
    assert basket_segments(pairs.limit(0), width).count() == 0
    with pytest.raises(ValueError):
        basket_segments(pairs, 0)
