"""Saved outputs of the original jobs on the small two-column file."""

from mining_helpers import by_k, data, golden_sections, written

from basketry import frequent_itemsets, pair_job, son_candidates
from basketry.sources import read_pairs

# small1, case 1 (basket = user), support 4: every frequent itemset and its
# support, from a brute-force subset count.
SMALL1_CASE1 = {
    ("100",): 5, ("101",): 9, ("102",): 8, ("103",): 4, ("97",): 14, ("98",): 12, ("99",): 12,
    ("100", "101"): 5, ("100", "98"): 4, ("101", "102"): 5, ("101", "97"): 4, ("101", "98"): 4,
    ("101", "99"): 6, ("102", "103"): 4, ("102", "97"): 4, ("102", "98"): 6, ("102", "99"): 4,
    ("103", "99"): 4, ("97", "98"): 8, ("97", "99"): 10, ("98", "99"): 7,
    ("100", "101", "98"): 4, ("101", "97", "99"): 4, ("102", "103", "99"): 4, ("97", "98", "99"): 5,
}


def test_case1_frequent_with_supports(spark):
    pairs = read_pairs(spark, data("small1.csv"), 1)
    for strategy in ("levels", "son", "fpgrowth"):
        rows = frequent_itemsets(pairs, 4, strategy=strategy).collect()
        got = {tuple(r["itemset"]): r["support"] for r in rows}
        assert got == SMALL1_CASE1, strategy


def test_case2_frequent(spark):
    pairs = read_pairs(spark, data("small1.csv"), 2)
    rows = frequent_itemsets(pairs, 9).collect()
    assert [(tuple(r["itemset"]), r["support"]) for r in rows] == [(("13",), 10)]


def test_frequent_equal_saved_outputs(spark):
    for case, support, name in ((1, 4, "results1a.csv"), (2, 9, "results1b.csv")):
        _, want = golden_sections(data(name))
        rows = frequent_itemsets(read_pairs(spark, data("small1.csv"), case), support).collect()
        assert by_k(rows) == want


def test_candidates_match_scala_partitioning(spark):
    # The Scala jobs chunk baskets by the Java string hash of the key.
    for case, support, p, name in ((1, 4, 2, "scala1a.csv"), (2, 9, 3, "scala1b.csv")):
        want, _ = golden_sections(data(name))
        pairs = read_pairs(spark, data("small1.csv"), case)
        got = by_k(son_candidates(pairs, support, p, method="java").collect())
        assert got == want


def test_python_candidates_contain_frequent(spark):
    cands, freq = golden_sections(data("results1a.csv"))
    for c, f in zip(cands, freq):
        assert f <= c


def test_report_frequent_section_text(spark, tmp_path):
    out = str(tmp_path / "report")
    res = pair_job(spark, data("small1.csv"), 1, 4, out=out, n_chunks=2, chunk_method="java")
    lines = [r["line"] for r in res.lines.orderBy("ordinal").collect()]
    golden = open(data("scala1a.csv")).read().split("\n")
    assert lines == golden
    # The sink's part files, read in name order, are the report, byte by byte.
    assert written(out) == open(data("scala1a.csv")).read()


def test_report_case2(spark):
    res = pair_job(spark, data("small1.csv"), 2, 9, n_chunks=3, chunk_method="java")
    lines = [r["line"] for r in res.lines.orderBy("ordinal").collect()]
    assert lines == open(data("scala1b.csv")).read().split("\n")


def test_strategies_agree_small2(spark):
    pairs = read_pairs(spark, data("small2.csv"), 1)
    results = []
    for strategy, kw in (("levels", {}), ("son", {"n_chunks": 3}), ("son", {"n_chunks": 5, "chunk_method": "java"}),
                         ("fpgrowth", {})):
        rows = frequent_itemsets(pairs, 5, strategy=strategy, **kw).collect()
        results.append(sorted((tuple(r["itemset"]), r["support"]) for r in rows))
    assert results[0] and all(r == results[0] for r in results)
