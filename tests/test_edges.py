"""Edge cases: repeats, size filter, ids, retail lines, empty input, support rules."""

import pytest
from mining_helpers import write_text

from basketry import basket_sizes, frequent_itemsets, mine_levels, prepared_pairs, retail_job, son_candidates
from basketry.sources import read_pairs, read_retail


def pairs_df(spark, rows):
    return spark.createDataFrame(rows, "basket string, item string")


def test_repeats_size_filter_counts_rows_support_counts_baskets(spark):
    pairs = pairs_df(spark, [("a", "x"), ("a", "x"), ("a", "x"), ("b", "x"), ("b", "y")])
    sizes = {r["basket"]: (r["n_rows"], r["n_items"]) for r in basket_sizes(pairs).collect()}
    assert sizes == {"a": (3, 1), "b": (2, 2)}
    assert [r["basket"] for r in prepared_pairs(pairs, 2).select("basket").distinct().collect()] == ["a"]
    rows = frequent_itemsets(pairs, 2).collect()
    assert [(tuple(r["itemset"]), r["support"]) for r in rows] == [(("x",), 2)]


def test_repeats_in_first_pass(spark):
    # With occurrence counts, a repeated item reaches s/p in a chunk on its own.
    pairs = pairs_df(spark, [("a", "x"), ("a", "x"), ("b", "y")])
    distinct = {tuple(r["itemset"]) for r in son_candidates(pairs, 2, 1).collect()}
    repeats = {tuple(r["itemset"]) for r in son_candidates(pairs, 2, 1, count_repeats=True).collect()}
    assert distinct == set() and repeats == {("x",)}


def test_leading_zeros(spark, tmp_path):
    text = "\n".join([
        '"DATE","CUSTOMER","AGE","AREA","CAT","PRODUCT"',
        '"2000-11-01","1","a","b","c","0047"',
        '"2000-11-01","1","a","b","c","47"',
        '"2000-11-01","2","a","b","c","047"',
    ])
    pairs = read_retail(spark, write_text(tmp_path, "zeros.csv", text))
    assert {r["item"] for r in pairs.collect()} == {"47"}
    rows = frequent_itemsets(pairs, 2).collect()
    assert [(tuple(r["itemset"]), r["support"]) for r in rows] == [(("47",), 2)]


def test_retail_lines_and_job(spark, tmp_path):
    text = "\n".join([
        '"TRANSACTION_DT","CUSTOMER_ID","AGE_GROUP","PIN_CODE","PRODUCT_SUBCLASS","PRODUCT_ID","AMOUNT"',
        '"11/1/2000","01104905","45-49","115","110411","4710199010372","2"',
        '"11/1/2000","01104905","45-49","115","130315","4909978112950","1"',
        '"11/1/2000","01104905","45-49","115","110217","4710199010372","1"',
        '"11/2/2000","01104905","45-49","115","110411","4710199010372","1"',
        '"11/2/2000","01104905","45-49","115","130315","4909978112950","1"',
        '"11/2/2000","00418683","45-49","115","100102","04710199010372","1"',
    ])
    path = write_text(tmp_path, "retail.csv", text)
    pairs = read_retail(spark, path)
    keys = {r["basket"] for r in pairs.collect()}
    assert keys == {"11/1/2000-01104905", "11/2/2000-01104905", "11/2/2000-00418683"}
    res = retail_job(spark, path, 1, 2, n_chunks=1)
    got = sorted((tuple(r["itemset"]), r["support"]) for r in res.frequent.collect())
    assert got == [(("4710199010372",), 2), (("4710199010372", "4909978112950"), 2), (("4909978112950",), 2)]


def test_five_item_set_sorted_and_stops(spark):
    rows = [(f"b{i}", it) for i in range(4) for it in "edcba"]
    lv = mine_levels(pairs_df(spark, rows), 4)
    assert lv.sizes == [5, 10, 10, 5, 1]
    top = [r for r in lv.itemsets().collect() if r["k"] == 5]
    assert [list(r["itemset"]) for r in top] == [["a", "b", "c", "d", "e"]]


def test_support_above_basket_count(spark):
    pairs = pairs_df(spark, [("a", "x"), ("b", "x")])
    for strategy in ("levels", "son", "fpgrowth"):
        assert frequent_itemsets(pairs, 3, strategy=strategy).count() == 0


def test_header_only_and_header_twice(spark, tmp_path):
    empty = write_text(tmp_path, "empty.csv", "user_id,business_id\n")
    assert read_pairs(spark, empty).count() == 0
    assert frequent_itemsets(read_pairs(spark, empty), 1).count() == 0
    twice = write_text(tmp_path, "twice.csv", "user_id,business_id\n1,100\nuser_id,business_id\n2,100")
    rows = read_pairs(spark, twice).collect()
    assert sorted((r["basket"], r["item"]) for r in rows) == [("1", "100"), ("2", "100")]


def test_empty_field_is_an_item(spark, tmp_path):
    path = write_text(tmp_path, "blank.csv", "u,b\n1,\n2,")
    rows = frequent_itemsets(read_pairs(spark, path), 2).collect()
    assert [(tuple(r["itemset"]), r["support"]) for r in rows] == [(("",), 2)]


def test_support_zero_rejected(spark):
    pairs = pairs_df(spark, [("a", "x")])
    with pytest.raises(ValueError):
        frequent_itemsets(pairs, 0)
    with pytest.raises(ValueError):
        read_pairs(spark, "unused", case=3)


def test_composite_basket_columns(spark):
    from basketry import mine

    df = spark.createDataFrame([("d1", 1, "x"), ("d1", 1, "y"), ("d1", 2, "x"), ("d2", 1, "x")],
                               "day string, cust int, item string")
    rows = mine(df, ["day", "cust"], "item", 2).collect()
    assert [(tuple(r["itemset"]), r["support"]) for r in rows] == [(("x",), 3)]


def test_candidate_count_matches_brute_force(spark):
    # Pass 2 counts a downward-closed candidate list level by level; compare
    # every count with a brute-force subset count over the baskets.
    from itertools import combinations

    from basketry import count_candidates

    baskets = {f"b{i}": sorted({f"i{(i * j) % 9}" for j in range(1, 5)}) for i in range(40)}
    pairs = pairs_df(spark, [(b, it) for b, items in baskets.items() for it in items])
    cands = son_candidates(pairs, 6, 3)
    listed = {tuple(r["itemset"]) for r in cands.collect()}
    got = {tuple(r["itemset"]): r["support"] for r in count_candidates(pairs, cands).collect()}
    want = {}
    for items in baskets.values():
        for k in range(1, len(items) + 1):
            for c in combinations(items, k):
                if c in listed:
                    want[c] = want.get(c, 0) + 1
    assert got == want and len(got) > 5
    frequent = {tuple(r["itemset"]): r["support"] for r in count_candidates(pairs, cands, 6).collect()}
    assert frequent == {c: n for c, n in want.items() if n >= 6}


def test_prepared_pairs_keep_row_counts(spark):
    # Pre-aggregated pairs carry the raw row count, so the size filter and
    # the repeat-counting first pass see the same numbers as on raw rows.
    raw = pairs_df(spark, [("a", "x"), ("a", "x"), ("a", "y"), ("b", "x"), ("b", "y"), ("c", "x")])
    prep = prepared_pairs(raw, 2)
    assert sorted((r["basket"], r["item"], r["n_rows"]) for r in prep.collect()) == [("a", "x", 2), ("a", "y", 1)]
    assert {r["basket"] for r in prepared_pairs(prepared_pairs(raw), 2).collect()} == {"a"}
    want = {tuple(r["itemset"]) for r in son_candidates(raw, 2, 1, count_repeats=True).collect()}
    got = {tuple(r["itemset"]) for r in son_candidates(prepared_pairs(raw), 2, 1, count_repeats=True).collect()}
    assert got == want


def sets_of(df):
    return sorted((tuple(r["itemset"]), r["support"]) for r in df.collect())


def brute(rows):
    """Support of every set that some basket holds; null items are empty, null baskets one basket."""
    from itertools import combinations

    baskets = {}
    for b, i in rows:
        baskets.setdefault(b or "", set()).add(i or "")
    out = {}
    for items in baskets.values():
        for k in range(1, len(items) + 1):
            for c in combinations(sorted(items), k):
                out[c] = out.get(c, 0) + 1
    return out


@pytest.mark.parametrize("strategy", ["levels", "son", "fpgrowth"])
def test_null_baskets_and_items_in_every_strategy(spark, strategy):
    rows = [(None, "x"), (None, "y"), ("a", "x"), ("a", "y"), ("a", None), ("b", "x"), ("b", None), ("b", "x")]
    want = {c: n for c, n in brute(rows).items() if n >= 2}
    got = frequent_itemsets(pairs_df(spark, rows), 2, strategy=strategy)
    assert dict(sets_of(got)) == want
    by_rows = frequent_itemsets(pairs_df(spark, rows), 2, strategy=strategy, min_rows=1)
    assert dict(sets_of(by_rows)) == want
    ints = spark.createDataFrame([({None: None, "a": 1, "b": 2}[b], i) for b, i in rows], "basket int, item string")
    assert dict(sets_of(frequent_itemsets(ints, 2, strategy=strategy))) == want


def test_strategies_share_one_schema(spark):
    pairs = pairs_df(spark, [("a", "x"), ("a", "y"), ("b", "x"), ("b", "y")])
    schemas = {s: frequent_itemsets(pairs, 2, strategy=s).schema for s in ("levels", "son", "fpgrowth")}
    assert schemas["levels"] == schemas["son"] == schemas["fpgrowth"]
    assert frequent_itemsets(pairs, 9).schema == schemas["levels"]


def test_composite_key_keeps_null_fields_apart(spark):
    from basketry import make_pairs

    df = spark.createDataFrame([(None, "c1", "x"), ("c1", None, "x"), ("c1", "", "x")], "d string, c string, item string")
    assert sorted(r["basket"] for r in make_pairs(df, ["d", "c"], "item").collect()) == ["-c1", "c1-", "c1-"]


def test_ids_of_any_width(spark):
    from pyspark.sql import functions as F

    from basketry.functions import normalise_item_id

    wide = "123456789012345678901234567890"
    df = spark.createDataFrame([("00" + wide,), ("-007",), ("+05",), ("-0",), ("000",), (" 12 ",), (None,)], "v string")
    got = [r[0] for r in df.select(normalise_item_id(F.col("v"))).collect()]
    assert got == [wide, "-7", "5", "0", "0", "12", None]


@pytest.mark.parametrize("listed", [
    [["x", "y"]], [["y", "x"]], [["y", "x", "x"], ["x", "y"]], [["z"], ["x", "z", "y"], ["x", "w"]], [["q"], ["q", "x"]], [[]],
    [[None, "x"], ["z", "y"]],
])
def test_count_any_list(spark, listed):
    from basketry import count_candidates

    rows = [(b, i) for b, items in (("a", "xy"), ("b", "xyz"), ("c", "xyzw"), ("d", "w")) for i in items] + [("d", None), ("d", "x")]
    every = brute(rows)
    want = {c: every[c] for c in {tuple(sorted({i or "" for i in s})) for s in listed} if c in every}
    df = spark.createDataFrame([(s,) for s in listed], "itemset array<string>")
    assert dict(sets_of(count_candidates(pairs_df(spark, rows), df))) == want
    assert dict(sets_of(count_candidates(pairs_df(spark, rows), df, 2))) == {c: n for c, n in want.items() if n >= 2}


def test_header_of_a_folder_is_the_first_files(spark, tmp_path):
    folder = tmp_path / "parts"
    folder.mkdir()
    (folder / "part-00000").write_text("\nuser_id,business_id\n1,100\n")
    rows = ["2,100"] * 2 + [f"{i},{i % 7}" for i in range(3, 60)]
    (folder / "part-00001").write_text("\n".join(rows) + "\nuser_id,business_id\n")
    got = sorted((r["basket"], r["item"]) for r in read_pairs(spark, str(folder)).collect())
    assert got == sorted([("1", "100")] + [tuple(r.split(",")) for r in rows])
    (folder / "part-00000").write_text("")
    (folder / "part-00002").write_text("9,9\n")
    assert read_pairs(spark, str(folder)).count() == len(rows)  # the header is now 2,100, the first line there is
