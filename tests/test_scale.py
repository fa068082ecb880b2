"""Plans and data layout of the level loop, hot baskets, and what a run leaves behind."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from basketry import Tuning, frequent_itemsets, mine_levels, mine_son
from basketry.operators import levels as L
from basketry.operators.baskets import normalised_pairs


def sets_of(df):
    return sorted((tuple(r["itemset"]), r["support"]) for r in df.collect())


def hot_rows():
    """One basket holds a third of all rows."""
    rows = [("hot", f"i{j}") for j in range(30)]
    return rows + [(f"b{i}", f"i{j}") for i in range(30) for j in range(i % 5, i % 5 + 4)]


@pytest.fixture
def plans(monkeypatch):
    """Plans of the frames the loop writes in buckets, and of its persisted extensions."""
    seen = []
    bucketed, extend = L.bucketed, L._Loop.extend

    def record(df, *args):
        seen.append(("bucketed", df._jdf.queryExecution().executedPlan().toString()))
        return bucketed(df, *args)

    def each(self, *args):
        out = extend(self, *args)
        seen.extend(("ext", p._jdf.queryExecution().withCachedData().toString()) for p in self.ext)
        return out

    monkeypatch.setattr(L, "bucketed", record)
    monkeypatch.setattr(L._Loop, "extend", each)
    return seen


def test_hot_basket_in_blocks_same_result(spark):
    pairs = spark.createDataFrame(hot_rows(), "basket string, item string")
    plain = sets_of(frequent_itemsets(pairs, 3))
    assert len(plain) > 20 and sets_of(mine_levels(pairs, 3, tuning=Tuning(hot_basket_items=4)).itemsets()) == plain
    cands, found = mine_son(pairs, 3, 2, tuning=Tuning(hot_basket_items=4))
    assert sets_of(found) == plain


@pytest.mark.parametrize("width", [30, 60])
def test_block_pairs_are_bounded(spark, width):
    """Whatever the basket's width, a join key holds one pair of blocks, and rows are copied once per block."""
    block = 8
    items = spark.createDataFrame([("hot", i) for i in range(width)], "basket string, item long")
    occ = items.select("basket", F.col("item").alias("set"), F.col("item").alias("last"))
    sizes = spark.createDataFrame([("hot", width)], "basket string, w long")
    out = L._blocked(occ, items, sizes, Tuning(hot_basket_items=block))
    assert out.count() == width * (width - 1) // 2
    blocks = -(-width // block)
    per_key = out.groupBy("bi", "bo").count().agg(F.max("count"), F.count(F.lit(1))).first()
    assert per_key[0] <= (2.5 * block) ** 2 and per_key[1] <= blocks ** 2


def test_rows_are_fixed_width(spark):
    pairs = normalised_pairs(spark.createDataFrame(hot_rows(), "basket string, item string"))
    enc = L.encode(pairs, 3)
    assert dict(enc.pairs.dtypes) == {"basket": "string", "item": "bigint", "sid": "bigint"}
    enc.release()


def test_each_level_is_evaluated_once(spark, plans):
    rows = [(f"b{i}", f"i{(i * j) % 7}") for i in range(200) for j in range(5)]
    pairs = spark.createDataFrame(rows, "basket string, item string")
    lv = mine_levels(pairs, 5)
    assert len(lv.sizes) >= 3
    occurrences = [p for kind, p in plans if kind == "bucketed"][1:]
    assert len(occurrences) >= 2
    for p in occurrences:  # read from the persisted extension: no join of pairs, no aggregate, no shuffle
        head = p.split("InMemoryRelation")[0]
        assert "InMemoryTableScan" in head and "Aggregate" not in head and "SortMergeJoin" not in head and "Exchange hashpartitioning" not in head


def test_level_join_needs_no_exchange(spark, plans):
    prior = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = [(f"b{i}", f"i{(i * j) % 7}") for i in range(200) for j in range(5)]
        mine_levels(spark.createDataFrame(rows, "basket string, item string"), 5)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prior)
    joins = [p for kind, p in plans if kind == "ext"]
    assert joins and all("SortMergeJoin" in p and "Exchange hashpartitioning" not in p for p in joins)


@pytest.mark.parametrize("budget", [0, 64 << 20])
@pytest.mark.parametrize("strategy", ["levels", "son"])
def test_candidates_restrict_the_extension(spark, plans, budget, strategy):
    """Level 3 meets the pruned candidates before it is counted, broadcast or shuffled."""
    rows = [(f"b{i}", f"i{(i * j) % 9}") for i in range(120) for j in range(6)]
    pairs = spark.createDataFrame(rows, "basket string, item string")
    want = sets_of(frequent_itemsets(pairs, 6, strategy="fpgrowth"))
    assert sets_of(frequent_itemsets(pairs, 6, strategy=strategy, n_chunks=3, tuning=Tuning(broadcast_bytes=budget))) == want
    deeper = [p for kind, p in plans if kind == "ext"][1:]
    assert deeper and all(p.count("Join") >= 2 for p in deeper)


def test_prune_does_not_change_candidates_that_count(spark):
    rows = [(f"b{i}", f"i{(i * j) % 9}") for i in range(120) for j in range(6)]
    pairs = spark.createDataFrame(rows, "basket string, item string")
    two = L.frequent_pairs(pairs, 6)
    full = {tuple(r["ids"]) for r in L.generate_candidates(two, 3, prune=False).collect()}
    pruned = {tuple(r["ids"]) for r in L.generate_candidates(two, 3).collect()}
    three = {s for s, _ in sets_of(frequent_itemsets(pairs, 6)) if len(s) == 3}
    assert three <= pruned <= full


def test_wide_basket_is_an_error_in_fpgrowth(spark):
    pairs = spark.createDataFrame(hot_rows(), "basket string, item string")
    with pytest.raises(ValueError, match="too wide"):
        frequent_itemsets(pairs, 3, strategy="fpgrowth", tuning=Tuning(hot_basket_items=4))


def test_long_text_is_measured_before_a_broadcast(spark):
    """Two thousand bytes an item: the item table does not pass as a few bytes a row."""
    rows = [(f"b{i}", "x" * 2000 + str(j)) for i in range(5) for j in range(6)]
    enc = L.encode(normalised_pairs(spark.createDataFrame(rows, "basket string, item string")), 2)
    assert enc.item_bytes >= 6 * 2000
    enc.release()
    small = Tuning(broadcast_bytes=4000)
    pairs = spark.createDataFrame(rows, "basket string, item string")
    assert sets_of(mine_levels(pairs, 2, tuning=small).itemsets()) == sets_of(mine_levels(pairs, 2).itemsets())


def folders(spark):
    base = spark.sparkContext.getCheckpointDir().removeprefix("file:")
    return set(glob.glob(os.path.join(base, "*")))


@pytest.mark.parametrize("strategy", ["levels", "son"])
def test_a_run_leaves_only_its_result(spark, strategy):
    pairs = spark.createDataFrame(hot_rows(), "basket string, item string")
    before = folders(spark)
    out = frequent_itemsets(pairs, 3, strategy=strategy, min_rows=1)
    left = folders(spark) - before
    assert len(left) == 1 and out.count() > 20


@pytest.mark.parametrize("strategy", ["levels", "son"])
def test_a_failed_run_leaves_nothing(spark, monkeypatch, strategy):
    pairs = spark.createDataFrame(hot_rows(), "basket string, item string")
    monkeypatch.setattr(L._Loop, "follow", lambda *a, **k: 1 / 0)
    before = folders(spark)
    with pytest.raises(ZeroDivisionError):
        frequent_itemsets(pairs, 3, strategy=strategy, min_rows=1)
    assert not folders(spark) - before  # Spark may delete older ones meanwhile


def test_adaptive_execution_is_never_switched_off(spark, monkeypatch):
    changed = []
    put = type(spark.conf).set
    monkeypatch.setattr(type(spark.conf), "set", lambda self, k, v: (changed.append(k), put(self, k, v))[1])
    frequent_itemsets(spark.createDataFrame(hot_rows(), "basket string, item string"), 3)
    assert not [k for k in changed if k.startswith("spark.sql.adaptive")]


def test_missing_checkpoint_folder_is_an_error(spark, monkeypatch):
    from basketry import session

    class Unset:
        class sparkContext:  # noqa: N801
            getCheckpointDir = staticmethod(lambda: None)
            getConf = staticmethod(lambda: {})

        class conf:  # noqa: N801
            get = staticmethod(lambda k, d=None: d)

    with pytest.raises(RuntimeError):
        session.ensure_checkpoint_dir(Unset)
