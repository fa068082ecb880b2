"""Hashed pair counts, the candidate filter, and runs that go on after a failure."""

import glob
import os
import random

import pytest
from pyspark.sql import functions as F

from basketry import Tuning, count_candidates, frequent_itemsets, mine_levels, mine_son
from basketry.operators import levels as L
from basketry.operators.baskets import normalised_pairs
from basketry.operators.bitfilter import SEGMENT_WORDS, KeySet, PairCounts, words_for


def pairs_of(spark, rows):
    return spark.createDataFrame(rows, "basket string, item string")


def skewed(seed=3, baskets=300, items=400):
    """Few frequent pairs among many items that are frequent alone."""
    rng = random.Random(seed)
    rows = {(f"b{b}", f"i{rng.randrange(items):03d}") for b in range(baskets) for _ in range(12)}
    rows |= {(f"b{b}", f"i{j:03d}") for b in range(0, baskets, 3) for j in range(4)}
    return sorted(rows)


def found(df):
    return sorted((tuple(r["itemset"]), r["support"]) for r in df.collect())


@pytest.fixture
def sizes(monkeypatch):
    """Rows of each extension before and after the filters, and whether pairs were counted by hash."""
    seen = []
    extend = L._Loop.extend

    def record(self, cand, n_cand, counted=None):
        before = sum(p.count() for p in self.joined())
        out = extend(self, cand, n_cand, counted)
        seen.append((cand is None, before, out.count(), counted is not None))
        return out

    monkeypatch.setattr(L._Loop, "extend", record)
    return seen


# ---------------------------------------------------------------- filters
@pytest.mark.parametrize("bits", [1, 40_000, 200_000])
def test_key_set_loses_no_key(spark, bits):
    keys = spark.range(3000).select(F.col("id").alias("set"), (F.col("id") * 7 % 1001).alias("item"))
    n_words = words_for(bits, 1 << 20)
    asked = spark.range(20_000).select(F.col("id").alias("set"), (F.col("id") * 7 % 1001).alias("item"))
    kept = KeySet.of(keys, ("set", "item"), n_words).ask(asked)
    assert kept.columns == ["set", "item"]
    ids = {r["set"] for r in kept.collect()}
    assert set(range(3000)) <= ids
    assert bits < 100_000 or len(ids) < 3000 + 0.1 * 17_000


def test_pair_counts_keep_every_frequent_pair(spark):
    rows = spark.range(5000).select((F.col("id") % 50).alias("set"), F.when(F.col("id") < 1000, F.col("id") % 50)
                                    .otherwise(F.col("id")).alias("item"))
    counted = PairCounts.of(rows, ("set", "item"), 8 * SEGMENT_WORDS, F.col("n") >= 15)
    kept = counted.ask(rows).groupBy("set", "item").count()
    assert kept.where("count >= 15").count() == 50
    assert counted.frequent >= 40 and counted.ask(rows).count() < 2000
    counted.release()


def test_filter_size_keeps_to_the_budget():
    assert words_for(10 ** 9, 64 << 20) * 8 <= 64 << 20
    assert words_for(100, 500) == 0 and words_for(100, 4096) == SEGMENT_WORDS
    assert words_for(1 << 20, 1 << 30) * 64 == 1 << 20


# ---------------------------------------------------------------- level 2
@pytest.mark.parametrize("strategy", ["levels", "son"])
def test_counted_pairs_shrink_level_two(spark, sizes, strategy):
    pairs = pairs_of(spark, skewed())
    kw = {"strategy": strategy, "n_chunks": 3}
    want = found(frequent_itemsets(pairs, 9, tuning=Tuning(pair_buckets=0), **kw))
    plain = [s for s in sizes if s[0]]
    del sizes[:]
    assert found(frequent_itemsets(pairs, 9, **kw)) == want and any(len(s) == 4 for s, _ in want)
    counted = [s for s in sizes if s[0]]
    assert not plain[0][3] and counted[0][3]
    assert plain[0][2] == plain[0][1] == counted[0][1] and counted[0][2] < plain[0][2] / 2


def test_without_frequent_pairs_next_to_nothing_is_made(spark, sizes):
    rng = random.Random(1)
    rows = sorted({(f"b{b}", f"i{rng.randrange(500)}") for b in range(800) for _ in range(8)})
    got = found(mine_levels(pairs_of(spark, rows), 9).itemsets())
    assert got and all(len(s) == 1 for s, _ in got)
    assert not sizes or sizes[0][1] > 10_000 and sizes[0][2] < 20  # only what shares a bucket by chance is made


def test_counted_pairs_of_a_hot_basket(spark):
    rows = skewed() + [("hot", f"i{j:03d}") for j in range(400)]
    pairs = pairs_of(spark, rows)
    want = found(frequent_itemsets(pairs, 9, tuning=Tuning(pair_buckets=0)))
    assert found(frequent_itemsets(pairs, 9, tuning=Tuning(hot_basket_items=50))) == want


# ---------------------------------------------------------------- candidates
def test_candidate_filter_before_the_shuffle(spark, sizes):
    """With candidates beyond the broadcast budget fewer rows reach their shuffle, with equal results."""
    rng = random.Random(2)
    rows = sorted({(f"b{b}", f"i{int(rng.random() ** 2 * 30):02d}") for b in range(250) for _ in range(9)})
    pairs = pairs_of(spark, rows)
    plain = found(frequent_itemsets(pairs, 12))
    seen = []
    ask = KeySet.ask

    def record(self, df):
        out = ask(self, df)
        seen.append((df.count(), out.count()))
        return out

    KeySet.ask = record
    try:
        small = Tuning(broadcast_bytes=5000)
        assert found(frequent_itemsets(pairs, 12, tuning=small)) == plain
        assert seen and all(after < before for before, after in seen)
        told = len(seen)
        assert found(frequent_itemsets(pairs, 12, tuning=Tuning(broadcast_bytes=5000, candidate_bits=0))) == plain
        assert len(seen) == told
    finally:
        KeySet.ask = ask
    cands, freq = mine_son(pairs, 12, 3, tuning=small)
    assert found(freq) == plain
    assert found(count_candidates(pairs, cands, 12, tuning=small)) == plain


# ---------------------------------------------------------------- resume
def files(folder):
    return {os.path.relpath(f, folder) for f in glob.glob(f"{folder}/*")}


@pytest.mark.parametrize("hot, grouped", [(4096, False), (6, True)])
def test_a_failed_run_goes_on(spark, tmp_path, monkeypatch, hot, grouped):
    rows = [(f"b{i}", f"i{(i * j) % 9}") for i in range(120) for j in range(7)]
    pairs = pairs_of(spark, rows)
    kw = {"tuning": Tuning(hot_basket_items=hot)}
    if grouped:
        pairs = pairs.withColumn("chunk", F.pmod(F.xxhash64("basket"), F.lit(2)).cast("int"))
        kw |= {"group": ["chunk"], "scale": 2}
    want = sorted(map(repr, mine_levels(pairs, 8, **kw).itemsets().collect()))
    folder = str(tmp_path / "run")
    extend = L._Loop.extend
    steps = []

    def fail(self, cand, n_cand, counted=None):
        steps.append(len(steps) + 2)
        if steps[-1] == 4:
            raise RuntimeError("lost")
        return extend(self, cand, n_cand, counted)

    monkeypatch.setattr(L._Loop, "extend", fail)
    with pytest.raises(RuntimeError, match="lost"):
        mine_levels(pairs, 8, resume=folder, **kw)
    assert {"items", "pairs", "level-1", "level-2", "level-3", "notes", "level-3-occ"} <= files(folder)
    assert "level-2-occ" not in files(folder)
    made = []
    monkeypatch.setattr(L._Loop, "extend", lambda self, *a: (made.append(a[1]), extend(self, *a))[1])
    encode = L.encode
    monkeypatch.setattr(L, "encode", lambda *a, **k: 1 / 0)  # the pairs are read, not made
    out = mine_levels(pairs, 8, resume=folder, **kw)
    assert sorted(map(repr, out.itemsets().collect())) == want
    assert len(out.sizes) >= 4 and len(made) == len(out.sizes) - 3 + (out.sizes[-1] >= 2 and len(made) > len(out.sizes) - 3)
    assert not os.path.exists(folder)  # a finished run leaves its result only
    monkeypatch.setattr(L, "encode", encode)


def test_resume_refuses_another_run(spark, tmp_path, monkeypatch):
    rows = [(f"b{i}", f"i{(i * j) % 9}") for i in range(60) for j in range(6)]
    folder = str(tmp_path / "run")
    monkeypatch.setattr(L._Loop, "extend", lambda *a, **k: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        mine_levels(pairs_of(spark, rows), 5, resume=folder)
    with pytest.raises(ValueError, match="another run"):
        mine_levels(pairs_of(spark, rows), 6, resume=folder)
    with pytest.raises(ValueError):
        frequent_itemsets(pairs_of(spark, rows), 5, strategy="son", resume=folder)


def test_resume_from_the_start_and_of_nothing(spark, tmp_path):
    rows = [(f"b{i}", f"i{(i * j) % 9}") for i in range(60) for j in range(6)]
    pairs = pairs_of(spark, rows)
    assert found(frequent_itemsets(pairs, 5, resume=str(tmp_path / "a"))) == found(frequent_itemsets(pairs, 5))
    assert found(frequent_itemsets(pairs, 5000, resume=str(tmp_path / "b"))) == []
    assert not os.path.exists(str(tmp_path / "a")) and not os.path.exists(str(tmp_path / "b"))


def test_tables_lie_in_the_named_database(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS scratch_levels")
    names = []
    table = L.bucketed

    def record(df, *a, **k):
        out = table(df, *a, **k)
        names.append(out._basketry_table[0])
        return out

    rows = [(f"b{i}", f"i{(i * j) % 9}") for i in range(60) for j in range(6)]
    L.bucketed = record
    try:
        mine_levels(pairs_of(spark, rows), 5, tuning=Tuning(database="scratch_levels"))
    finally:
        L.bucketed = table
    assert names and all(n.startswith("scratch_levels.") for n in names)
    assert spark.sql("SHOW TABLES IN scratch_levels").count() == 0
    spark.sql("DROP DATABASE scratch_levels")


# ---------------------------------------------------------------- crowded level 2
@pytest.mark.parametrize("strategy, hot, heavy", [("levels", 4096, 4_000_000), ("son", 50, 160)])
def test_more_pairs_than_buckets_are_counted_by_set(spark, sizes, strategy, hot, heavy):
    """Where the buckets would be full, level 2 makes no row for each pair, with equal results."""
    pairs = pairs_of(spark, skewed(items=200) + [("hot", f"i{j:03d}") for j in range(150)])
    few = Tuning(pair_buckets=64 * SEGMENT_WORDS, hot_basket_items=hot, rows_per_partition=heavy, partitions=4)
    got = found(frequent_itemsets(pairs, 9, strategy=strategy, n_chunks=3, tuning=few))
    assert sizes and not any(s[0] for s in sizes)
    assert got == found(frequent_itemsets(pairs, 9, strategy="fpgrowth")) and any(len(s) == 4 for s, _ in got)


def test_crowded_pairs_have_the_counts_of_the_plain_join(spark):
    enc = L.encode(normalised_pairs(pairs_of(spark, skewed(items=200))), 9)
    occ = enc.pairs.select("basket", F.col("sid").alias("set"), F.col("item").alias("last"))
    for heavy in (4_000_000, 160):  # without and with sets that are counted map-side first
        loop = L._Loop(enc, occ, None, local=True, tuning=Tuning(
            pair_buckets=64 * SEGMENT_WORDS, rows_per_partition=heavy, partitions=4))
        assert loop.crowded(9, 1) and loop.count_pairs(9, 1) is None
        assert sorted(loop.count_crowded().collect()) == sorted(loop.tally(loop.joined()[0], "set", "item").collect())
    enc.release()


# ---------------------------------------------------------------- equal baskets
def equal_baskets():
    rng = random.Random(5)
    kinds = [sorted(rng.sample(range(8), rng.randrange(2, 7))) for _ in range(12)]
    rows = [(f"b{b}", f"i{j}") for b in range(140) for j in kinds[b * b % 12]]
    return rows + [("b999", f"i{j}") for j in range(8)] + rows[:9]


def test_equal_baskets_are_one(spark):
    pairs = normalised_pairs(pairs_of(spark, equal_baskets()))
    enc = L.encode(pairs, 5, tuning=Tuning(merge_from=1))
    kinds = {}
    for b, i in set(equal_baskets()):
        kinds.setdefault(b, set()).add(i)
    kept = {b: n for b, n in enc.pairs.select("basket", "n").distinct().collect()}
    assert len(kept) == len({frozenset(x) for x in kinds.values()}) < len(kinds) / 2 and sum(kept.values()) == len(kinds)
    assert dict(enc.pairs.dtypes) == {"basket": "string", "item": "bigint", "sid": "bigint", "n": "bigint"}
    enc.release()


def test_merged_baskets_keep_the_results(spark):
    """Both passes over merged baskets, some joined in blocks."""
    pairs = pairs_of(spark, equal_baskets())
    merged = Tuning(merge_from=1, hot_basket_items=7)
    cands, got = mine_son(pairs, 20, 3, tuning=merged)
    want = found(frequent_itemsets(pairs, 20, strategy="fpgrowth"))
    assert len(want) > 20 and found(got) == want
    assert sorted(map(repr, cands.collect())) == sorted(map(repr, mine_son(pairs, 20, 3)[0].collect()))


def test_listed_sets_over_merged_baskets(spark):
    rows = equal_baskets()
    listed = [["i0"], ["i1", "i2"], ["i7", "i3", "i5"], ["i0", "none"], ["i4", "i6"]]
    got = found(count_candidates(pairs_of(spark, rows), spark.createDataFrame([(x,) for x in listed], "itemset array<string>"),
                                 tuning=Tuning(merge_from=1)))
    baskets = {}
    for b, i in rows:
        baskets.setdefault(b, set()).add(i)
    n = {tuple(sorted(x)): sum(set(x) <= b for b in baskets.values()) for x in listed}
    assert got == sorted((x, c) for x, c in n.items() if c) and len(got) > 2


def test_a_failed_run_over_merged_baskets_goes_on(spark, tmp_path, monkeypatch):
    pairs, kw = pairs_of(spark, equal_baskets()), {"tuning": Tuning(merge_from=1)}
    want = found(mine_levels(pairs, 20, **kw).itemsets())
    extend, folder = L._Loop.extend, str(tmp_path / "run")
    monkeypatch.setattr(L._Loop, "extend", lambda self, cand, *a: extend(self, cand, *a) if cand is None else 1 / 0)
    with pytest.raises(ZeroDivisionError):
        mine_levels(pairs, 20, resume=folder, **kw)
    monkeypatch.setattr(L._Loop, "extend", extend)
    assert found(mine_levels(pairs, 20, resume=folder, **kw).itemsets()) == want


@pytest.mark.parametrize("n_items", [9, 64, 130])
def test_few_items_are_merged_before_pairs_are_written(spark, monkeypatch, n_items):
    """Bits of one, one full and three words: only the different baskets are written as pairs, one group at a time."""
    seen, bucketed = [], L.bucketed
    monkeypatch.setattr(L, "bucketed", lambda df, *a: (seen.append(bucketed(df, *a)), seen[-1])[1])
    kinds = [[0, n_items - 1], [n_items // 2, n_items - 1, 1], list(range(n_items)), [0]]
    rows = [(b, f"i{i:03}") for b in range(80) for i in kinds[b // 2 % 4]] + [(200 + b, "i000") for b in range(5)]
    pairs = normalised_pairs(spark.createDataFrame(rows, "basket bigint, item string")).withColumn("chunk", (F.col("basket") % 2).cast("int"))
    enc = L.encode(pairs, 20, ["chunk"], 2, tuning=Tuning(merge_from=1))
    assert len(seen) == 1 and dict(enc.pairs.dtypes) == {"basket": "bigint", "item": "bigint", "sid": "bigint", "n": "bigint"}
    got = sorted((n, w) for _, n, w in enc.pairs.groupBy("basket", "n").agg(F.countDistinct("item")).collect())
    assert got == sorted((n, len(x)) for x in kinds for n in ([13, 12] if x == [0] else [10, 10]))
    assert enc.n_ext == sum(len(kinds[b // 2 % 4]) * (len(kinds[b // 2 % 4]) - 1) // 2 for b in range(80))
    enc.release()


def test_few_items_give_the_same_sets_and_counts(spark):
    """Items that are frequent in one chunk only, baskets of one chunk or none, text keys and a null one."""
    rows = [(f"b{b}", f"i{i:02}") for b in range(120) for i in {b % 70, b * b % 70, b % 3, b % 2 + 66}] + [(None, "i01"), ("b0", None)]
    pairs = pairs_of(spark, rows)
    plain, merged = (mine_son(pairs, 4, 3, tuning=Tuning(merge_from=m)) for m in (0, 1))
    assert sorted(map(repr, merged[0].collect())) == sorted(map(repr, plain[0].collect()))
    assert found(merged[1]) == found(plain[1]) != []
