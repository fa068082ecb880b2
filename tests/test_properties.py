"""Random baskets: every strategy equals a brute-force subset count, supports
are anti-monotone, and the two-pass candidates contain every frequent set for
several chunk counts."""

from itertools import combinations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from basketry import frequent_itemsets, son_candidates

baskets_st = st.lists(
    st.lists(st.sampled_from(["a", "b", "c", "d", "e", "f", "g"]), min_size=1, max_size=6),
    min_size=1, max_size=25)


def brute_force(baskets, support):
    counts = {}
    for items in baskets:
        items = sorted(set(items))
        for k in range(1, len(items) + 1):
            for c in combinations(items, k):
                counts[c] = counts.get(c, 0) + 1
    return {c: n for c, n in counts.items() if n >= support}


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(baskets=baskets_st, support=st.integers(min_value=1, max_value=5), p=st.integers(min_value=1, max_value=4))
def test_strategies_equal_brute_force(spark, baskets, support, p):
    rows = [(i, it) for i, items in enumerate(baskets) for it in items]
    pairs = spark.createDataFrame(rows, "basket long, item string")
    want = brute_force(baskets, support)
    for strategy in ("levels", "son", "fpgrowth"):
        got = frequent_itemsets(pairs, support, strategy=strategy, n_chunks=p).collect()
        assert {tuple(r["itemset"]): r["support"] for r in got} == want, strategy
    # Anti-monotone: every (k-1)-subset of a frequent set is frequent with at least its support.
    for c, n in want.items():
        for sub in combinations(c, len(c) - 1):
            if sub:
                assert want[sub] >= n
    cands = {tuple(r["itemset"]) for r in son_candidates(pairs, support, p).collect()}
    assert set(want) <= cands
