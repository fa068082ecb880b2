"""Operators on document texts against brute force, on edge cases and the small tables."""

import random

import numpy as np
import pytest
from helpers import (DOC_SCHEMA, SF, components, contamination, doc_rows, documents, edge_rows, repeats, rows_of,
                     simhash)
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from basketry.llm import decontaminate, exact_dedup, simhash_dedup, suffix_dedup
from basketry.llm.common import table
from basketry.llm.components import component_roots

LONG = " ".join(random.Random(1).choice("alpha beta gamma delta epsilon zeta eta theta iota kappa".split())
                for _ in range(30_000))


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefgh") for _ in range(r.randint(1, 6))) for _ in range(n))


# ---------------------------------------------------------------- exact dedup
def exact(rows):
    import hashlib
    sha = lambda t: hashlib.sha256((t or "").encode()).hexdigest()
    groups = {}
    for r in rows:
        groups.setdefault(sha(r[1]), []).append(r[0])
    out = []
    for r in rows:
        ids = groups[sha(r[1])]
        keep = max((i for i in ids if i is not None), default=None)
        out.append((r[0], keep, len(ids), r[0] == keep, sha(r[1])))
    return sorted(out, key=repr)


EXACT = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def test_exact_edges(spark):
    rows = edge_rows(LONG)
    assert rows_of(exact_dedup.exact_groups(documents(spark, rows)), *EXACT) == exact(rows)
    assert exact_dedup.exact_groups(documents(spark, [])).count() == 0


def test_exact_hot_group_is_broadcast_and_whole(spark):
    rows = doc_rows({i: "copy" if i % 3 == 0 else f"text {i // 2}" for i in range(900)})
    assert rows_of(exact_dedup.exact_groups(documents(spark, rows), top=4, tracked=64), *EXACT) == exact(rows)
    kept = exact_dedup.exact_dedup(documents(spark, rows))
    assert kept.columns == documents(spark, rows).columns
    assert sorted(r.doc_id for r in kept.select("doc_id").collect()) == sorted({x[1] for x in exact(rows)})


# ---------------------------------------------------------------- decontamination
HIT = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def test_contamination_edges(spark):
    rows = edge_rows(LONG)
    items = [(1, "quick brown fox jumps over the LAZY dog and then runs back home"), (2, "lazy dog"), (3, None),
             (4, "..."), (5, "naïve"), (6, "lazy dog"), (7, "alpha beta gamma"), (None, "quick brown"),
             (8, "jumps over the lazy dog and then runs back home again")]
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("words", F.lit(1))
    got = decontaminate.contamination(documents(spark, rows), bench)
    assert rows_of(got, *HIT) == contamination([r[:2] for r in rows], items)
    clean = decontaminate.decontaminate(documents(spark, rows), bench)
    bad = {r[0] for r in contamination([r[:2] for r in rows], items) if r[5]}
    assert clean.columns == documents(spark, rows).columns
    assert {r.doc_id for r in clean.select("doc_id").collect()} == {r[0] for r in rows if r[0] not in bad} | {4}


def test_contamination_empty_sides(spark):
    rows = edge_rows("x")
    none = spark.createDataFrame([], "item_id long, text string")
    got = decontaminate.contamination(documents(spark, rows), none)
    assert rows_of(got, *HIT) == contamination([r[:2] for r in rows], [])
    assert decontaminate.contamination(documents(spark, []), none).count() == 0


def test_contamination_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "fits", lambda *a, **k: False)
    rows = edge_rows(LONG)
    items = [(1, "quick brown fox jumps over the lazy dog and then runs"), (2, "lazy dog")]
    got = decontaminate.contamination(documents(spark, rows), spark.createDataFrame(items, "item_id long, text string"))
    assert rows_of(got, *HIT) == contamination([r[:2] for r in rows], items)


def test_contamination_small_table(spark):
    docs, bench = table(spark, SF, "documents"), table(spark, SF, "benchmark")
    want = contamination([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in bench.collect()])
    assert rows_of(decontaminate.contamination(docs, bench), *HIT) == want
    assert any(r[5] for r in want)


# ---------------------------------------------------------------- suffix dedup
def suffix_rows(df):
    out = suffix_dedup.remove_repeats(df)
    return rows_of(out.select("doc_id", "n_bytes", (F.col("n_bytes") - F.length("kept")).alias("gone"),
                              F.size("spans").alias("spans"), F.sha2("kept", 256).alias("sha")),
                   "doc_id", "n_bytes", "gone", "spans", "sha")


def test_suffix_edges(spark):
    rows = edge_rows(LONG[:3000])
    assert suffix_rows(documents(spark, rows)) == repeats([r[:2] for r in rows])
    assert suffix_rows(documents(spark, [])) == []


@pytest.mark.parametrize("bucket", [40, 400, 100_000])
def test_suffix_passages(spark, monkeypatch, bucket):
    """Shared passages with other surroundings, copies, near copies, multi-byte text, across bucket borders."""
    monkeypatch.setattr(suffix_dedup, "BUCKET_ROWS", bucket)
    passage, line = prose(1, 30), "Nothing in this line is worth keeping at all, ever."
    texts = {}
    for i in range(60):
        own = prose(100 + i, 20)
        texts[i * 7 % 61] = [own + passage + own[::-1], own, passage[i % 20:] + own, line + "\n" + own,
                             own[:30] + "é" * 60, texts.get(0, own)][i % 6]
    rows = doc_rows(texts)
    assert suffix_rows(documents(spark, rows)) == repeats([r[:2] for r in rows])


def test_suffix_copies_in_other_chunks(spark):
    """The first of two copies shares a passage only with texts beside the later copy, in another chunk."""
    first, later = [], []
    for i in range(12):
        passage = prose(500 + i, 40)
        text, sharer = prose(600 + i, 15) + passage, passage + prose(700 + i, 15)
        first.append((i, text, "en", "a", 1))
        later += [(100 + i, text, "en", "a", 1), (200 + i, sharer, "en", "a", 1)]
    rows = first + [(300 + i, prose(800 + i, 5), "en", "a", 1) for i in range(12)] + later
    docs = spark.createDataFrame(spark.sparkContext.parallelize(rows, 2), DOC_SCHEMA)
    assert suffix_rows(docs) == repeats([r[:2] for r in rows])


def test_grams_of_several_buckets_have_their_own():
    s = suffix_dedup.Splitters(sorted([b"b"] * 50 + [b"a", b"c", b"d", b"e"] * 5), 7)
    assert set(s.shared) == {b"b"} and s.count == s.plain + s.shared[b"b"][1]
    assert {s.bucket(b"b", i) for i in range(50)} == set(range(s.plain, s.count))
    assert s.bucket(b"a", 1) == 0 and s.bucket(b"f", 1) == s.plain - 1
    assert all(s.bucket(x, 0) < s.plain for x in (b"a", b"c", b"zz"))


@settings(max_examples=40, deadline=None)
@given(st.lists(st.binary(min_size=0, max_size=90).map(lambda b: bytes(97 + c % 2 for c in b)), min_size=1, max_size=60))
def test_multikey_quicksort_sorts(strings):
    m, _ = suffix_dedup._matrix(strings, 90)
    order = suffix_dedup.multikey_quicksort(m, small=4)
    assert [bytes(m[i]) for i in order] == sorted(bytes(x) for x in m)


@settings(max_examples=25, deadline=None)
@given(st.integers(0, 10 ** 6), st.integers(50, 400))
def test_every_string_has_its_anchor(seed, n):
    data = np.frombuffer(prose(seed, n).encode(), np.uint8)
    at, h = suffix_dedup.anchors(data)
    places = set(at.tolist())
    span = suffix_dedup.LENGTH - suffix_dedup.GRAM + 1
    for p in range(len(data) - suffix_dedup.LENGTH + 1):
        assert places & set(range(p, p + span))
    # The choice depends on the string alone: a shifted copy has the same anchors.
    moved, _ = suffix_dedup.anchors(np.concatenate([np.frombuffer(prose(seed + 1, 15).encode(), np.uint8), data]))
    shift = len(prose(seed + 1, 15).encode())
    inner = {p for p in places if span <= p < len(data) - suffix_dedup.LENGTH}
    assert inner <= {int(p) - shift for p in moved}


# ---------------------------------------------------------------- SimHash
SIM = ("doc_id", "fingerprint", "component_id")


def test_simhash_edges(spark):
    rows = edge_rows(LONG)
    assert rows_of(simhash_dedup.simhash_components(documents(spark, rows)), *SIM) == components([r[:2] for r in rows])
    assert simhash_dedup.simhash_components(documents(spark, [])).count() == 0


@pytest.mark.parametrize("split", [6, 2048])
def test_simhash_groups(spark, monkeypatch, split):
    monkeypatch.setattr(simhash_dedup, "SPLIT", split)
    base = prose(3, 200).split()
    texts = {}
    for i in range(150):
        w = list(base) if i % 3 else prose(i, 60).split()
        w[i % len(w)] = f"edit{i}"
        texts[i] = " ".join(w)
    rows = doc_rows(texts)
    want = components([r[:2] for r in rows])
    assert rows_of(simhash_dedup.simhash_components(documents(spark, rows)), *SIM) == want
    kept = simhash_dedup.simhash_dedup(documents(spark, rows))
    assert kept.columns == documents(spark, rows).columns
    assert {r.doc_id for r in kept.select("doc_id").collect()} == {x[2] for x in want}


def test_simhash_small_table(spark):
    docs = table(spark, SF, "documents")
    want = components([(r.doc_id, r.text) for r in docs.collect()])
    assert rows_of(simhash_dedup.simhash_components(docs), *SIM) == want


@settings(max_examples=30, deadline=None)
@given(st.lists(st.integers(0, 2 ** 64 - 1), min_size=1, max_size=12), st.integers(0, 10 ** 6))
def test_cluster_is_exact(seeds, seed):
    r = random.Random(seed)
    fps = sorted({s ^ sum(1 << b for b in r.sample(range(64), r.randint(0, 7))) for s in seeds for _ in range(6)})
    label = simhash_dedup.cluster(np.array(fps, np.uint64), simhash_dedup._references(16), 4)
    want = list(range(len(fps)))
    for a in range(len(fps)):
        for b in range(a):
            if (fps[a] ^ fps[b]).bit_count() <= 4 and want[a] != want[b]:
                x, y = max(want[a], want[b]), min(want[a], want[b])
                want = [y if w == x else w for w in want]
    first = {w: want.index(w) for w in set(want)}
    assert label.tolist() == [first[w] for w in want]


def test_fingerprint_matches_brute_force():
    for text in (None, "", "one", "One two\tTHREE", "É é a b c d", LONG[:5000], "a b c d " * 50):
        assert simhash_dedup.fingerprint(text) == simhash(text)


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5000, 5000)]
    roots = component_roots(spark.createDataFrame(edges, "a long, b long")).collect()
    by_root = {}
    for r in roots:
        by_root.setdefault(r.root, set()).add(r.node)
    assert sorted(map(sorted, by_root.values())) == [list(range(201)), list(range(1000, 1300))]


def test_schema_is_stable(spark):
    docs = spark.createDataFrame([], DOC_SCHEMA)
    assert simhash_dedup.simhash_components(docs).columns == list(SIM)
    assert exact_dedup.exact_groups(docs).columns == list(EXACT)
