"""Spelling variants, language-model scores and hard negatives, against brute force."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from helpers import SF, doc_rows, documents, edge_rows, rows_of
from pyspark.sql import functions as F

from basketry.llm import hard_negatives as H
from basketry.llm import ppm, queries, spelling
from basketry.llm.common import table

LONG = "word " * 40_000


# ---------------------------------------------------------------- spelling variants
def near(a: str, b: str) -> bool:
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def variants(docs, noise=97, least=5, often=3, ratio=2):
    n = Counter()
    for doc, text in docs:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for run in re.findall("[A-Za-zÀ-ÿ]+", low):
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if noise and h % noise == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    words = {w: c for w, c in n.items() if len(w) >= least and c >= often}
    # Two words are near only if they share what is left after one deletion each.
    by_rest = defaultdict(set)
    for w in words:
        for rest in {w, *(w[:i] + w[i + 1:] for i in range(len(w)))}:
            by_rest[rest].add(w)
    close = defaultdict(set)
    for group in by_rest.values():
        for a in group:
            close[a].update(b for b in group if near(a, b))
    form = {}
    for w in words:
        best = min(close[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= ratio * words[w] else None
    out = []
    for w, c in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, c, len(close[w]), words[form[w]] if form[w] else None))
    return sorted(out, key=repr)


COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


def test_spelling_equals_brute_force(spark):
    docs = table(spark, SF, "documents")
    want = variants([(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()])
    assert len(want) > 300 and any(r[1] for r in want)
    assert rows_of(spelling.spelling_variants(docs), *COLUMNS) == want


def test_spelling_edges(spark):
    word, one = "abcdefgh", "abcdefg"
    texts = {1: f"{word} " * 8 + f"{one} " * 4, 2: "abcdefgx " * 3 + "Übergröße ÜBERGRÖSSE übergröße " * 3, 3: None, 4: "",
             5: "x" * 30_000 + " " + "x" * 29_999 + " ", 6: ("x" * 30_000 + " ") * 3 + ("x" * 29_999 + " ") * 3,
             None: "aaaaa aaaa aaaaaa aaaaab " * 4, 7: LONG, 8: "ties1 tiesa tiesb tiesc " * 3 + "tiesa tiesb " * 3}
    rows = doc_rows(texts) + doc_rows({1: texts[1]})
    want = variants([(r[0], r[1]) for r in rows])
    assert rows_of(spelling.spelling_variants(documents(spark, rows)), *COLUMNS) == want
    assert spelling.spelling_variants(documents(spark, [])).count() == 0
    assert spelling.spelling_variants(documents(spark, doc_rows({1: None, 2: "ab ab ab"}))).count() == 0


def test_filters_lose_no_word_and_rounds_change_nothing(spark):
    rng = random.Random(5)
    words = sorted({"".join(rng.choice("abé") for _ in range(rng.randint(5, 8))) for _ in range(600)})
    vocabulary = spark.createDataFrame([(w, 3 + i % 50) for i, w in enumerate(words)], "word string, n long")
    hashes = spelling.word_hash(spelling.codes([w for w in words if len(w) == 6]))
    assert spelling.maybe_in(hashes, {0: spelling.bloom(hashes)}, 1).all()
    want = sorted((min(a, b), max(a, b)) for i, a in enumerate(words) for b in words[:i] if near(a, b))
    for budget in (spelling.ROUND_BYTES, 600):  # 600 bytes: a round for each length
        got = spelling.near_pairs(vocabulary, round_bytes=budget).collect()
        assert sorted((min(r["word"], r["other"]), max(r["word"], r["other"])) for r in got) == want


def test_segments_of_a_long_shard(spark, monkeypatch):
    """A length with more words than a segment holds is cut; every word is asked in its own segment."""
    monkeypatch.setattr(spelling, "SEGMENT_BYTES", 300)
    rng = random.Random(6)
    words = sorted({"".join(rng.choice("abcd") for _ in range(6)) for _ in range(900)})
    vocabulary = spark.createDataFrame([(w, 3) for w in words], "word string, n long")
    want = sorted((min(a, b), max(a, b)) for i, a in enumerate(words) for b in words[:i] if near(a, b))
    assert spelling.segments_of(len(words)) > 3
    got = spelling.near_pairs(vocabulary, round_bytes=700).collect()
    assert sorted((min(r["word"], r["other"]), max(r["word"], r["other"])) for r in got) == want


def test_deletion_hashes():
    words = ["abcde", "aabbc", "ééééé"]
    edits, first = spelling._deletions(spelling.codes(words), spelling.word_hash(spelling.codes(words)))
    for i, w in enumerate(words):
        for at in range(5):
            assert edits[i, at] == spelling.word_hash(spelling.codes([w[:at] + w[at + 1:]]))[0]
    assert first.sum(axis=1).tolist() == [5, 3, 1]


def test_long_chains_reach_their_root(spark):
    n = 40
    forms = spark.createDataFrame([(f"w{i}", f"w{i + 1}") for i in range(n)], "word string, form string")
    assert {r["root"] for r in spelling._roots(forms).collect()} == {f"w{n}"}


# ---------------------------------------------------------------- language-model scores
class Plain:
    """PPM by dictionaries, symbol by symbol."""

    def __init__(self, texts, order):
        self.order, self.count = order, defaultdict(Counter)
        for t in texts:
            line = b"\xff" * order + t + b"\xfe"
            for i in range(order, len(line)):
                for k in range(order + 1):
                    self.count[line[i - k:i]][line[i]] += 1

    def byte(self, context, symbol):
        p, gone = 1.0, set()
        for k in range(self.order, -1, -1):
            seen = self.count.get(context[len(context) - k:])
            if not seen:
                continue
            left = {s: c for s, c in seen.items() if s not in gone}
            total = sum(left.values())
            if symbol in left:
                return p * (left[symbol] - 0.5) / total
            if left:
                p *= 0.5 * len(left) / total
            gone |= set(seen)
        return p / (256 - len(gone))

    def score(self, text):
        line = b"\xff" * self.order + text + b"\xfe"
        return sum(math.log10(self.byte(line[i - self.order:i], line[i])) for i in range(self.order, len(line)))


def lm(docs, order):
    low = [(d, (t or "").encode().lower()) for d, t in docs]
    held = [zlib.crc32(b"" if d is None else str(d).encode()) % 10 == 0 for d, _ in low]
    model = Plain([t for (_, t), h in zip(low, held) if not h], order)
    tokens = [[*t.split(), None] for _, t in low]
    count = Counter(w for ws, h in zip(tokens, held) if not h for w in ws)
    total, distinct = sum(count.values()), len(count)
    return sorted(((d, h, len(ws), sum(count[w] > 0 for w in ws), total,
                    sum(math.log10((count[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in ws), model.score(t))
                   for (d, t), h, ws in zip(low, held, tokens)), key=repr)


LM_COLUMNS = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]


def same_scores(got, want):
    """Each byte's log probability is rounded to 16 bits."""
    assert [r[:5] for r in got] == [r[:5] for r in want]
    for a, b in zip(got, want):
        assert a[5] == pytest.approx(b[5], rel=1e-9, abs=1e-9) and a[6] == pytest.approx(b[6], rel=2e-5, abs=1e-9)


@pytest.mark.parametrize("order", [2, 6])
def test_scores_equal_plain_ppm(spark, order):
    docs = table(spark, SF, "documents").where(F.length("text") < 2500)
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    want = lm(rows, order)
    assert any(r[1] for r in want) and len(want) > 30
    same_scores(rows_of(ppm.lm_scores(docs, order=order), *LM_COLUMNS), want)


def test_scores_edges_and_small_blocks(spark):
    rows = edge_rows("ab ac " * 3000) + [(i, "été naïve \x00 zzz Q" + "\x00" * 9 if i % 2 else "", "en", "a", 0) for i in range(100, 130)]
    want = lm([(r[0], r[1]) for r in rows], 3)
    docs = documents(spark, rows)
    same_scores(rows_of(ppm.lm_scores(docs, order=3), *LM_COLUMNS), want)
    # Blocks of a few texts and many shards give the same scores.
    same_scores(rows_of(ppm.lm_scores(docs, order=3, block_bytes=64, shards=23), *LM_COLUMNS), want)
    assert ppm.lm_scores(documents(spark, [])).count() == 0


def test_packed_arrays_come_back():
    rng = np.random.default_rng(3)
    keys = np.unique(rng.integers(0, 1 << 56, 1000).astype(np.uint64))
    assert (ppm.unpacked_keys(ppm.packed_keys(keys)) == keys).all()
    logs = np.log10(rng.integers(1, 10_000, 1000) / 10_000)
    assert ppm.unpacked_logs(ppm.packed_logs(logs)) == pytest.approx(logs, rel=2 ** -16)
    asked = rng.choice(keys, 5000)
    assert (ppm.GramTable(keys, np.arange(len(keys)))[asked] == np.searchsorted(keys, asked)).all()
    same = keys << np.uint64(40)  # keys that collide
    assert (ppm.GramTable(same, np.arange(len(keys)))[same] == np.arange(len(keys))).all()
    for empty in (ppm.unpacked_keys(ppm.packed_keys(keys[:0])), ppm.unpacked_logs(ppm.packed_logs(logs[:0]))):
        assert len(empty) == 0


@pytest.mark.parametrize("order", [2, 3, 4, 5, 6, 7])
def test_places_of_texts(order):
    texts = [b"", b"abc", "été".encode(), b"x" * 20, b"\0" * 12]
    places, starts = ppm.grams(texts, order)
    for t, s in zip(texts, starts.tolist()):
        line = b"\xff" * order + t + b"\xfe"
        want = [int.from_bytes(line[i:i + order + 1], "big") for i in range(len(t) + 1)]
        assert places[s:s + len(t) + 1].tolist() == want
    assert (places == ppm.none(order)).sum() == order * len(texts)
    assert len(ppm.grams([], order)[0]) == 0


def test_nothing_to_learn_from(spark):
    held = next(i for i in range(1, 99) if zlib.crc32(str(i).encode()) % 10 == 0)
    row = ppm.lm_scores(spark.createDataFrame([(held, "abc d")], "doc_id long, text string")).first()
    assert (row["n_tokens"], row["n_known"], row["train_tokens"]) == (3, 0, 0)
    assert row["score"] == pytest.approx(6 * -math.log10(256), rel=2e-5) and row["base_score"] == pytest.approx(0)


def test_probabilities_sum_to_one():
    texts = [b"abracadabra", b"abacus", "été".encode()]
    g = ppm.grams(texts, 3)[0]
    g = g[g != ppm.none(3)]
    low = np.bincount((g & np.uint64(0xFFFF)).astype(np.int64), minlength=1 << 16)
    keys, n = np.unique(g, return_counts=True)
    for context in (b"abr", b"xab", b"zzz", b"\xff\xff\xff"):
        last = context[1:]
        mine = np.array([((int(k) >> 8) & 0xFFFF) == int.from_bytes(last, "big") for k in keys])
        trie = ppm.Trie(3, keys[mine], n[mine], low)
        asked = np.array([int.from_bytes(context, "big") << 8 | s for s in range(256)], np.uint64)
        assert (10 ** trie.log10(asked)).sum() == pytest.approx(1)


def test_held_out_texts_score_above_the_unigram_base(spark):
    got = [r for r in queries.op12_lm_scores(spark, "/root/testdata/sf0.01").collect() if r["held_out"]]
    assert sum(r["score"] for r in got) > sum(r["base_score"] for r in got)


# ---------------------------------------------------------------- hard negatives
def mined(rows, positives=5, negatives=10, low=30, high=90):
    out = []
    for a, la, va in rows:
        if a % 100:
            continue
        score = sorted(((sum(x * y for x, y in zip(va, v)), i, lab) for i, lab, v in rows if i != a), key=lambda r: (-r[0], r[1]))
        for ps, p, _ in [r for r in score if r[2] == la][:positives]:
            fit = [r for r in score if r[2] != la and low * ps <= 100 * r[0] <= high * ps][:negatives]
            out += [(a, p, k + 1, i, ps, s) for k, (s, i, _) in enumerate(fit)]
    return sorted(out, key=repr)


NEGATIVE_COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def frame(spark, rows):
    return spark.createDataFrame([(i, lab, [float(x) for x in v]) for i, lab, v in rows],
                                 "vec_id long, label long, v array<double>")


@pytest.mark.parametrize("kind", ["plain", "ties", "clusters", "copies"])
def test_negatives_equal_brute_force(spark, kind):
    rng = np.random.default_rng(7)
    n, width = 700, 7
    v = {"plain": lambda: rng.integers(-60, 60, (n, width)), "ties": lambda: rng.integers(0, 2, (n, width)),
         "clusters": lambda: rng.integers(-9, 9, (n, width)) + 100 * rng.integers(-1, 2, (n, 1)),
         "copies": lambda: np.where(np.arange(n)[:, None] % 3 == 0, 5, rng.integers(-60, 60, (n, width)))}[kind]()
    rows = [(i, int(rng.integers(0, 4)), v[i].tolist()) for i in range(n)]
    df = frame(spark, rows)
    want = mined(rows)
    assert kind == "ties" or want
    anchors = df.where("vec_id % 100 = 0")
    assert rows_of(H.hard_negatives(df, anchors), *NEGATIVE_COLUMNS) == want
    index = H.Index(df, centres=4, fit_rows=50, partition_rows=60)
    assert rows_of(H.hard_negatives(df, anchors, index=index), *NEGATIVE_COLUMNS) == want


def test_query_blocks_and_chunks(spark):
    rng = np.random.default_rng(8)
    rows = [(i, int(i % 3), rng.integers(-50, 50, 6).tolist()) for i in range(400)]
    index = H.Index(frame(spark, rows), centres=3)
    asked = frame(spark, rows[::20]).withColumn("windows", F.array(H._window(
        F.lit(-1).cast("long"), F.lit(0).cast("long"), F.lit(-H.FOREVER), F.lit(H.FOREVER))))
    plain = rows_of(H._first(H.search(index, asked, True, 5), ["anchor_id"], 5), "anchor_id", "found_id", "score")
    small = H._first(H.search(index, asked, True, 5, chunk_rows=7, query_rows=6), ["anchor_id"], 5)
    assert len(plain) == 100 and rows_of(small, "anchor_id", "found_id", "score") == plain


def test_cells_come_by_falling_bound():
    rng = np.random.default_rng(9)
    upper = rng.normal(size=5), rng.normal(size=6)
    got = list(H.cells_by_bound(upper, (np.arange(5), np.arange(6))))
    assert len({(i, j) for _, i, j in got}) == 30
    assert [b for b, _, _ in got] == sorted((b for b, _, _ in got), reverse=True)
    assert all(b == pytest.approx(upper[0][i] + upper[1][j]) for b, i, j in got)


def test_a_certified_visit_stops_early(spark):
    """Far clusters are never scored once the first rows beat their bound."""
    rng = np.random.default_rng(10)
    centre = np.array([[1000, 0, 0, 0], [-1000, 0, 0, 0], [0, 0, 1000, 0], [0, 0, -1000, 0]])
    m = (centre[np.arange(400) % 4] + rng.integers(-5, 5, (400, 4))).astype(float)
    books = [H.fit_centres(m[:, :2], 3), H.fit_centres(m[:, 2:], 3)]
    (a, ra), (b, rb) = H.nearest(m[:, :2], books[0]), H.nearest(m[:, 2:], books[1])
    chunk = H.Chunk(np.arange(400), np.zeros(400, int), m, a, b)
    seen = []
    chunk.cells = {c: s for c, s in chunk.cells.items()}

    class Seen(dict):
        def get(self, key, default=None):
            if key in self:
                seen.append(key)
            return dict.get(self, key, default)

    chunk.cells = Seen(chunk.cells)
    q = m[0]
    radii = [np.array([r[x == i].max() for i in range(len(bk))]) for r, x, bk in ((ra, a, books[0]), (rb, b, books[1]))]
    mid = [books[0] @ q[:2], books[1] @ q[2:]]
    spread = [np.linalg.norm(q[:2]) * radii[0], np.linalg.norm(q[2:]) * radii[1]]
    got = H.visit(chunk, q, True, 0, 0, [(-H.FOREVER, H.FOREVER)], 5, tuple(x + s for x, s in zip(mid, spread)),
                  tuple(x - s for x, s in zip(mid, spread)))[0]
    assert got == sorted(((int(m[i] @ q), i) for i in range(1, 400)), key=lambda r: (-r[0], r[1]))[:5]
    assert len(seen) < len(chunk.cells)


def test_negatives_edges(spark):
    nan, inf = float("nan"), float("inf")
    raw = [(100, 1, [0.5, 0.25]), (100, 1, [0.5, 0.25]), (1, 1, [1.0, 0.5]), (2, 2, [0.6, 0.3]), (3, 2, [nan, 0.0]),
           (4, 2, [inf, 0.0]), (5, None, [1.0, 1.0]), (6, 1, None), (7, 2, [None, 1.0]), (None, 2, [0.6, 0.3]), (8, 1, []),
           (9, 2, [0.9]), (200, 3, [0.0, 0.0]), (300, 1, [-1.0, -1.0]), (10, 2, [0.6, 0.3])]
    df = spark.createDataFrame(raw, "vec_id long, label int, embedding array<float>").withColumn("v", F.lit("x")).withColumn(
        "a", F.lit(0)).withColumn("score", F.lit(1))
    rows = H.valid_vectors(df)
    kept = [(i, lab, [math.floor(256 * float(np.float32(x))) for x in v]) for i, lab, v in raw
            if i is not None and lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    once = [r for x, r in enumerate(kept) if r not in kept[:x]]
    want = {r for r in mined([(i, lab, (v + [0, 0])[:2]) for i, lab, v in once])}
    assert set(rows_of(H.hard_negatives(rows, rows.where("vec_id % 100 = 0")), *NEGATIVE_COLUMNS)) == want
    empty = H.valid_vectors(df.limit(0))
    assert H.hard_negatives(empty, empty).count() == 0
    assert H.hard_negatives(rows, empty).count() == 0
