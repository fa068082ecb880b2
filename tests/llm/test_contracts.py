"""What the operators promise of odd input: repeated ids, clashing names, limits, whole values, markup."""

import time
import zlib

import pytest
from helpers import DOC_SCHEMA, components, documents, rows_of, simhash
from pyspark.sql import functions as F

from basketry.llm import decontaminate, html_extract, mixing, secrets, sharding, simhash_dedup, suffix_dedup, toxicity

INNER = ["id", "th", "n", "used", "copies", "copy", "use", "crc", "size", "at", "here", "again", "root", "component_id"]
NAMES = [*INNER, *[f"__{c}" for c in INNER], "ID", "Th"]


def texts(n: int, words: int = 12) -> list[str]:
    return [" ".join(f"w{(i * 7919 + j * 104729) % 9973}" for j in range(words)) for i in range(n)]


def odd_rows() -> list[tuple]:
    a, b, c = texts(3)
    return [(1, a, "en", "s", 1), (1, b, "en", "s", 1), (0, b, "en", "t", 1), (2, a, "en", None, 1), (2, a, "en", None, 1),
            (3, None, None, None, None), (4, "", "en", "s", 0), (None, c, "en", "s", 1), (None, c, "en", "s", 1),
            (5, c + " more", "en", "s", 1), (0, b, "en", "t", 1)]


# ---------------------------------------------------------------- near duplicates
def test_simhash_dedup_keeps_one_row_of_each_component(spark):
    rows = odd_rows()
    kept = simhash_dedup.simhash_dedup(documents(spark, rows, clash=False)).collect()
    labels = components([(r[0], r[1]) for r in rows])
    by_print = {(i, fp): c for i, fp, c in labels}
    got = [(r.doc_id, by_print[r.doc_id, f"{simhash(r.text):016x}"]) for r in kept]
    assert all(i == c for i, c in got)  # the smallest doc_id stays, and (1, b) goes with (0, b)
    assert sorted(got, key=repr) == sorted({(c, c) for _, _, c in labels}, key=repr)


def test_simhash_dedup_of_null_components(spark):
    """Components of null ids only keep one row each."""
    a, b, _ = texts(3)
    rows = [(None, a, "en", "s", 1), (None, a, "en", "s", 1), (None, b, "en", "s", 1)]
    kept = simhash_dedup.simhash_dedup(documents(spark, rows, clash=False)).collect()
    assert sorted(r.text for r in kept) == sorted([a, b])


# ---------------------------------------------------------------- clashing names
@pytest.mark.parametrize("step", ["simhash", "decontaminate", "mix", "mix_all", "shard", "toxic"])
def test_columns_of_any_name_pass_through(spark, step):
    rows = odd_rows()
    df = spark.createDataFrame(rows, DOC_SCHEMA)
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        plain = df
        wide = df.select("*", *[F.lit(f"x-{c}").alias(c) for c in NAMES])
        items = spark.createDataFrame([(1, texts(2)[1])], "item_id long, text string")
        marks = spark.createDataFrame([(1, 0, 0)], "doc_id long, quality int, toxic int")
        run = {"simhash": simhash_dedup.simhash_dedup, "decontaminate": lambda d: decontaminate.decontaminate(d, items),
               "mix": lambda d: mixing.mix_sources(d, repeats=2.0), "mix_all": lambda d: mixing.mix_sources(d, keep_all=True),
               "shard": sharding.sharded, "toxic": lambda d: toxicity.drop_toxic(d, marks)}[step]
        got, want = run(wide), run(plain)
        base = list(df.columns)
        assert [c for c in got.columns if c not in NAMES] == want.columns and set(NAMES) <= set(got.columns)
        assert rows_of(got, *base) == rows_of(want, *base) and got.count() > 3
        assert all(r[c] == f"x-{c}" for r in got.collect() for c in NAMES)
    finally:
        spark.conf.unset("spark.sql.caseSensitive")


def test_pipeline_of_odd_rows(spark, tmp_path):
    import corpus_pipeline as P

    folder = str(tmp_path)
    spark.createDataFrame([(1, texts(2)[1])], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame([(1, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    docs = spark.createDataFrame(odd_rows(), DOC_SCHEMA).select("*", *[F.lit(c).alias(c) for c in INNER])
    docs.write.parquet(f"{folder}/documents.parquet")
    out = P.run(spark, folder)
    assert out.columns == [*docs.columns, "shard", "slot"]
    got = [(r.doc_id, r.text) for r in out.collect()]
    # Each component keeps its smallest id; 0 holds the benchmark's text.
    want = {c for _, _, c in components([(r[0], r[1]) for r in odd_rows()])} - {0}
    assert {i for i, _ in got} == want and (1, texts(1)[0]) in got and (3, None) in got
    docs.limit(0).write.parquet(f"{folder}/none/documents.parquet")
    for t in ("benchmark", "labels"):
        spark.read.parquet(f"{folder}/{t}.parquet").write.parquet(f"{folder}/none/{t}.parquet")
    assert P.run(spark, f"{folder}/none").count() == 0


# ---------------------------------------------------------------- mixing
@pytest.mark.parametrize("limit", [1.0, 2.0, 3.5, None])
def test_uses_keep_to_the_limit(spark, limit):
    rows = [(i, f"t{i} " * 10, "en", s, 1) for s, a, n in (("big", 0, 600), ("mid", 600, 60), ("small", 660, 6))
            for i in range(a, a + n)]
    got = mixing.mix_sources(documents(spark, rows, clash=False), entropy=1.0, repeats=limit, keep_all=True)
    uses = {r["doc_id"]: r["n"] for r in got.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert set(uses) == {r[0] for r in rows}
    assert all(uses[i] == 1 for i in range(600))
    most = max(uses.values())
    assert most == 100 if limit is None else most <= -(-limit // 1)
    if limit == 2.0:  # and it is used
        weights = mixing.source_weights(documents(spark, rows, clash=False), 1.0, limit, keep_all=True).collect()
        ratio = {r["source"]: r["quota"] / r["tokens"] for r in weights}
        assert 1.9 <= ratio["small"] <= 2.0 and ratio["big"] == 1.0 and 1.0 < ratio["mid"] < ratio["small"]


# ---------------------------------------------------------------- sharding
def curve(cell: list[int], bits: int) -> int:
    x, n = list(cell), len(cell)
    q = 1 << (bits - 1)
    while q > 1:
        for i in range(n):
            if x[i] & q:
                x[0] ^= q - 1
            else:
                t = (x[0] ^ x[i]) & (q - 1)
                x[0], x[i] = x[0] ^ t, x[i] ^ t
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t, q = 0, 1 << (bits - 1)
    while q > 1:
        t ^= (q - 1) if x[-1] & q else 0
        q >>= 1
    out = 0
    for plane in range(bits - 1, -1, -1):
        for v in x:
            out = out << 1 | ((v ^ t) >> plane & 1)
    return out


def test_shards_equal_brute_force(spark):
    """Cells by rank of whole values, the curve, the cut and the slots, row by row."""
    rows = [(i, f"{'x' * (i * i % 97)}{i}", ["en", "de", None][i % 3], f"common_crawl-{i % 16:02d}", 1) for i in range(300)]
    rows += [(1000 + i, "hot", "en", "hot", 1) for i in range(150)]
    bits, shards = 4, 16
    size = [len((r[1] or "").encode()) + 1 for r in rows]
    crc = [zlib.crc32((r[1] or "").encode()) for r in rows]
    dims = [[r[2] or "" for r in rows], [r[3] or "" for r in rows], size]

    def cells(values):
        order, n = sorted(values), len(values)
        return [(2 * order.index(v) + values.count(v)) * 2 ** bits // (2 * n) for v in values]

    per_dim = [cells(d) for d in dims]
    index = [curve([c[i] for c in per_dim], bits) for i in range(len(rows))]
    ranked = sorted(range(len(rows)), key=lambda i: (index[i], rows[i][0], crc[i], size[i]))
    want, slot = [], [0] * shards
    for rank, i in enumerate(ranked):
        s = rank * shards // len(rows)
        want.append((rows[i][0], size[i], crc[i], index[i], s, slot[s]))
        slot[s] += 1
    got = sharding.hilbert_shards(documents(spark, rows))
    assert rows_of(got, "doc_id", "size", "text_crc32", "hilbert", "shard", "slot") == sorted(want, key=repr)
    # Sources with a long common prefix have cells of their own.
    assert got.where("cell_source is not null").select("cell_source").distinct().count() >= 8


# ---------------------------------------------------------------- secrets
def test_candidates_of_further_kinds(spark):
    values = {1: ("postgres://admin:", "S3cr3tPw", "@db.host/x"), 2: ("key ", "glpat-ABCDEFabcdefGHIJKLMN", ""),
              3: ("Authorization: Bearer ", "abcDEFghiJKLmno", ""), 4: ("got ", "abcDEFghiJKLmnoPQRstu", " there"),
              5: ("x ", "npm_" + "aB3" * 12, "")}
    docs = spark.createDataFrame([(i, "".join(v), "a") for i, v in values.items()], "doc_id long, text string, source string")
    found = {(r.doc_id, r.start, r.value) for r in secrets.candidates(docs).collect()}
    assert {(i, len(a), v) for i, (a, v, _) in values.items()} <= found


def test_long_values_are_judged_whole():
    words = frozenset({"word"})
    head = "x" * 300
    assert secrets.coverage(head + "word" * 100, words) == pytest.approx(400 / 700)
    long, longer = (secrets.features("a1" * n, "", "", "", words) for n in (3000, 6000))
    assert long[0] == 6000 and longer[0] == 12000


def test_dictionary_is_the_corpus(spark):
    rows = [(i, "apple pear far from any finding " + ("rare " if i < 2 else ""), "en", "a", 1) for i in range(20)]
    words = secrets.dictionary(documents(spark, rows))
    assert {"apple", "pear", "finding"} <= words and "rare" not in words and "far" not in words
    assert secrets.dictionary(documents(spark, rows), share=0.9) == frozenset()
    assert secrets.dictionary(documents(spark, [])) == frozenset()


# ---------------------------------------------------------------- pages
BODY = "A long sentence of the article that is text enough to be a body of its own, and then some more. " * 3


@pytest.mark.parametrize("part", [
    '<div style="overflow:hidden">kept words here</div>', '<p title="the hidden costs">kept words here</p>',
    '<p><a href="/x?class=ad">kept words here</a></p>', '<div data-id="search">kept words here</div>',
    '<p data-role=\'navigation\' xclass="ad">kept words here</p>', '<p title="class=ad id=menu">kept words here</p>',
    '<section id="related-work">kept words here</section>', "<p data-hidden>kept words here</p>"])
@pytest.mark.parametrize("outer", ["article", "div"])
def test_names_inside_names_and_values_are_no_marks(part, outer):
    page = f"<html><body><{outer}><p>{BODY}</p>{part}<p>{BODY}</p></{outer}></body></html>"
    assert "kept words here" in html_extract.main_text(page)


@pytest.mark.parametrize("part", ["<div hidden>gone words</div>", "<div class=ad>gone words</div>", "<nav>gone words</nav>",
                                  "<div role = 'navigation' >gone words</div>", '<div aria-hidden="true">gone words</div>'])
def test_marks_are_still_read(part):
    page = f"<html><body><article><p>{BODY}</p>{part}<p>{BODY}</p></article></body></html>"
    assert "gone" not in html_extract.main_text(page)
    outside = f'<html><body><div id="site-footer">gone words</div><div><p>{BODY}</p></div></body></html>'
    assert "gone" not in html_extract.main_text(outside)


def test_stray_end_tags_take_linear_time():
    took = []
    for n in (8_000, 80_000):
        page = "<div>" * n + BODY + "</ul>" * n + "</span>" * n + "</a>" * n
        t = time.perf_counter()
        assert html_extract.main_text(page).startswith("A long sentence")
        took.append(time.perf_counter() - t)
    assert took[1] < 40 * took[0] + 0.5 and took[1] < 10


# ---------------------------------------------------------------- splitters
def test_many_buckets_are_split_quickly():
    sample = sorted((i * 2654435761 % 2 ** 32).to_bytes(16, "big") for i in range(400_000))
    t = time.perf_counter()
    s = suffix_dedup.Splitters(sample, 200_000)
    assert time.perf_counter() - t < 5 and s.plain == 200_000
    hot = suffix_dedup.Splitters(sorted(sample[:1000] + [b"h" * 16] * 1000), 20)
    assert hot.shared[b"h" * 16][1] >= 9
