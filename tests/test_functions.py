"""Column expressions."""

from pyspark.sql import functions as F

from basketry.functions import itemset_literal, java_string_hash, n_chunks, normalise_item_id, strip_quotes


def java_hash(s: str) -> int:
    h = 0
    for ch in s:
        h = (31 * h + ord(ch)) & 0xFFFFFFFF
    return h - (1 << 32) if h >= 1 << 31 else h


def test_java_string_hash(spark):
    words = ["", "a", "1", "19", "polygenelubricants", "Brand#13", "zzzzzzzzzzzzzzzzzzzz", "ÿé"]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    got = {r["w"]: r["h"] for r in df.select("w", java_string_hash("w").alias("h")).collect()}
    assert got == {w: java_hash(w) for w in words}


def test_n_chunks_rules():
    assert [n_chunks(s) for s in (1, 2, 4, 9, 50)] == [1, 1, 2, 4, 8]
    assert [n_chunks(s, "sqrt") for s in (1, 9, 25, 60)] == [1, 3, 5, 8]


def test_text_helpers(spark):
    df = spark.createDataFrame([('"0047"',), ('""',), ('"',), ("",)], "v string")
    rows = df.select(strip_quotes("v").alias("s")).collect()
    assert [r["s"] for r in rows] == ["0047", "", "", ""]
    ids = spark.createDataFrame([("0047",), ("47",), (" 047",)], "v string")
    assert {r["n"] for r in ids.select(normalise_item_id("v").alias("n")).collect()} == {"47"}
    sets = spark.createDataFrame([(["a"],), (["a", "b"],)], "s array<string>")
    assert [r["t"] for r in sets.select(itemset_literal("s").alias("t")).collect()] == ["('a')", "('a', 'b')"]
