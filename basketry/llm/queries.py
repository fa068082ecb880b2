"""Registered queries of the training-data operators, and their DuckDB SQL.

Each query applies one operator with its production parameters to its whole
table and derives the digest columns from the operator's own outputs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm.common import table
from basketry.llm.decontaminate import contamination
from basketry.llm.exact_dedup import exact_groups
from basketry.llm.hard_negatives import HIGH, LOW, NEGATIVES, POSITIVES, hard_negatives, valid_vectors
from basketry.llm.html_extract import extract_text
from basketry.llm.mixing import BLOCK_TOKENS, GRID_BITS, REPEATS, SEED, mix_plan, source_weights
from basketry.llm.ppm import lm_scores
from basketry.llm.secrets import scan
from basketry.llm.sharding import hilbert_shards
from basketry.llm.simhash_dedup import simhash_components
from basketry.llm.spelling import MIN_COUNT, MIN_LENGTH, NOISE, RATIO, spelling_variants
from basketry.llm.suffix_dedup import LENGTH, remove_repeats
from basketry.llm.toxicity import toxicity
from basketry.llm.url_filter import judge_urls

# Target entropy of the mixing query: above that of the tables' own shares, so that the exponent is below 1.
MIX_ENTROPY = 0.9999
# The rules of the URL query (host, path, action).
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def op1_decontamination(spark: SparkSession, d: str) -> DataFrame:
    return contamination(table(spark, d, "documents"), table(spark, d, "benchmark"))


def op2_suffix_dedup(spark: SparkSession, d: str) -> DataFrame:
    out = remove_repeats(table(spark, d, "documents"))
    return out.select("doc_id", "n_bytes", (F.col("n_bytes") - F.length("kept")).alias("n_removed"),
                      F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op3_exact_dedup(spark: SparkSession, d: str) -> DataFrame:
    return exact_groups(table(spark, d, "documents"))


def op4_mixing(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    return mix_plan(docs, source_weights(docs, MIX_ENTROPY)).drop("th")


def op5_simhash(spark: SparkSession, d: str) -> DataFrame:
    return simhash_components(table(spark, d, "documents"))


def op6_sharding(spark: SparkSession, d: str) -> DataFrame:
    return hilbert_shards(table(spark, d, "documents"))


def op7_toxicity(spark: SparkSession, d: str) -> DataFrame:
    return toxicity(table(spark, d, "documents"), table(spark, d, "labels"))


def op8_url_filter(spark: SparkSession, d: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, action string")
    return judge_urls(table(spark, d, "pages"), rules)


def op9_secrets(spark: SparkSession, d: str) -> DataFrame:
    return scan(table(spark, d, "documents"))


def op10_html_text(spark: SparkSession, d: str) -> DataFrame:
    return extract_text(table(spark, d, "pages"))


def op11_spelling_variants(spark: SparkSession, d: str) -> DataFrame:
    return spelling_variants(table(spark, d, "documents"))


def op12_lm_scores(spark: SparkSession, d: str) -> DataFrame:
    return lm_scores(table(spark, d, "documents"))


def op13_hard_negatives(spark: SparkSession, d: str) -> DataFrame:
    rows = valid_vectors(table(spark, d, "embeddings"))
    rows = rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives(rows, rows.where(F.col("vec_id") % 100 == 0))


def pipeline(spark: SparkSession, d: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, d)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = [op1_decontamination, op2_suffix_dedup, op3_exact_dedup, op4_mixing, op5_simhash, op6_sharding,
             op7_toxicity, op8_url_filter, op9_secrets, op10_html_text, op11_spelling_variants,
             op12_lm_scores, op13_hard_negatives, pipeline]
    return {f.__name__: f for f in named}


# ---------------------------------------------------------------- DuckDB SQL
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORDS_SQL = (
    "list_filter(regexp_split_to_array(translate(coalesce(text, ''), '" + UPPER + "', '" + LOWER + "'), "
    r"'[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '')")

DECONTAMINATION_SQL = f"""
WITH it AS (SELECT item_id, {WORDS_SQL} AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, array_to_string(list_slice(w, i, i + least(len(w), 10) - 1), ' ') AS s,
               least(len(w), 10) AS n
        FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM it WHERE len(w) > 0)),
d AS (SELECT doc_id, {WORDS_SQL} AS w FROM documents),
sizes AS (SELECT DISTINCT n FROM win),
cut AS (SELECT doc_id, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') AS s
        FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
hit AS (SELECT DISTINCT cut.doc_id, cut.i, cut.n, win.item_id FROM cut JOIN win ON cut.s = win.s AND cut.n = win.n),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit
        FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
        FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id)"""

SUFFIX_SQL = f"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x, octet_length(encode(coalesce(text, ''))) AS n
           FROM documents),
w AS (SELECT doc_id, i, substr(x, 2 * i + 1, {2 * LENGTH}) AS s
      FROM (SELECT doc_id, x, unnest(range(0, n - {LENGTH - 1})) AS i FROM d WHERE n >= {LENGTH})),
m AS (SELECT s, min(doc_id) AS o FROM w GROUP BY s),
r AS (SELECT w.doc_id, w.i, lag(w.i) OVER (PARTITION BY w.doc_id ORDER BY w.i) AS p
      FROM w JOIN m USING (s) WHERE w.doc_id > m.o),
g AS (SELECT doc_id, i, sum(CASE WHEN p IS NULL OR i > p + {LENGTH} THEN 1 ELSE 0 END)
                        OVER (PARTITION BY doc_id ORDER BY i) AS k FROM r),
sp AS (SELECT doc_id, min(i) AS a, max(i) + {LENGTH} AS b FROM g GROUP BY doc_id, k),
gap AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS e FROM sp),
k AS (SELECT doc_id, string_agg(substr(x, 2 * e + 1, 2 * (a - e)), '' ORDER BY a) AS pre, max(b) AS last,
             sum(b - a) AS n_removed, count(*) AS n_spans FROM gap JOIN d USING (doc_id) GROUP BY doc_id)
SELECT d.doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(CASE WHEN last IS NULL THEN x ELSE pre || substr(x, 2 * last + 1) END)) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)"""

EXACT_SQL = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY sha256(coalesce(text, '')))"""


def _uniform_sql(*parts: str) -> str:
    return f"CAST('0x' || substr(md5(concat_ws('|', {', '.join(parts)})), 1, 15) AS BIGINT)"


MIXING_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS source,
                  CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS tokens
           FROM documents),
s0 AS (SELECT source, CAST(sum(tokens) AS BIGINT) AS t, count(*) AS c FROM d GROUP BY source HAVING sum(tokens) > 0),
s AS (SELECT *, t / sum(t) OVER () AS share, sum(t) OVER () AS total, count(*) OVER () AS n FROM s0),
grid AS (SELECT k, sum(w) AS z, sum(w * ln(w)) AS wl, max(w / share) AS r
         FROM (SELECT k, share, exp(ln(share) * k / {float(2 ** GRID_BITS)}) AS w FROM s, range({2 ** GRID_BITS + 1}) g(k))
         GROUP BY k),
seen AS (SELECT k, ln(z) - wl / z AS h, r / z AS reps FROM grid),
ke AS (SELECT coalesce(max(k), 0) AS k FROM seen WHERE h >= {MIX_ENTROPY} * ln((SELECT count(*) FROM s))),
kr AS (SELECT least(coalesce(max(k), -1) + 1, {2 ** GRID_BITS}) AS k FROM seen WHERE reps > {REPEATS}),
kk AS (SELECT CASE WHEN (SELECT count(*) FROM s) < 2 THEN {2 ** GRID_BITS} ELSE greatest(ke.k, kr.k) END AS k FROM ke, kr),
p0 AS (SELECT source, t, total, exp(ln(share) * (SELECT k FROM kk) / {float(2 ** GRID_BITS)}) AS w FROM s),
p AS (SELECT source, t, CAST(round(w / sum(w) OVER () * total) AS BIGINT) AS quota FROM p0),
q AS (SELECT *, greatest(CAST(ceil(sum(quota) OVER () / {BLOCK_TOKENS}) AS BIGINT), 1) AS blocks FROM p WHERE quota > 0),
u AS (SELECT d.doc_id, d.source, d.tokens, q.t, q.quota, q.blocks, unnest(range((q.quota - 1) // q.t + 1)) AS epoch
      FROM d JOIN q USING (source)),
h AS (SELECT *, {_uniform_sql(f"'{SEED}'", "CAST(epoch AS VARCHAR)", "CAST(doc_id AS VARCHAR)")} AS h FROM u),
b AS (SELECT *, epoch * t + coalesce(sum(tokens) OVER (PARTITION BY source, epoch ORDER BY h, doc_id
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM h),
placed AS (SELECT *, CAST(start * blocks // quota AS INTEGER) AS block FROM b WHERE start < quota)
SELECT doc_id, source, CAST(epoch AS INTEGER) AS epoch, block,
       row_number() OVER (PARTITION BY block ORDER BY
           {_uniform_sql(f"'{SEED}b'", "CAST(epoch AS VARCHAR)", "CAST(doc_id AS VARCHAR)")}, doc_id, source, tokens) - 1
           AS slot, tokens
FROM placed"""

URL_SQL = f"""
WITH rules(host, path, action) AS (VALUES {', '.join(str(r) for r in URL_RULES)}),
u AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host,
             regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
fit AS (SELECT u.page_id, r.host || r.path AS rule, r.action,
               row_number() OVER (PARTITION BY u.page_id ORDER BY length(r.host || r.path) DESC, length(r.host) DESC) AS n
        FROM u JOIN rules r ON (u.host = r.host OR ends_with(u.host, '.' || r.host)) AND starts_with(u.path, r.path))
SELECT u.page_id, u.host, u.path, fit.rule, coalesce(fit.action, 'allow') AS verdict
FROM u LEFT JOIN fit ON u.page_id = fit.page_id AND fit.n = 1"""


SPELLING_SQL = f"""
WITH RECURSIVE crc(v) AS (SELECT list(x ORDER BY i) FROM (
    SELECT i, list_reduce([i] || [0, 0, 0, 0, 0, 0, 0, 0],
                          lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS x
    FROM (SELECT unnest(range(256)) AS i))),
t AS (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[a-zÀ-ÿ]+')) AS run
      FROM documents),
r AS (SELECT run, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS x, count(*) AS c
      FROM t GROUP BY doc_id, run),
h AS (SELECT run, c, xor(4294967295, list_reduce([4294967295] || list_transform(range(0, length(x) // 2),
             lambda i: CAST('0x' || substr(x, 2 * i + 1, 2) AS BIGINT)),
             lambda a, b: xor(a >> 8, v[1 + (xor(a, b) & 255)]))) AS h FROM r, crc),
w AS (SELECT word, CAST(sum(c) AS BIGINT) AS n FROM (
          SELECT c, CASE WHEN h % {NOISE} = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2)
                         ELSE run END AS word FROM h)
      WHERE length(word) >= {MIN_LENGTH} GROUP BY word HAVING sum(c) >= {MIN_COUNT}),
p AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM w),
k AS (SELECT word, n, i, substr(word, 1, i - 1) AS a, substr(word, i + 1) AS b FROM p),
d AS (SELECT DISTINCT k.word, k.n, w.word AS other, w.n AS other_n FROM k JOIN w ON w.word = k.a || k.b),
near AS (SELECT x.word, x.n, y.word AS other, y.n AS other_n FROM k x JOIN k y
             ON x.a = y.a AND x.b = y.b AND x.i = y.i AND x.word <> y.word
         UNION ALL SELECT * FROM d UNION ALL SELECT other, other_n, word, n FROM d),
best AS (SELECT word, count(*) AS n_near, first(other ORDER BY other_n DESC, hex(encode(other))) AS other,
                max(other_n) AS other_n FROM near GROUP BY word),
f AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= {RATIO} * n THEN other END AS form,
             CASE WHEN other_n >= {RATIO} * n THEN other_n END AS form_n FROM w LEFT JOIN best USING (word)),
up(word, root, depth) AS (SELECT word, word, 0 FROM f
    UNION ALL SELECT up.word, f.form, depth + 1 FROM up JOIN f ON f.word = up.root WHERE f.form IS NOT NULL),
last AS (SELECT word, arg_max(root, depth) AS root FROM up GROUP BY word)
SELECT f.word, f.form, last.root, f.n, CAST(f.n_near AS BIGINT) AS n_near, f.form_n FROM f JOIN last USING (word)"""

NEGATIVES_SQL = f"""
WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
           FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS a, r.vec_id AS r, a.label = r.label AS same, CAST(list_inner_product(a.v, r.v) AS BIGINT) AS s
      FROM e a JOIN e r ON r.vec_id <> a.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT a, r, s FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY s DESC, r) <= {POSITIVES})
SELECT p.a AS anchor_id, p.r AS positive_id,
       CAST(row_number() OVER (PARTITION BY p.a, p.r ORDER BY s.s DESC, s.r) AS INTEGER) AS rank,
       s.r AS negative_id, p.s AS positive_score, s.s AS negative_score
FROM p JOIN s ON s.a = p.a AND NOT s.same AND {LOW} * p.s <= 100 * s.s AND 100 * s.s <= {HIGH} * p.s
QUALIFY rank <= {NEGATIVES}"""


def oracle_sql() -> dict[str, str]:
    return {"op1_decontamination": DECONTAMINATION_SQL, "op2_suffix_dedup": SUFFIX_SQL, "op3_exact_dedup": EXACT_SQL,
            "op4_mixing": MIXING_SQL, "op8_url_filter": URL_SQL,
            "op11_spelling_variants": SPELLING_SQL, "op13_hard_negatives": NEGATIVES_SQL}
