"""Temperature mixing of sources, realised as budgeted block permutations.

Weights: each source's token share is raised to an exponent in [0, 1] and
normalised.  A smaller exponent is flatter: entropy rises, and small sources
repeat more.  The exponent is bisected on a dyadic grid; one job evaluates
``2^HALVINGS`` exponents at once, which is that many halvings.  The largest
exponent that reaches the target entropy is taken, unless the repetition limit
needs a larger one.

Realisation: a source with quota ``q`` tokens is read in epochs, each a
seeded permutation of all its documents, until ``q`` is used up.  The mix is
cut into blocks with the same token budget, each holding its part of every
source's quota, and permuted inside.  Running token sums are taken per slice
of the permutation (a few thousand documents) with the slices' totals summed
separately, so a source with a third of all rows spreads over many tasks.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm.common import durable, fresh, row_key, small, text_key, whole_text

ENTROPY = 0.97  # of the largest possible, ln(number of sources)
REPEATS = 4.0
BLOCK_TOKENS = 100_000
SEED = 7
GRID_BITS = 12
HALVINGS = 4
SLICE_DOCS = 4096
SPACE = r"[\x20\x09-\x0D]+"


def _tokens() -> Column:
    return F.size(F.array_remove(F.split(whole_text(), SPACE), "")).cast("long")


def _uniform(*parts: Column) -> Column:
    """60 uniform bits of the md5 of ``parts``, the same in any SQL engine."""
    text = F.concat_ws("|", *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def exponent(sources: DataFrame, entropy: float, repeats: float | None, budget: int | None,
             keep_all: bool = False) -> float:
    """The exponent for ``sources(source, tokens, share)``.

    Bisects k in exponent = k / 2^GRID_BITS; only the evaluated grid points
    (16 rows a job) reach the driver.  A source is used weight * budget / tokens
    times; with ``keep_all`` the source used least is used once, so the uses of
    another are the ratio of the two."""
    n, total = sources.agg(F.count(F.lit(1)), F.sum("tokens")).first()
    if n < 2:
        return 1.0
    goal = entropy * math.log(n)
    scale = (total if budget is None else budget) / total

    def evaluate(points: list[int]) -> dict[int, tuple[float, float]]:
        at = sources.select("share", F.explode(F.array(*[F.lit(p) for p in points])).alias("k"))
        power = F.exp(F.log("share") * F.col("k") / F.lit(float(2 ** GRID_BITS)))
        at = at.select("k", power.alias("w"), (power / F.col("share")).alias("r"))
        rows = at.groupBy("k").agg(F.sum("w").alias("z"), F.sum(F.col("w") * F.log("w")).alias("wl"),
                                   F.max("r").alias("r"), F.min("r").alias("l")).collect()
        uses = (lambda r: r["r"] / r["l"]) if keep_all else (lambda r: r["r"] / r["z"] * scale)
        return {r["k"]: (math.log(r["z"]) - r["wl"] / r["z"], uses(r)) for r in rows}

    def bisect(holds) -> int:
        """Largest grid point where a condition holds that holds from 0 up to it (0 if nowhere)."""
        low, high = 0, 2 ** GRID_BITS + 1  # holds at low, not at high
        while high - low > 1:
            step = max(1, (high - low) >> HALVINGS)
            points = list(range(low + step, high, step))
            seen = evaluate(points)
            low = max([low, *(p for p in points if holds(*seen[p]))])
            high = min([high, *(p for p in points if p > low)])
        return low

    # Entropy falls and repetition falls as the exponent grows.
    k = bisect(lambda h, _: h >= goal)
    if repeats is not None and evaluate([k])[k][1] > repeats:
        k = min(bisect(lambda _, r: r > repeats) + 1, 2 ** GRID_BITS)
    return k / 2 ** GRID_BITS


def source_weights(docs: DataFrame, entropy: float = ENTROPY, repeats: float | None = REPEATS,
                   budget: int | None = None, keep_all: bool = False) -> DataFrame:
    """``source, tokens, n_docs, share, weight, quota``: one row per source with tokens.

    ``budget`` is the mix's token budget (default: the corpus' tokens).  With
    ``keep_all`` it is raised until every source gets at least its own tokens,
    so that each document appears, and ``repeats`` limits the uses after that.  A
    null source is the empty one."""
    per_doc = docs.select(F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"),
                          _tokens().alias("t"))
    sources = durable(per_doc.groupBy("source").agg(F.sum("t").alias("tokens"), F.count(F.lit(1)).alias("n_docs"))
                      .where("tokens > 0").withColumn("share", F.col("tokens") / F.sum("tokens").over(Window.partitionBy())))
    alpha = exponent(sources, entropy, repeats, budget, keep_all)
    power = F.exp(F.log("share") * F.lit(alpha))
    weighted = sources.withColumn("weight", power / F.sum(power).over(Window.partitionBy()))
    size = F.lit(budget) if budget is not None else F.sum("tokens").over(Window.partitionBy())
    if keep_all:
        size = F.max(F.col("tokens") / F.col("weight")).over(Window.partitionBy())
    quota = F.round(F.col("weight") * size).cast("long")
    if keep_all:  # rounding must neither cost a source its last document nor repeat one once too often
        quota = quota if repeats is None else F.least(quota, F.floor(F.col("tokens") * repeats))
        quota = F.greatest(quota, F.col("tokens"))
    return durable(weighted.withColumn("quota", quota).withColumn("exponent", F.lit(alpha)))


def mix_plan(docs: DataFrame, weights: DataFrame, block_tokens: int = BLOCK_TOKENS, seed: int = SEED) -> DataFrame:
    """``doc_id, th, source, epoch, block, slot, tokens``: the mix, one row per use of a document.

    A document is used while its source's quota is not yet reached where it
    begins, so a source overruns its quota by less than one document.  Blocks
    count from 0 and hold about ``block_tokens`` tokens; ``slot`` counts from 0
    in each.  Null and empty texts have no tokens and go along where they fall
    in the permutation; sources without any token are left out, having weight
    zero.  Repeated rows are used once each; an empty table gives no rows.
    """
    base = durable(docs.select(
        "doc_id", text_key().alias("th"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"),
        _tokens().alias("tokens")))
    total = F.sum("quota").over(Window.partitionBy())
    plan = weights.where("quota > 0").select(
        "source", F.col("tokens").alias("all"), "quota",
        F.ceil(F.col("n_docs") / SLICE_DOCS).cast("long").alias("slices"),
        F.greatest(F.ceil(total / block_tokens), F.lit(1)).cast("long").alias("blocks"))
    # A source may hold a third of all rows: its documents stay where they are while the quotas fit a broadcast.
    uses = base.join(small(plan, F.octet_length("source") + 64), "source")
    uses = uses.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.expr("cast((quota - 1) div all as int)"))))
    uses = uses.withColumn("h", _uniform(F.lit(seed), F.col("epoch"), F.coalesce("doc_id", F.lit(-1))))
    part = F.shiftright(F.shiftright(F.col("h"), 30) * F.col("slices"), 30)
    uses = uses.withColumn("slice", part)
    sliced = uses.groupBy("source", "epoch", "slice").agg(F.sum("tokens").alias("st"))
    earlier = Window.partitionBy("source", "epoch").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sliced.select("source", "epoch", "slice", F.coalesce(F.sum("st").over(earlier), F.lit(0)).alias("so"))
    here = (Window.partitionBy("source", "epoch", "slice").orderBy("h", "doc_id", "tokens", "th")
            .rowsBetween(Window.unboundedPreceding, -1))
    begin = F.col("epoch") * F.col("all") + F.col("so") + F.coalesce(F.sum("tokens").over(here), F.lit(0))
    placed = uses.join(offsets, ["source", "epoch", "slice"]).withColumn("begin", begin)
    placed = placed.where("begin < quota").withColumn("block", F.expr("cast((begin * blocks) div quota as int)"))
    placed = placed.withColumn("order", _uniform(F.lit(f"{seed}b"), F.col("epoch"), F.coalesce("doc_id", F.lit(-1))))
    slot = F.row_number().over(Window.partitionBy("block").orderBy("order", "doc_id", "source", "tokens", "th")) - 1
    return placed.select("doc_id", "th", "source", "epoch", "block", slot.cast("long").alias("slot"), "tokens")


def mix_sources(docs: DataFrame, entropy: float = ENTROPY, repeats: float | None = REPEATS,
                budget: int | None = None, keep_all: bool = False, block_tokens: int = BLOCK_TOKENS,
                seed: int = SEED) -> DataFrame:
    """The mix as documents: every use of a document is a row with all its columns.

    Rows that repeat a doc_id and text are one document here, used as often as
    all of them together.  With ``keep_all`` every row is used at least once,
    also those without tokens, which no quota counts.  A null text or source is
    empty; texts are read whole; columns of any name pass through; an empty table
    gives no rows."""
    weights = source_weights(docs, entropy, repeats, budget, keep_all)
    doc_id = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    id_, th, used, copies, copy, n, use = fresh(docs, "id", "th", "used", "copies", "copy", "n", "use")
    uses = mix_plan(docs, weights, block_tokens, seed).groupBy(
        doc_id.alias(id_), F.col("th").alias(th)).agg(F.count(F.lit(1)).alias(used))
    same = Window.partitionBy(id_, th)
    rows = docs.withColumns(row_key(id_, th)).withColumns({
        copies: F.count(F.lit(1)).over(same), copy: F.row_number().over(same.orderBy(id_))})
    # The uses are dealt to the repeated rows in turn.
    times = F.expr(f"cast(({used} + {copies} - {copy}) div {copies} as int)")
    if keep_all:
        times = F.greatest(times, F.lit(1))  # null where no use is planned
    return (rows.join(uses, [id_, th], "left" if keep_all else "inner").withColumn(n, times).where(F.col(n) > 0)
            .withColumn(use, F.explode(F.sequence(F.lit(1), F.col(n)))).select(*[f"`{c}`" for c in docs.columns]))
