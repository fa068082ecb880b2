"""Toxicity by weak supervision.

1. Voters.  From a bounded sample of labelled rows (never held-out ones) the
   words and word prefixes that separate the labels are mined, by their mere
   presence or by their density: each becomes a lexicon voter (whole words) or
   a pattern voter (prefixes, densities), voting toxic or, for those that
   speak against it, clean.
2. Label model.  A generative model of the votes given a hidden class is
   fitted by expectation-maximisation: per voter its firing rate in either
   class (its accuracy), and between voters their correlation given the class,
   which discounts voters that repeat one another.  Known labels enter as soft
   evidence (``LABEL_TRUST``), so a mislabelled row can be outvoted.
3. A logistic regression over vote and text-shape features is trained on the
   posterior labels and scores every whole text in one pass.

The fit sees at most ``FIT_ROWS`` rows, taken by a hash order; only their vote
vectors and the mined counts reach the driver.  Labels, language, source and
doc_id are never inputs of a score.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import durable, utf8

FIT_ROWS = 12_000  # bound of the labelled sample
VOTERS = 400
MIN_SUPPORT = 2
PREFIXES = (4, 5, 6, 7)
DENSE = 100  # words between two uses of a gram that counts as dense
LABEL_TRUST = 0.99
ROUNDS = 12
WORD = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class Model:
    """Voters with their mined side (+1 toxic, -1 clean) and the classifier."""

    grams: tuple[str, ...]
    side: tuple[int, ...]
    accuracy: tuple[float, ...]
    weights: tuple[float, ...]
    bias: float


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(utf8(doc_id.cast("string"))), F.lit(5)) == 0, F.lit(False))


def grams_of(text: str) -> set[str]:
    """Whole words (``word``) and their prefixes (``^pref``); with ``+`` those that come up every
    ``DENSE`` words or more often."""
    words = Counter(WORD.findall(text.lower()))
    counts = Counter(words)
    for w, c in words.items():
        for n in PREFIXES:
            if len(w) >= n:
                counts["^" + w[:n]] += c
    total = sum(words.values())
    return counts.keys() | {g + "+" for g, c in counts.items() if c * DENSE >= total}


def _sample(docs: DataFrame, labels: DataFrame, fit_rows: int) -> DataFrame:
    """At most ``fit_rows`` labelled rows that are not held out, in a hash order."""
    marks = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(
        F.max(F.col("toxic").cast("int")).alias("y"))
    marks = marks.where(~held_out(F.col("doc_id")))
    order = F.xxhash64(F.col("doc_id").cast("string"), F.lit("fit"))
    chosen = durable(marks.orderBy(order, "doc_id").limit(fit_rows))
    rows = docs.select("doc_id", "text").where("text is not null")
    return durable(rows.join(F.broadcast(chosen), "doc_id").select("text", "y"))


def _mine(sample: DataFrame, voters: int, min_support: int) -> list[tuple[str, int]]:
    """Grams that separate the labels best, less those that another chosen gram implies."""
    totals = {r["y"]: r["n"] for r in sample.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(totals) < 2:
        return []

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            seen = {0: Counter(), 1: Counter()}
            for text, y in zip(frame["text"], frame["y"]):
                seen[int(y)].update(grams_of(text))
            keys = list(seen[0].keys() | seen[1].keys())
            yield pd.DataFrame({"gram": keys, "neg": [seen[0][k] for k in keys], "pos": [seen[1][k] for k in keys]})

    counts = sample.mapInPandas(count, "gram string, neg long, pos long").groupBy("gram").agg(
        F.sum("neg").alias("neg"), F.sum("pos").alias("pos")).where(F.col("pos") + F.col("neg") >= min_support)
    counts = durable(counts)
    share = totals[1] / (totals[0] + totals[1])
    # Log-likelihood ratio against the base rates; by chance about one gram of n reaches ln n.
    least = math.log(max(counts.count(), 1)) + 1.0

    def ratio(hits: str, misses: str, rate: float) -> Column:
        n = F.col("pos") + F.col("neg")
        return (F.col(hits) * F.log(F.col(hits) / (n * rate))
                + F.when(F.col(misses) > 0, F.col(misses) * F.log(F.col(misses) / (n * (1 - rate)))).otherwise(0.0))

    toxic = counts.where(F.col("pos") > (F.col("pos") + F.col("neg")) * share).withColumn(
        "gain", ratio("pos", "neg", share))
    clean = counts.where(F.col("neg") > (F.col("pos") + F.col("neg")) * (1 - share)).withColumn(
        "gain", ratio("neg", "pos", 1 - share))
    chosen: list[tuple[str, int]] = []
    for rows, side, most in ((toxic, 1, voters), (clean, -1, voters // 8)):
        kept: list[tuple[str, int]] = []
        for r in rows.where(F.col("gain") > least).orderBy(F.desc("gain"), "gram").limit(8 * voters).collect():
            gram, support = r["gram"], r["pos" if side > 0 else "neg"]
            bare = gram.strip("^+")
            implied = any((bare.startswith(k) or k.startswith(bare)) and support <= 1.05 * s for k, s in kept)
            if not implied and len(kept) < most:
                kept.append((bare, support))
                chosen.append((gram, side))
    return chosen


def _votes(text: str, index: dict[str, tuple[int | None, int | None]], size: int) -> np.ndarray:
    """Which of the ``size`` voters fire; ``index`` has the grams without their ``+``."""
    counts: Counter = Counter()
    words = Counter(WORD.findall(text.lower()))
    for w, c in words.items():
        if w in index:
            counts[w] += c
        for n in PREFIXES:
            if len(w) >= n and (p := "^" + w[:n]) in index:
                counts[p] += c
    total = sum(words.values())
    out = np.zeros(size)
    for g, c in counts.items():
        plain, dense = index[g]
        if plain is not None:
            out[plain] = 1
        if dense is not None and c * DENSE >= total:
            out[dense] = 1
    return out


def _index(grams: tuple[str, ...] | list[str]) -> dict[str, tuple[int | None, int | None]]:
    """Bare gram to the numbers of its plain and its dense voter."""
    at = {g: i for i, g in enumerate(grams)}
    return {g: (at.get(g), at.get(g + "+")) for g in {x.rstrip("+") for x in grams}}


def label_model(votes: np.ndarray, side: np.ndarray, y: np.ndarray, rounds: int = ROUNDS,
                trust: float = LABEL_TRUST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(posterior, accuracies, log odds of a firing voter) of 0/1 ``votes`` by EM.

    Each voter has a firing rate in either class.  Correlations are estimated
    on the residuals given the class; a voter's log odds are divided by the
    number of voters it effectively repeats, 1 + sum of positive correlations."""
    n, m = votes.shape
    prior = np.where(y == 1, trust, 1 - trust)
    post = prior.copy()
    odds = np.zeros(m)
    rate = np.zeros((2, m))
    for _ in range(rounds):
        weight = np.stack([1 - post, post])
        rate = (weight @ votes + 0.5) / (weight.sum(axis=1)[:, None] + 1.0)
        residual = votes - (post[:, None] * rate[1] + (1 - post[:, None]) * rate[0])
        deviation = np.sqrt((residual ** 2).sum(axis=0)) + 1e-9
        correlation = np.clip((residual.T @ residual) / np.outer(deviation, deviation), 0, 1)
        correlation[correlation < 0.2] = 0
        np.fill_diagonal(correlation, 1)
        same = side[:, None] == side[None, :]
        odds = np.log(rate[1] / rate[0]) / (correlation * same).sum(axis=1)
        evidence = votes @ odds
        post = 1 / (1 + np.exp(-np.clip(evidence + np.log(prior / (1 - prior)), -30, 30)))
    accuracy = np.where(side > 0, rate[1] / (rate[0] + rate[1]), rate[0] / (rate[0] + rate[1]))
    return post, accuracy, odds


def _shape(fired: np.ndarray, side: np.ndarray, accuracy: np.ndarray) -> np.ndarray:
    """Classifier inputs of one vote matrix: each voter, accuracy sums of each side, and the best toxic voter."""
    toxic, clean = fired * (side > 0), fired * (side < 0)
    best = (toxic * accuracy).max(axis=1) if fired.shape[1] else np.zeros(len(fired))
    return np.column_stack([fired, np.log1p(toxic @ accuracy), np.log1p(clean @ accuracy), best])


def _logistic(x: np.ndarray, target: np.ndarray, ridge: float = 1.0, steps: int = 30) -> tuple[np.ndarray, float]:
    """Ridge logistic regression on soft targets by Newton's method."""
    z = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(z.shape[1])
    penalty = np.full(z.shape[1], ridge)
    penalty[-1] = 1e-3
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        grad = z.T @ (p - target) + penalty * w
        hess = (z * (p * (1 - p))[:, None]).T @ z + np.diag(penalty + 1e-6)
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w[:-1], float(w[-1])


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, voters: int = VOTERS,
        min_support: int = MIN_SUPPORT) -> Model:
    """Mine voters, fit the label model and train the classifier on its posteriors.

    Without both labels in the sample, or without any separating gram, the
    model scores every text with the smoothed share of toxic labels."""
    sample = _sample(docs, labels, fit_rows)
    chosen = _mine(sample, voters, min_support)
    grams = [g for g, _ in chosen]
    index = _index(grams)

    def vote(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = [np.flatnonzero(_votes(t, index, len(grams))).tolist() for t in frame["text"]]
            yield pd.DataFrame({"fired": rows, "y": frame["y"]})

    rows = sample.mapInPandas(vote, "fired array<int>, y int").collect()  # at most fit_rows short lists
    y = np.array([r["y"] for r in rows], float)
    if not grams or not len(rows):
        share = (y.sum() + 0.5) / (len(y) + 2) if len(y) else 0.0
        share = min(max(share, 1e-6), 1 - 1e-6)
        return Model((), (), (), (0.0, 0.0, 0.0), float(np.log(share / (1 - share))))
    fired = np.zeros((len(rows), len(grams)))
    for i, r in enumerate(rows):
        fired[i, r["fired"]] = 1
    side = np.array([s for _, s in chosen])
    post, accuracy, _ = label_model(fired, side, y)
    weights, bias = _logistic(_shape(fired, side, accuracy), post)
    return Model(tuple(grams), tuple(int(s) for s in side), tuple(map(float, accuracy)),
                 tuple(map(float, weights)), bias)


def score(model: Model, text: Column) -> Column:
    """Score of every whole text in (0, 1); null counts as empty."""
    index, size = _index(model.grams), len(model.grams)
    side, accuracy = np.array(model.side, float), np.array(model.accuracy, float)
    weights, bias = np.array(model.weights), model.bias

    @F.pandas_udf("double")
    def run(texts: pd.Series) -> pd.Series:
        fired = np.zeros((len(texts), size))
        for i, t in enumerate(texts):
            if t:
                fired[i] = _votes(t, index, size)
        z = _shape(fired, side, accuracy) @ weights + bias
        return pd.Series(1 / (1 + np.exp(-np.clip(z, -30, 30))))

    return run(text)


def toxicity(docs: DataFrame, labels: DataFrame, **params) -> DataFrame:
    """``doc_id, held_out, score, predicted``: one row per input row.

    Null and empty texts fire no voter and get the base score.  A null doc_id
    is not held out and has no label.  A doc_id labelled twice is toxic if any
    label says so; repeated rows are scored one by one; other columns are not
    read; an empty table gives no rows, empty labels a base score near 0.
    """
    rows = docs.select("doc_id", score(fit(docs, labels, **params), F.col("text")).alias("score"))
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                       (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, **params) -> DataFrame:
    """The documents not predicted toxic, with all their columns; no shuffle."""
    return docs.where(score(fit(docs, labels, **params), F.col("text")) < 0.5)
