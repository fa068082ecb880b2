"""Secret scans with a random forest that removes false positives.

Candidates are whole runs of ``MIN_LENGTH`` or more token characters with a digit
or with several changes between lower and upper case, every match of an issued key
format, the password of a URL's user part, what an authorisation scheme names, and
every value that is assigned to a credential's name, of any length and characters.
Each gets features of five kinds: its length, its character transitions (between
lower case, upper case, digit and other), the share a dictionary of the corpus'
ordinary words covers, path-like parts of it and of where it was found, and the
words beside it.  Values are judged whole, whatever their length.  A random forest trained on labelled findings
gives each candidate the probability that it is a secret.

Labelled findings are an input.  Where there are none, ``seed_findings`` labels
a bounded sample of the corpus' own candidates by rules of high precision
(issued key formats and credential assignments against card numbers, addresses,
versions, paths and words) and leaves what the rules do not settle unlabelled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import durable, whole_text

MIN_LENGTH = 16
NEAR = 40  # characters looked at on either side
FIT_FINDINGS = 20_000  # bound of the training sample
# A dictionary word makes up at least this share of the corpus' words of its lengths, so there are at most 400,000.
DICTIONARY_SHARE = 2.5e-6
DICTIONARY_LEAST = 3
TREES = 40
DEPTH = 8

RUN = re.compile(r"(?<![A-Za-z0-9+/_\-])[A-Za-z0-9+/_\-]{%d,}={0,2}" % MIN_LENGTH)
ASSIGN = re.compile(r"([A-Za-z][A-Za-z0-9_.\-]{0,30})[\"']?\s{0,3}(?:=|:|=>|:=)\s{0,3}[\"']?$")
# Names under which credentials are given, and words that mark examples.
CREDENTIAL = re.compile(r"(?i)pass(?:word|wd|phrase)?|pwd|secret|token|api_?key|access_?key|auth|credential|private_?key")
# A quoted value ends at its quote or line, another at a space or before the next assignment.
ASSIGNED = re.compile(
    r"(?:" + CREDENTIAL.pattern.replace("(?i)", "(?i:") + r"))[A-Za-z0-9_.\-]{0,30}[\"']?\s{0,3}(?:=>|:=|={1,3}|:)\s{0,3}"
    r"(?:\"([^\"\n]+)|'([^'\n]+)|([^\s\"'](?:(?![&,;][A-Za-z_][\w.\-]{0,40}\s{0,3}[=:])\S)*))")
EXAMPLE = re.compile(r"(?i)example|sample|dummy|test|fake|placeholder|xxxx|your|changeme|fixture|mock")
ISSUED = re.compile(r"(?:AKIA|ASIA)[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9\-]{10,}|"
                    r"sk_live_[A-Za-z0-9]{16,}|AIza[A-Za-z0-9_\-]{35}|glpat-[A-Za-z0-9_\-]{20,}|npm_[A-Za-z0-9]{36}|"
                    r"SG\.[A-Za-z0-9_\-]{16,}\.[A-Za-z0-9_\-]{16,}|hf_[A-Za-z0-9]{30,}")
# The password of scheme://user:password@host, and what follows an authorisation scheme.
USER_INFO = re.compile(r"[A-Za-z][A-Za-z0-9+.\-]{0,30}://[^\s/?#:@]{0,200}:([^\s/?#@]+)@")
SCHEME = re.compile(r"\b(?:Bearer|Basic)\s{1,3}([A-Za-z0-9._~+/\-]{8,}={0,2})")
CASE_CHANGES = re.compile(r"[a-z][A-Z]")
PLAIN = re.compile(r"[0-9+\-/_]+|[A-Za-z]+[0-9]{1,4}|v?[0-9]+(?:[._\-][0-9a-z]+)*|"
                   r"[0-9a-fA-F]{8}-(?:[0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}|(?:/?[A-Za-z_\-]{2,}/)+[A-Za-z0-9_\-]*")
WORDS = re.compile(r"[^\W\d_]{3,}")
FEATURES = ["length", "lower", "upper", "digit", "other", "changes", "to_digit", "to_lower", "to_upper", "runs",
            "distinct", "entropy", "hex", "dictionary", "slashes", "path_before", "address", "found_in_example",
            "example", "assigned", "quoted", "credential_before", "credential_near", "words_near", "alone"]


def _classes(value: str) -> np.ndarray:
    """Class of each character: 0 lower, 1 upper, 2 digit, 3 other."""
    b = np.frombuffer(value.encode("utf-8"), np.uint8)
    return np.select([(b >= 97) & (b <= 122), (b >= 65) & (b <= 90), (b >= 48) & (b <= 57)], [0, 1, 2], 3)


def coverage(value: str, words: frozenset[str]) -> float:
    """Share of the characters that dictionary words of four or more letters cover, longest first."""
    low, at, covered = value.lower(), 0, 0
    while at < len(low):
        size = next((n for n in range(min(12, len(low) - at), 3, -1) if low[at:at + n] in words), 0)
        covered += size
        at += size or 1
    return covered / max(1, len(low))


def features(value: str, before: str, after: str, path: str, words: frozenset[str]) -> list[float]:
    c = _classes(value)
    n = len(c)
    share = [float((c == k).mean()) for k in range(4)]
    change = c[1:] != c[:-1]
    into = [float((change & (c[1:] == k)).mean()) if n > 1 else 0.0 for k in (2, 0, 1)]
    _, counts = np.unique(np.frombuffer(value.encode("utf-8"), np.uint8), return_counts=True)
    p = counts / n
    near = WORDS.findall(before) + WORDS.findall(after)
    key = ASSIGN.search(before)
    return [float(n), *share, float(change.mean()) if n > 1 else 0.0, *into, float(change.sum() + 1),
            len(counts) / n, float(-(p * np.log2(p)).sum()), float(bool(re.fullmatch(r"[0-9a-fA-F]+", value))),
            coverage(value, words), value.count("/") / n, float(before.endswith(("/", ".", "\\"))),
            float(before.endswith("@") or after.startswith(("@", "."))), float(bool(EXAMPLE.search(path))),
            float(bool(EXAMPLE.search(value) or EXAMPLE.search(before))), float(bool(key)),
            float(before[-1:] in "\"'" and after[:1] in "\"'" and bool(before)),
            float(bool(key and CREDENTIAL.search(key[1]))), float(bool(CREDENTIAL.search(before))),
            float(len(near)), float(not before.strip() and not after.strip())]


def rule_label(value: str, before: str, after: str, path: str) -> int | None:
    """1 or 0 where a rule of high precision decides, else None."""
    if EXAMPLE.search(value) or EXAMPLE.search(path):
        return 0
    if ISSUED.fullmatch(value):
        return 1
    key = ASSIGN.search(before)
    given = bool(key and CREDENTIAL.search(key[1]))
    if given and (len(value) < MIN_LENGTH and PLAIN.fullmatch(value) or not re.search("[0-9]", value)
                  or re.search(r"\s", value)):
        return None  # a short or worded password looks like text: the forest decides
    if before.endswith("@") or after.startswith("@") or PLAIN.fullmatch(value):
        return 0
    if given and len(set(value)) >= 8:
        return 1
    return None


def spans_of(text: str) -> list[tuple[int, int]]:
    """(start, end) of every candidate of a text, in order and each once."""
    found = {m.span() for m in RUN.finditer(text)
             if any(ch.isdigit() for ch in m.group()) or len(CASE_CHANGES.findall(m.group())) > 1}
    found.update(m.span() for m in ISSUED.finditer(text))
    found.update(m.span(1) for m in USER_INFO.finditer(text))
    found.update(m.span(1) for m in SCHEME.finditer(text))
    for m in ASSIGNED.finditer(text):
        start, end = m.span(m.lastindex)
        if m.lastindex == 3:  # punctuation of the sentence or the syntax around it
            end = start + (len(m[3].rstrip(",;.)]}>\"'")) or len(m[3]))
        found.add((start, end))
    return sorted(found)


def candidates(docs: DataFrame, path_column: str = "source") -> DataFrame:
    """``doc_id, start, value, before, after, path``: every candidate of every whole text.

    ``start`` counts characters; ``path`` names where the text was found."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    path = F.col(path_column).cast("string") if path_column in docs.columns else F.lit("")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for doc, text, where in zip(frame["doc_id"], frame["text"], frame["path"]):
                for start, end in spans_of(text or ""):
                    out.append((doc, start, text[start:end], text[max(0, start - NEAR):start],
                                text[end:end + NEAR], where))
            yield pd.DataFrame(out, columns=["doc_id", "start", "value", "before", "after", "path"])

    rows = docs.select("doc_id", "text", F.coalesce(path, F.lit("")).alias("path"))
    return rows.mapInPandas(run, f"doc_id {kind}, start long, value string, before string, after string, path string")


def seed_findings(found: DataFrame, limit: int = FIT_FINDINGS) -> DataFrame:
    """``value, before, after, path, is_secret``: at most ``limit`` rule-labelled candidates, in a hash order."""
    order = F.xxhash64("value", "before")
    sample = durable(found.select("value", "before", "after", "path").distinct()
                     .orderBy(order, "value", "before", "after", "path").limit(limit))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            label = [rule_label(*row) for row in zip(*(frame[c] for c in ("value", "before", "after", "path")))]
            yield frame.assign(is_secret=pd.array(label, "Int32"))

    return sample.mapInPandas(run, "value string, before string, after string, path string, is_secret int").where(
        "is_secret is not null")


def dictionary(docs: DataFrame, share: float = DICTIONARY_SHARE) -> frozenset[str]:
    """The corpus' ordinary words of 4 to 12 letters: those that make up at least ``share`` of all such words.

    Every whole text is counted (map-side first); a share bounds the dictionary to 1 / share words."""
    word = F.explode(F.split(F.lower(whole_text()), r"[^\p{L}]+")).alias("word")
    counts = durable(docs.select(word).where("length(word) between 4 and 12").groupBy("word").agg(
        F.count(F.lit(1)).alias("n")).where(F.col("n") >= DICTIONARY_LEAST))
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    return frozenset(r["word"] for r in counts.where(F.col("n") >= share * total).select("word").toLocalIterator())


def _featured(rows: DataFrame, words: frozenset[str]) -> DataFrame:
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            values = [features(*row, words) for row in zip(*(frame[c] for c in ("value", "before", "after", "path")))]
            yield frame.assign(features=values)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInPandas(run, schema + ", features array<double>")


def fit(labelled: DataFrame, words: frozenset[str], trees: int = TREES, depth: int = DEPTH, seed: int = 11
        ) -> RandomForestClassificationModel | float:
    """The forest; with fewer than two labels, the share of secrets instead of a forest."""
    rows = labelled.select("value", "before", "after", "path", F.col("is_secret").cast("int").alias("is_secret"))
    x = durable(_featured(rows, words).select(array_to_vector("features").alias("x"),
                                              F.col("is_secret").cast("double").alias("y")).coalesce(1))
    labels = {r["y"]: r["n"] for r in x.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(labels) < 2:
        return next(iter(labels), 0.0)
    forest = RandomForestClassifier(featuresCol="x", labelCol="y", numTrees=trees, maxDepth=depth, seed=seed,
                                    probabilityCol="p", featureSubsetStrategy="sqrt")
    return forest.fit(x)


def scan(docs: DataFrame, labelled: DataFrame | None = None, path_column: str = "source",
         threshold: float = 0.5, **params) -> DataFrame:
    """``doc_id, start, n_chars, value_sha256, before, probability, is_secret``: one row per candidate.

    The values themselves are not returned.  Null and empty texts have no
    candidates; a null path is empty; rows that repeat a doc_id or a value are
    scanned one by one; other columns are not read; an empty table gives no
    rows.  Without usable labels the probability is the share of secrets among
    the labelled findings (0 when there are none).
    """
    found = durable(candidates(docs, path_column))
    words = dictionary(docs)
    model = fit(seed_findings(found) if labelled is None else labelled, words, **params)
    rows = _featured(found, words)
    probability: Column = F.lit(float(model)) if isinstance(model, float) else vector_to_array("p")[1]
    if not isinstance(model, float):
        rows = model.transform(rows.withColumn("x", array_to_vector("features")))
    return rows.select(
        "doc_id", "start", F.length("value").cast("long").alias("n_chars"), F.sha2("value", 256).alias("value_sha256"),
        "before", probability.alias("probability")).withColumn("is_secret", F.col("probability") >= threshold)

