"""A training-corpus pipeline over ``documents``: five stages, each one operator of ``basketry.llm``.

Every stage works on all that its predecessor kept.  ``run`` writes a stage's
result as Parquet in the shared checkpoint folder and reads it again, so a
lost executor never repeats an earlier stage; a result is deleted once the next
one is written.  Nulls, empty and very long texts, repeated rows, null doc_ids and
columns of any name pass through every stage as its docstring says; an empty table
gives an empty result.
"""

from __future__ import annotations

import functools
import uuid

from pyspark.sql import DataFrame, SparkSession

from basketry.llm.common import table
from basketry.llm.decontaminate import decontaminate
from basketry.llm.mixing import mix_sources
from basketry.llm.sharding import sharded
from basketry.llm.simhash_dedup import simhash_dedup
from basketry.llm.toxicity import drop_toxic
from basketry.plans.physical import delete_path
from basketry.session import ensure_checkpoint_dir, local_scratch

# Most uses of a document, those of the scarcest source, against one use in the fullest.
REPEATS = 2.0


def _stage(step):
    """A stage may run on its own, so each makes sure of the checkpoint folder."""
    @functools.wraps(step)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        local_scratch(spark)
        return step(spark, docs, sf_dir)
    return run_stage


@_stage
def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects as toxic go.  Null and empty texts get the base score."""
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


@_stage
def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays, the one with the smallest doc_id.

    All texts without words are one component, and so are repeated rows."""
    return simhash_dedup(docs)


@_stage
def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item's window go.  Null and empty texts hold none."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


@_stage
def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are mixed to flattened weights: every document is used once, those of scarce sources up to twice.

    Documents without tokens, and of a null source, are used like others."""
    return mix_sources(docs, repeats=REPEATS, keep_all=True)


@_stage
def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows get ``shard`` and ``slot`` along the Hilbert curve, and are laid out so.

    Null metadata sorts as the empty string."""
    return sharded(docs)


STAGES = [
    ("toxicity", toxicity_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("sharding", sharding_stage),
]

# The classifier, the fingerprints (XXH64) and the curve are not SQL; the tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    local_scratch(spark)
    folder = f"{ensure_checkpoint_dir(spark)}/corpus-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for at, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{at}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if at:
            delete_path(spark, before)
        before = path
    return docs
