"""Helpers shared by the training-data operators.

``durable`` is the one way an operator cuts lineage: a reliable checkpoint in
the shared folder named by ``spark.checkpoint.dir``.  ``small`` guards every
broadcast the operators ask for themselves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.session import ensure_checkpoint_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# Largest side an operator broadcasts, in bytes, after measuring it.
BROADCAST_BYTES = 32 * 1024 * 1024


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def durable(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder and cut its lineage."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def small(df: DataFrame, row_bytes: Column, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast hint when the measured bytes of ``df`` fit ``limit``; else as it is.

    ``df`` should be durable: it is summed once here and read again by the join."""
    return F.broadcast(df) if fits(df, row_bytes, limit) else df


def fits(df: DataFrame, row_bytes: Column, limit: int = BROADCAST_BYTES) -> bool:
    used = df.agg(F.coalesce(F.sum(row_bytes.cast("long")), F.lit(0))).first()[0]
    return used <= limit


def ascii_lower(col: Column) -> Column:
    """Lower-case A-Z only; every other character stays."""
    return F.translate(col, UPPER, UPPER.lower())


def whole_text(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def utf8(col: Column) -> Column:
    return col.cast("binary")


def text_key(col: str = "text") -> Column:
    """Second half of a row key, for tables that repeat a doc_id with other text."""
    return F.xxhash64(whole_text(col))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each lengthened until no column of ``df`` has it in any case."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def row_key(id_name: str = "id", hash_name: str = "th") -> dict[str, Column]:
    """Non-null key columns of a row: its doc_id as text (null: empty) and its text's hash."""
    return {id_name: F.coalesce(F.col("doc_id").cast("string"), F.lit("")), hash_name: text_key()}
