"""Physical knobs shared by the operators: measured broadcasts, checkpoints,
partition counts.

A side is broadcast only after its bytes were measured by an action; otherwise
the planner shuffles (and AQE may still switch strategies at run time).
"""

from __future__ import annotations

import math
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from basketry.session import ensure_checkpoint_dir

# What a hash relation adds to the columns' own bytes, per row.
ROW_OVERHEAD = 32


@dataclass(frozen=True)
class Tuning:
    # Largest measured byte size of a side the library broadcasts itself.
    broadcast_bytes: int = 64 * 1024 * 1024
    # Target rows per partition of the pair and occurrence tables.
    rows_per_partition: int = 4_000_000
    # Baskets with more frequent items than this are joined in blocks of this size.
    hot_basket_items: int = 4096
    # Fixed partition count for the pair table (None: derived from its size).
    partitions: int | None = None
    # Database of the bucketed tables of a run (None: the session's current one).
    database: str | None = None
    # Most buckets of the hashed pair count of level 2 (0: never count pairs by hash).
    pair_buckets: int = 1 << 24
    # Bits for each candidate in the filter before a shuffled candidate join (0: no filter).
    candidate_bits: int = 12
    # Pairs of items in baskets from which equal baskets are merged, where that halves them at least (0: never).
    merge_from: int = 4_000_000


DEFAULT_TUNING = Tuning()


def text_bytes(*columns: str) -> Column:
    """Bytes of a row's text columns in a hash relation."""
    out = F.lit(ROW_OVERHEAD)
    for c in columns:
        out = out + F.octet_length(c)
    return out


def measured(df: DataFrame, row_bytes: Column) -> int:
    """Bytes of a frame, by one small aggregate."""
    return int(df.agg(F.coalesce(F.sum(row_bytes.cast("long")), F.lit(0))).first()[0])


def maybe_broadcast(df: DataFrame, n_bytes: int, tuning: Tuning) -> DataFrame:
    """Broadcast hint only when the measured bytes fit the budget."""
    return F.broadcast(df) if n_bytes <= tuning.broadcast_bytes else df


def stable(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in ``spark.checkpoint.dir`` and cut its lineage.

    The files are on shared storage, so a lost executor costs no earlier step."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def observed(df: DataFrame, **metrics: Column) -> tuple[DataFrame, dict]:
    """``stable``, and aggregates of its rows taken while they were written, without a job of their own."""
    seen = Observation()
    out = stable(df.observe(seen, *[m.alias(name) for name, m in metrics.items()]))
    return out, seen.get


def bucketed(df: DataFrame, parts: int, key: str, tuning: Tuning = DEFAULT_TUNING, path: str | None = None) -> DataFrame:
    """Materialise ``df`` as a table in ``parts`` buckets of ``key``, under ``spark.checkpoint.dir`` or at ``path``.

    Two such tables join on ``key`` without an exchange, under adaptive
    execution as well.  A frame that is in these partitions already is written
    as it lies, one file a bucket."""
    name = f"basketry_{uuid.uuid4().hex}"
    path = path or f"{ensure_checkpoint_dir(df.sparkSession)}/{name}"
    name = f"{tuning.database}.{name}" if tuning.database else name
    df.write.mode("overwrite").bucketBy(parts, key).sortBy(key).option("path", path).saveAsTable(name)
    return _table(df.sparkSession, name, path)


def bucketed_again(spark, path: str, schema: str, parts: int, key: str, tuning: Tuning = DEFAULT_TUNING) -> DataFrame:
    """The table that ``bucketed`` wrote at ``path`` in an earlier session."""
    name = f"basketry_{uuid.uuid4().hex}"
    name = f"{tuning.database}.{name}" if tuning.database else name
    spark.sql(f"CREATE TABLE {name} ({schema}) USING parquet CLUSTERED BY ({key}) SORTED BY ({key}) INTO {parts} BUCKETS "
              f"LOCATION '{path}'")
    return _table(spark, name, path)


def _table(spark, name: str, path: str) -> DataFrame:
    out = spark.table(name)
    out._basketry_table = (name, path)
    return out


def release(*frames: DataFrame | None) -> None:
    """Delete the files of frames made by ``stable`` or ``bucketed`` that nothing reads any more."""
    for df in frames:
        if df is None:
            continue
        if table := getattr(df, "_basketry_table", None):
            df.sparkSession.sql(f"DROP TABLE IF EXISTS {table[0]}")
            file = table[1]
        else:
            plan = df._jdf.queryExecution().logical()
            found = plan.rdd().getCheckpointFile() if plan.getClass().getSimpleName() == "LogicalRDD" else None
            file = found.get() if found is not None and found.isDefined() else None
        if file is not None:
            delete_path(df.sparkSession, file)


def delete_path(spark, file: str) -> None:
    """Delete a file or folder of any file system that Spark reads."""
    sc = spark.sparkContext
    path = sc._jvm.org.apache.hadoop.fs.Path(file)
    path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def partition_count(spark, n_rows: int, tuning: Tuning) -> int:
    if tuning.partitions:
        return tuning.partitions
    floor = spark.sparkContext.defaultParallelism
    return max(floor, int(math.ceil(n_rows / tuning.rows_per_partition)))
