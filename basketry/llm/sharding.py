"""Sharding along a Hilbert curve over several metadata dimensions.

Each dimension (language, source, text size) is quantised by rank: a value's cell
is the part of the rows that lie below its middle row, taken from exact counts per
whole value.  The cells are put on a Hilbert curve.  Sorting by curve index and
cutting equal runs gives files whose min/max statistics prune on every dimension
at once.

The global rank needs no single-task window: a range partitioning by
(curve index, doc_id, ...) is sorted per partition, and the partitions' row
counts (one row per partition) give the offsets.  Ties and hot cells are split
by the further sort columns, so a cell with a third of all rows spreads over
many partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm.common import durable, fresh, small, utf8, whole_text

SHARDS = 16
BITS = 4
DIMENSIONS = ("lang", "source", "size")


def _cells(base: DataFrame, name: str, bits: int) -> DataFrame:
    """``value, cell`` of one dimension: cell in [0, 2^bits) by the rank of the value's middle row.

    Values are counted map-side first and cumulated over a range sort, so neither a
    hot value nor many different ones meet in one task."""
    counts = base.groupBy(F.col(f"dim_{name}").alias("value")).agg(F.count(F.lit(1)).alias("n"))
    runs = durable(counts.repartitionByRange("value").select("*", F.spark_partition_id().alias("run")))
    per_run = runs.groupBy("run").agg(F.sum("n").alias("rows"))
    offsets = per_run.select("run", F.coalesce(F.sum("rows").over(
        Window.orderBy("run").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("offset"),
        F.sum("rows").over(Window.partitionBy()).alias("total"))  # a row per partition
    inside = Window.partitionBy("run").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    below = F.col("offset") + F.coalesce(F.sum("n").over(inside), F.lit(0))
    return durable(runs.join(F.broadcast(offsets), "run").select("value", "n", "total", below.alias("below")).select(
        "value", F.expr(f"cast((2 * below + n) * {2 ** bits} div (2 * total) as long)").alias("cell")))


def _quantised(base: DataFrame, names: list[str], bits: int) -> DataFrame:
    """Add ``cell_<name>`` for each ``dim_<name>``."""
    for n in names:
        cells = _cells(base, n, bits).toDF(f"dim_{n}", f"cell_{n}")
        width = F.octet_length(F.col(f"dim_{n}").cast("string")) + 48
        base = base.join(small(cells, width), f"dim_{n}")
    return base


def hilbert_index(df: DataFrame, axes: list[str], bits: int, out: str) -> DataFrame:
    """Add the Hilbert curve index of the integer columns ``axes``.

    The published axes-to-transpose transform, one bit plane at a time: undo
    the excess rotations from the high bit down, Gray-encode, and interleave."""
    n = len(axes)
    x = [f"__x{i}" for i in range(n)]
    df = df.withColumns({x[i]: F.col(a).cast("long") for i, a in enumerate(axes)})
    for plane in range(bits - 1, 0, -1):
        low = F.lit((1 << plane) - 1)
        for i in range(n):
            on = F.col(x[i]).bitwiseAND(F.lit(1 << plane)) != 0
            if i == 0:
                df = df.withColumn(x[0], F.when(on, F.col(x[0]).bitwiseXOR(low)).otherwise(F.col(x[0])))
                continue
            swap = F.col(x[0]).bitwiseXOR(F.col(x[i])).bitwiseAND(low)
            df = df.withColumns({
                x[0]: F.col(x[0]).bitwiseXOR(F.when(on, low).otherwise(swap)),
                x[i]: F.when(on, F.col(x[i])).otherwise(F.col(x[i]).bitwiseXOR(swap))})
    for i in range(1, n):
        df = df.withColumn(x[i], F.col(x[i]).bitwiseXOR(F.col(x[i - 1])))
    turn = F.lit(0).cast("long")
    for plane in range(bits - 1, 0, -1):
        bit = F.col(x[n - 1]).bitwiseAND(F.lit(1 << plane)) != 0
        turn = turn.bitwiseXOR(F.when(bit, F.lit((1 << plane) - 1)).otherwise(F.lit(0)).cast("long"))
    df = df.withColumn("__turn", turn)
    index = F.lit(0).cast("long")
    for plane in range(bits):
        for i in range(n):
            bit = F.shiftright(F.col(x[i]).bitwiseXOR(F.col("__turn")), plane).bitwiseAND(F.lit(1))
            index = index + F.shiftleft(bit, plane * n + (n - 1 - i))
    return df.withColumn(out, index).drop("__turn", *x)


def hilbert_shards(docs: DataFrame, shards: int = SHARDS, bits: int = BITS,
                   dimensions: tuple[str, ...] = DIMENSIONS) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard, hilbert, cell_*``.

    One row per input row, law ``rows``: the curve is cut into ``shards`` runs
    whose row counts differ by at most one; ``slot`` counts from 0 along the
    curve inside a shard.  ``size`` is the UTF-8 bytes of the text plus 1 (null
    text: 1).  Null metadata sorts as the empty string; rows that tie in the
    curve index go by doc_id, checksum and size, so equal rows are neighbours
    and interchangeable.  An empty table gives no rows; with fewer rows than
    shards some shards stay empty.  Texts are read whole, whatever their length; other
    columns are not read.
    """
    names = list(dimensions)
    size = (F.octet_length(whole_text()) + 1).cast("long")
    dims = [(size if n == "size" else F.coalesce(F.col(n).cast("string"), F.lit(""))).alias(f"dim_{n}") for n in names]
    base = durable(docs.select("doc_id", size.alias("size"), F.crc32(utf8(whole_text())).alias("text_crc32"), *dims))
    cells = [f"cell_{n}" for n in names]
    cut = hilbert_index(_quantised(base, names, bits), cells, bits, "hilbert").select(
        "doc_id", "size", "text_crc32", "hilbert", *cells)
    order = ["hilbert", "doc_id", "text_crc32", "size"]
    runs = durable(cut.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "*", F.spark_partition_id().alias("run"),
        F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("at")))
    before = Window.orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    per_run = runs.groupBy("run").agg(F.count(F.lit(1)).alias("n"))
    # One row per partition: the only frame that meets in one task.
    offsets = per_run.select("run", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"),
                             F.sum("n").over(Window.partitionBy()).alias("total"))
    rank = F.col("offset") + F.col("at")
    ranked = runs.join(F.broadcast(offsets), "run").withColumn("rank", rank).withColumn(
        "shard", F.expr(f"cast((rank * {shards}) div total as int)"))
    first = F.expr(f"(shard * total + {shards - 1}) div {shards}")
    return ranked.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
        (F.col("rank") - first).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
        "hilbert", *cells)


def sharded(docs: DataFrame, **params) -> DataFrame:
    """All documents with their ``shard`` and ``slot``, laid out in curve order.

    Rows that agree in doc_id, checksum and size take the group's slots in any
    order.  Columns named ``shard`` or ``slot`` are replaced; others of any name pass
    through.  Null texts are empty, null metadata sorts as the empty string; an empty
    table gives no rows."""
    docs = docs.drop("shard", "slot")
    id_, crc, size, at, n = fresh(docs, "id", "crc", "size", "at", "n")
    key = [id_, crc, size]
    doc_id = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    slots = hilbert_shards(docs, **params).groupBy(
        doc_id.alias(id_), F.col("text_crc32").alias(crc), F.col("size").alias(size)
    ).agg(F.collect_list(F.struct("shard", "slot")).alias(at))  # one entry, but for repeated rows
    rows = docs.withColumns({id_: doc_id, crc: F.crc32(utf8(whole_text())),
                             size: (F.octet_length(whole_text()) + 1).cast("long")})
    rows = rows.withColumn(n, F.row_number().over(Window.partitionBy(*key).orderBy(id_)))
    mine = F.col(at)[F.col(n) - 1]
    out = rows.join(slots, key).select(*[f"`{c}`" for c in docs.columns], mine["shard"].alias("shard"),
                                       mine["slot"].alias("slot"))
    return out.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")


def write_shards(docs: DataFrame, path: str, **params) -> None:
    """Write the documents as one Parquet folder per shard, in curve order."""
    sharded(docs, **params).write.partitionBy("shard").parquet(path)
