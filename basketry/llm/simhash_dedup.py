"""SimHash near-dedup with pivot distance tables.

1. Fingerprints: one pass over whole texts (Arrow batches).  Equal
   fingerprints collapse to one node, the smallest doc_id (map-side minimum).
2. Candidates: two fingerprints within ``distance`` bits agree on at least two
   of ``distance + 2`` bit blocks, so each node is keyed by every pair of
   blocks.  A key with more than ``SPLIT`` nodes is divided into node blocks
   and pairs of blocks, so a task never holds more than one such pair.
3. Inside a key, a table holds each fingerprint's Hamming distances to
   ``REFERENCES`` reference fingerprints.  By the triangle inequality a pair
   whose coordinates differ by more than ``distance`` anywhere is discarded;
   survivors are verified on the fingerprints themselves.
4. A key's links leave as a spanning star per cluster, never as all pairs;
   components are found by distributed contraction.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import durable, fresh, row_key, small, text_key
from basketry.llm.components import component_roots

SHINGLE = 4
DISTANCE = 4
REFERENCES = 16
SEED = 42
SPLIT = 2048
BITS = 64


def fingerprint(text: str | None, size: int = SHINGLE) -> int:
    """Unsigned 64-bit SimHash of the text's word shingles; zero without words."""
    words = text.encode("utf-8").lower().split() if text else []  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) <= size:
        return digest(b" ".join(words), SEED)
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = [0, *ends[:-1].tolist()]
    hashes = np.array([digest(line[a:b], SEED) for a, b in zip(starts, (ends[size - 1:] - 1).tolist())], np.uint64)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 65536):
        part = hashes[at:at + 65536].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """``doc_id, th, fp`` (the text's hash, and the 64 bits as a signed long) for every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = np.array([fingerprint(t.as_py(), size) for t in batch.column("text")], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("th"), pa.array(fp)],
                                             ["doc_id", "th", "fp"])

    return docs.select("doc_id", text_key().alias("th"), "text").mapInArrow(run, f"doc_id {kind}, th long, fp long")


def _block_masks(distance: int) -> list[int]:
    """Masks of every pair of the ``distance + 2`` bit blocks, as signed longs."""
    cuts = np.linspace(0, BITS, distance + 3).astype(int)
    blocks = [((1 << int(b - a)) - 1) << int(a) for a, b in zip(cuts, cuts[1:])]
    return [int(np.uint64(x | y).view(np.int64)) for x, y in combinations(blocks, 2)]


def _references(count: int) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(f"reference {i}", SEED) for i in range(count)], np.uint64)


def _linked(fp: np.ndarray, table: np.ndarray, i: int, others: np.ndarray, distance: int) -> np.ndarray:
    """Of ``others``, those within ``distance`` bits of ``i``: pivot filter, then the fingerprints."""
    gap = np.abs(table[others] - table[i]).max(axis=1)
    rest = others[gap <= distance]
    return rest[np.bitwise_count(fp[rest] ^ fp[i]) <= distance]


def cluster(fp: np.ndarray, references: np.ndarray, distance: int) -> np.ndarray:
    """Component number (smallest member's index) of each of the distinct fingerprints of one key.

    A node is compared with the nodes not yet in its component, from the
    smaller components only: a dense cluster costs one sweep, not all pairs."""
    n = len(fp)
    label = np.arange(n)
    if n < 2:
        return label
    table = np.bitwise_count(fp[:, None] ^ references[None, :]).astype(np.int16)

    def merge(i: int, others: np.ndarray) -> None:
        if len(others):
            joined = np.unique(np.append(label[others], label[i]))
            label[np.isin(label, joined)] = joined[0]

    merge(0, _linked(fp, table, 0, np.arange(1, n), distance))
    # Every link between two components has an end outside the largest one.
    counts = np.bincount(label, minlength=n)
    largest = counts.argmax()
    for i in np.flatnonzero(label != largest):
        merge(i, _linked(fp, table, i, np.flatnonzero(label != label[i]), distance))
    return label


def _edges(keyed: DataFrame, distance: int, references: int) -> DataFrame:
    """Spanning stars ``a, b`` of each key's clusters; rows come sorted by key."""
    refs = _references(references)

    def solve(part: pd.DataFrame) -> pd.DataFrame:
        group, node = part["group"].to_numpy(), part["node"].to_numpy()
        fp = part["fp"].to_numpy().view(np.uint64)
        cuts = np.flatnonzero(np.r_[True, group[1:] != group[:-1], True])
        a, b = [], []
        sizes = np.diff(cuts)
        two = cuts[:-1][sizes == 2]  # most groups: the same filter and check, all at once
        if len(two):
            near = np.abs(np.bitwise_count(fp[two, None] ^ refs).astype(np.int16)
                          - np.bitwise_count(fp[two + 1, None] ^ refs)).max(axis=1) <= distance
            two = two[near]
            two = two[np.bitwise_count(fp[two] ^ fp[two + 1]) <= distance]
            a.append(node[two]), b.append(node[two + 1])
        for s in np.flatnonzero(sizes > 2):
            at = slice(cuts[s], cuts[s + 1])
            label = cluster(fp[at], refs, distance)
            off = np.flatnonzero(label != np.arange(len(label)))
            a.append(node[at][label[off]]), b.append(node[at][off])
        return pd.DataFrame({"a": np.concatenate(a) if a else np.array([], np.int64),
                             "b": np.concatenate(b) if b else np.array([], np.int64)})

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for frame in frames:
            if not len(frame):
                continue
            frame = frame if rest is None else pd.concat([rest, frame], ignore_index=True)
            key = frame[["mask", "bits", "part"]].to_numpy()
            frame["group"] = np.cumsum(np.r_[False, (key[1:] != key[:-1]).any(axis=1)])
            cut = int(np.searchsorted(frame["group"], frame["group"].iloc[-1]))
            yield solve(frame.iloc[:cut])
            rest = frame.iloc[cut:].drop(columns="group")  # the last key may go on
        if rest is not None:
            yield solve(rest.assign(group=0))

    return keyed.mapInPandas(run, "a long, b long")


def near_links(nodes: DataFrame, distance: int = DISTANCE, references: int = REFERENCES) -> DataFrame:
    """Edges ``a, b`` that span the links among distinct ``(node, fp)`` rows."""
    masks = F.array(*[F.lit(m) for m in _block_masks(distance)])
    keyed = nodes.select("node", "fp", F.posexplode(masks).alias("mask", "m")).select(
        "node", "fp", "mask", F.col("fp").bitwiseAND(F.col("m")).alias("bits"))
    counted = keyed.groupBy("mask", "bits").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    keyed = keyed.join(counted, ["mask", "bits"])
    # n <= SPLIT: part 0 holds the key; else each pair of node blocks is a part.
    blocks = F.ceil(F.col("n") / SPLIT).cast("int")
    mine = F.pmod(F.xxhash64("fp"), blocks).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), blocks - 1),
                        lambda o: F.greatest(mine, o) * blocks + F.least(mine, o))
    keyed = keyed.select("node", "fp", "mask", "bits", F.explode(pairs).alias("part"))
    keyed = keyed.repartition("mask", "bits", "part").sortWithinPartitions("mask", "bits", "part", "fp")
    return _edges(keyed, distance, references)


def _labelled(docs: DataFrame, size: int, distance: int, references: int) -> DataFrame:
    """``doc_id, th, fp, root, component_id`` for every row; ``root`` names a component also where all its ids are null."""
    fps = durable(fingerprints(docs, size))
    groups = durable(fps.groupBy("fp").agg(F.min("doc_id").alias("first")).withColumnRenamed("fp", "node"))
    edges = near_links(groups.select("node", F.col("node").alias("fp")), distance, references)
    roots = component_roots(edges)
    labelled = durable(groups.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")))
    # A component or a fingerprint may hold a third of all rows: both sides of these joins lie in files,
    # so the smaller is broadcast when it fits and a skewed shuffle is split when it does not.
    row = F.lit(64)
    smallest = durable(labelled.groupBy("root").agg(F.min("first").alias("component_id")))
    by_node = durable(labelled.join(small(smallest, row), "root").select(F.col("node").alias("fp"), "root", "component_id"))
    return fps.join(small(by_node, row), "fp").select("doc_id", "th", "fp", "root", "component_id")


def simhash_components(docs: DataFrame, size: int = SHINGLE, distance: int = DISTANCE,
                       references: int = REFERENCES) -> DataFrame:
    """``doc_id, fingerprint, component_id``: one row per input row.

    Null and empty texts, and texts without words, have fingerprint zero and
    are linked like any other.  Equal fingerprints are linked; rows that
    repeat a doc_id are rows of their own, joined through their fingerprints.
    A null doc_id takes part but is never a component's id unless the whole
    component is null.  Other columns are not read; an empty table gives no rows.
    """
    return _labelled(docs, size, distance, references).select("doc_id", _hex(F.col("fp")).alias("fingerprint"), "component_id")


def _hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def simhash_dedup(docs: DataFrame, size: int = SHINGLE, distance: int = DISTANCE,
                  references: int = REFERENCES) -> DataFrame:
    """One document of each component, with all its columns: the row with the smallest doc_id.

    Of rows that repeat that doc_id in the component the one whose text has the smallest
    hash stays, and of equal rows any one.  A component with null doc_ids only keeps one
    of its rows too.  Null, empty and wordless texts are one component; very long texts
    are read whole; columns of any name pass through; an empty table gives no rows."""
    rows = _labelled(docs, size, distance, references).where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    id_, th, here = fresh(docs, "id", "th", "here")
    first = rows.groupBy("root", "component_id", "th").agg(F.count(F.lit(1)).alias("n")).groupBy("root", "component_id").agg(
        F.min(F.struct("th", "n")).alias("f"))
    keep = durable(first.select(F.coalesce(F.col("component_id").cast("string"), F.lit("")).alias(id_),
                                F.col("component_id").isNotNull().alias(here), F.col("f.th").alias(th),
                                (F.col("f.n") > 1).alias("again")))
    repeated = not keep.where("again").isEmpty()  # equal rows under one doc_id
    keyed = docs.withColumns(row_key(id_, th) | {here: F.col("doc_id").isNotNull()})
    kept = keyed.join(small(keep.drop("again"), F.lit(64)), [id_, here, th], "left_semi")
    kept = kept.dropDuplicates([id_, here, th]) if repeated else kept
    return kept.select(*[f"`{c}`" for c in docs.columns])
