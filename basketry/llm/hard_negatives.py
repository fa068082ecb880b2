"""Hard-negative mining over an inverted multi-index.

1. Codebooks: each vector is two halves.  K-means over a bounded sample of at most
   ``FIT_ROWS`` rows gives ``CENTRES`` centres a half.  Every row gets the cell (i, j)
   of its halves' nearest centres, and each centre the largest distance of a row.
2. Index: rows are range-partitioned by cell, so a task holds a run of cells, in
   chunks of at most ``CHUNK_ROWS`` rows.  Queries go to all tasks in blocks of at
   most ``QUERY_ROWS`` rows: a stated query set against all rows.
3. Search, per query and chunk: the product with a half is at most the product with
   its centre plus the half query's length times the centre's radius (at least: minus
   it).  A heap walks the two lists of half bounds, best sum first (multi-sequence),
   so cells come in the order of what they can hold at most.  A visit ends once as
   many rows as wanted beat every cell to come; with a window of scores, cells that lie
   above or below it are passed over.  That end is a proof, so results are exact.
4. Positives first, then the window of each positive for the negatives: two such
   searches, each followed by a top-k over the chunks' few rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm.common import durable

CENTRES = 24
FIT_ROWS = 20_000
FIT_ROUNDS = 8
SEED_ROWS = 4_096
CHUNK_ROWS = 65_536
PARTITION_ROWS = 16_384
QUERY_ROWS = 8_192
POSITIVES = 5
NEGATIVES = 10
# A negative's score, in percent of the positive's.
LOW, HIGH = 30, 90


# ---------------------------------------------------------------- codebooks
def fit_centres(half: np.ndarray, centres: int, rounds: int = FIT_ROUNDS) -> np.ndarray:
    """Centres of a half's sample: Lloyd rounds from farthest-first starts."""
    centres = min(centres, len(np.unique(half, axis=0)))
    out = half[:1]
    gap = ((half - out[0]) ** 2).sum(axis=1)
    for _ in range(centres - 1):
        out = np.vstack([out, half[gap.argmax()]])
        gap = np.minimum(gap, ((half - out[-1]) ** 2).sum(axis=1))
    for _ in range(rounds):
        near = nearest(half, out)[0]
        sums = np.zeros_like(out)
        np.add.at(sums, near, half)
        n = np.bincount(near, minlength=len(out))
        out = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], out)
    return out


def nearest(half: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centre of each row, and its distance (a little more, against rounding)."""
    near = np.argmin((centres ** 2).sum(axis=1) - 2 * half @ centres.T, axis=1)
    return near, np.sqrt(((half - centres[near]) ** 2).sum(axis=1)) * (1 + 1e-9) + 1e-6


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column as a matrix, shorter rows filled up with zeros."""
    flat = np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64)
    sizes = np.asarray(column.value_lengths().to_numpy(zero_copy_only=False), np.int64)
    if len(flat) == len(column) * width:
        return flat.reshape(len(column), width)
    out = np.zeros((len(column), width))
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def valid_vectors(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """``vec_id, label, v``: rows that take part, components ``floor(scale * x)``."""
    v = F.col("embedding").cast("array<double>")
    whole = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & v.isNotNull() & F.coalesce(
        F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))), F.lit(False))
    return vectors.where(whole).select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
                                       F.transform(v, lambda x: F.floor(x * F.lit(float(scale))).cast("double")).alias("v"))


class Index:
    """The placed rows of a table and what a search needs to know of the cells."""

    def __init__(self, rows: DataFrame, centres: int = CENTRES, fit_rows: int = FIT_ROWS,
                 partition_rows: int = PARTITION_ROWS) -> None:
        rows = durable(rows.select("vec_id", "label", "v"))
        self.n, self.width = rows.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
        self.books: list[np.ndarray] = []
        self.seeds: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None
        if not self.n:
            self.rows = rows
            return
        # The rows of smallest hash: at most fit_rows, the same on every run.
        order = F.xxhash64("vec_id", "v")
        sample = rows.orderBy(order, "vec_id").limit(fit_rows).toArrow()
        points = _matrix(sample.column("v").combine_chunks(), self.width)
        self.seeds = (sample.column("vec_id").to_numpy()[:SEED_ROWS], sample.column("label").to_numpy()[:SEED_ROWS],
                      points[:SEED_ROWS])
        cut = (self.width + 1) // 2
        self.cut = cut
        self.books = [fit_centres(points[:, :cut], centres), fit_centres(points[:, cut:], centres)]
        books, width = self.books, self.width

        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                m = _matrix(batch.column("v"), width)
                (a, ra), (b, rb) = nearest(m[:, :cut], books[0]), nearest(m[:, cut:], books[1])
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in ("vec_id", "label", "v")), pa.array(a.astype(np.int32)),
                     pa.array(b.astype(np.int32)), pa.array(ra), pa.array(rb)],
                    ["vec_id", "label", "v", "a", "b", "ra", "rb"])

        placed = rows.mapInArrow(place, "vec_id long, label long, v array<double>, a int, b int, ra double, rb double")
        parts = max(rows.sparkSession.sparkContext.defaultParallelism, -(-self.n // partition_rows))
        # vec_id behind the cell: a cell that holds a third of all rows spreads too.
        self.rows = durable(placed.repartitionByRange(parts, "a", "b", "vec_id").sortWithinPartitions("a", "b"))
        self.radii = [np.zeros(len(b)) for b in books]
        for half, (at, r) in enumerate((("a", "ra"), ("b", "rb"))):
            for row in self.rows.groupBy(at).agg(F.max(r).alias("r")).collect():  # a row per centre
                self.radii[half][row[at]] = row["r"]


# ---------------------------------------------------------------- search
class Chunk:
    """Rows of one chunk by cell."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, m: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
        at = np.lexsort((ids, b, a))
        self.ids, self.labels, self.m = ids[at], labels[at], m[at]
        key = a[at].astype(np.int64) << 32 | b[at]
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        self.cells = {(int(k >> 32), int(k & 0xFFFFFFFF)): (s, e)
                      for k, s, e in zip(key[first], first, np.r_[first[1:], len(key)])}
        self.halves = np.unique(a), np.unique(b)


def cells_by_bound(upper: tuple[np.ndarray, np.ndarray], halves: tuple[np.ndarray, np.ndarray]) -> Iterator[tuple[float, int, int]]:
    """``(bound, i, j)`` of all pairs of half centres, largest summed bound first (multi-sequence heap)."""
    order = [h[np.argsort(-u[h], kind="stable")] for u, h in zip(upper, halves)]
    lists = [u[o].tolist() for u, o in zip(upper, order)]
    order = [o.tolist() for o in order]
    heap = [(-(lists[0][0] + lists[1][0]), 0, 0)]
    while heap:
        bound, x, y = heapq.heappop(heap)
        yield -bound, order[0][x], order[1][y]
        if y + 1 < len(order[1]):
            heapq.heappush(heap, (-(lists[0][x] + lists[1][y + 1]), x, y + 1))
        if y == 0 and x + 1 < len(order[0]):
            heapq.heappush(heap, (-(lists[0][x + 1] + lists[1][0]), x + 1, 0))


def visit(chunk: Chunk, q: np.ndarray, same: bool, label: int, self_id: int, windows: list[tuple[int, int]], k: int,
          upper: tuple, lower: tuple) -> list[list[tuple[int, int]]]:
    """Of the chunk's rows, for each window ``[low, high]`` (percent times score) the first ``k`` by score and id.

    ``(score, id)`` lists; rows of the same (or of another) label, the query itself left out."""
    best: list[list[tuple[int, int]]] = [[] for _ in windows]
    least, most = min(w[0] for w in windows), max(w[1] for w in windows)
    open_ = set(range(len(windows)))
    for bound, i, j in cells_by_bound(upper, chunk.halves):
        top = bound * 100
        # Certified: a window is done when its k-th score beats all that can come.
        open_ = {w for w in open_ if top >= windows[w][0] and (len(best[w]) < k or best[w][-1][0] <= bound)}
        if not open_ or top < least:
            break
        cell = chunk.cells.get((i, j))
        if cell is None or 100 * (lower[0][i] + lower[1][j]) > most:  # no such rows, or all above every window
            continue
        s, e = cell
        scores = chunk.m[s:e] @ q
        ids = chunk.ids[s:e]
        fits = ((chunk.labels[s:e] == label) == same) & (ids != self_id)
        for w in open_:
            low, high = windows[w]
            mine = np.flatnonzero(fits & (100 * scores >= low) & (100 * scores <= high))
            if len(mine):
                if len(mine) > k:  # only the chunk's first k by score and id can count
                    mine = mine[np.lexsort((ids[mine], -scores[mine]))[:k]]
                new = best[w] + [(int(scores[x]), int(ids[x])) for x in mine]
                best[w] = sorted(new, key=lambda r: (-r[0], r[1]))[:k]
    return best


def floors(seeds: tuple, q: np.ndarray, same: bool, label: int, self_id: int, windows: list[tuple[int, int]],
           k: int) -> list[tuple[int, int]]:
    """The windows, each with its lower end raised to the k-th score of the seeds in it: no result lies below."""
    ids, labels, m = seeds
    scores = m @ q
    scores = scores[((labels == label) == same) & (ids != self_id)]
    out = []
    for low, high in windows:
        fit = scores[(100 * scores >= low) & (100 * scores <= high)]
        out.append((max(low, 100 * int(np.partition(fit, -k)[-k])) if len(fit) >= k else low, high))
    return out


FOREVER = 1 << 62


def search(index: Index, queries: DataFrame, same: bool, k: int, chunk_rows: int = CHUNK_ROWS,
           query_rows: int = QUERY_ROWS) -> DataFrame:
    """``anchor_id, positive_id, positive_score, found_id, score``: each chunk's exact first ``k`` rows by window.

    ``queries`` has ``vec_id, label, v`` and ``windows``, an array of ``(positive_id,
    positive_score, low, high)``; each window is answered on its own."""
    spark = queries.sparkSession
    schema = "anchor_id long, positive_id long, positive_score long, found_id long, score long"
    if not index.n:
        return spark.createDataFrame([], schema)
    books, radii, cut, width, seeds = index.books, index.radii, index.cut, index.width, index.seeds
    slack = 1 + 1e-9

    def block_search(sent) -> callable:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            ids, labels, m, windows = sent.value
            halves = m[:, :cut], m[:, cut:]
            mid = [h @ b.T for h, b in zip(halves, books)]
            spread = [np.sqrt((h ** 2).sum(axis=1))[:, None] * r[None, :] * slack + 1e-6 for h, r in zip(halves, radii)]
            upper, lower = [c + s for c, s in zip(mid, spread)], [c - s for c, s in zip(mid, spread)]
            raised = [floors(seeds, m[x], same, labels[x], ids[x], [(w[2], w[3]) for w in windows[x]], k)
                      for x in range(len(ids))]

            def solve(part: list[pa.RecordBatch]) -> pa.RecordBatch:
                col = {c: np.concatenate([b.column(c).to_numpy(zero_copy_only=False) for b in part])
                       for c in ("vec_id", "label", "a", "b")}
                chunk = Chunk(col["vec_id"], col["label"], np.vstack([_matrix(b.column("v"), width) for b in part]),
                              col["a"], col["b"])
                out = []
                for x in range(len(ids)):
                    own = windows[x]
                    got = visit(chunk, m[x], same, labels[x], ids[x], raised[x], k,
                                (upper[0][x], upper[1][x]), (lower[0][x], lower[1][x]))
                    out += [(ids[x], w[0], w[1], i, s) for w, rows in zip(own, got) for s, i in rows]
                return pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in (zip(*out) if out else [[]] * 5)],
                    ["anchor_id", "positive_id", "positive_score", "found_id", "score"])

            part, n = [], 0
            for batch in batches:
                part.append(batch)
                n += batch.num_rows
                if n >= chunk_rows:
                    yield solve(part)
                    part, n = [], 0
            if n:
                yield solve(part)
        return run

    queries = durable(queries.select("vec_id", "label", "v", "windows"))
    blocks = max(1, -(-queries.count() // query_rows))
    queries = durable(queries.withColumn("block", F.pmod(F.xxhash64("vec_id", "label", "v"), F.lit(blocks)))) \
        if blocks > 1 else queries.withColumn("block", F.lit(0))
    found = None
    for block in range(blocks):
        rows = queries.where(F.col("block") == block).toArrow()  # about query_rows rows
        if not len(rows):
            continue
        sent = spark.sparkContext.broadcast((
            rows.column("vec_id").to_pylist(), rows.column("label").to_pylist(),
            _matrix(rows.column("v").combine_chunks(), width),
            [[tuple(w.values()) for w in own] for own in rows.column("windows").to_pylist()]))
        here = durable(index.rows.mapInArrow(block_search(sent), schema))
        found = here if found is None else found.union(here)
        sent.unpersist()
    return spark.createDataFrame([], schema) if found is None else found


def _first(found: DataFrame, by: list[str], k: int) -> DataFrame:
    """The first ``k`` rows by score and id, with their ``rank``; each chunk has sent at most ``k``."""
    w = Window.partitionBy(*by).orderBy(F.desc("score"), "found_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def _window(positive_id: Column, score: Column, low: Column, high: Column) -> Column:
    return F.struct(positive_id.alias("positive_id"), score.alias("positive_score"), low.alias("low"), high.alias("high"))


def hard_negatives(rows: DataFrame, anchors: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES,
                   low: int = LOW, high: int = HIGH, index: Index | None = None) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``rows`` and ``anchors`` have ``vec_id, label, v`` (``valid_vectors``); anchors are
    rows too.  An anchor's positives are its first ``positives`` rows of its label with
    another vec_id; a positive's negatives the first ``negatives`` rows of other labels
    with scores from ``low`` to ``high`` percent of the positive's.  Higher scores come
    first, ties by smaller vec_id.  Scores are exact integers below 2^53.  A positive
    score below zero has an empty window.  Shorter vectors count as filled up with
    zeros.  Rows that repeat a vec_id are found each for itself, but never by an anchor
    of that vec_id; of anchors that repeat one, the smallest (label, v) asks.  Other
    columns are not read, whatever their names.  Empty tables give no rows."""
    index = index or Index(rows)
    whole = F.array(_window(F.lit(-1).cast("long"), F.lit(0).cast("long"), F.lit(-FOREVER), F.lit(FOREVER)))
    anchors = anchors.groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("a")).select("vec_id", "a.label", "a.v")
    best = _first(search(index, anchors.select("vec_id", "label", "v", whole.alias("windows")), True, positives),
                  ["anchor_id"], positives)
    p = durable(best.select(F.col("anchor_id").alias("vec_id"), F.col("found_id").alias("pid"), F.col("score").alias("ps")))
    windows = p.groupBy("vec_id").agg(F.collect_list(_window(
        F.col("pid"), F.col("ps"), F.col("ps") * low, F.col("ps") * high)).alias("windows"))  # at most `positives`
    found = search(index, anchors.join(windows, "vec_id").select("vec_id", "label", "v", "windows"), False, negatives)
    return _first(found, ["anchor_id", "positive_id", "positive_score"], negatives).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("found_id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"))
