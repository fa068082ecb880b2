"""Suffix-array dedup: remove byte strings that a smaller doc_id already has.

Every byte string of ``LENGTH`` bytes that also starts in a document with a
smaller doc_id is removed from the larger one.  Sorting all suffixes would
move every text fifty times, so the suffix array is sparse:

1. Anchors.  Of each ``LENGTH``-byte string the 16-byte gram with the smallest
   hash is its anchor; equal strings have equal anchors at equal places, so a
   string can only be shared where its anchor's gram is.  One scan emits
   (gram hash, row, place); one shuffle finds the grams that texts share.
   Copies of whole texts are settled by their digests and take no further part.
2. Suffixes.  Only shared anchors give a suffix: the ``LENGTH`` bytes from the
   anchor, and the bytes before it that a string over the anchor may begin with.
3. Sampled splitters range-partition the suffixes by their leading bytes, the
   gram.  A gram that fills more than a bucket shows as equal splitters and is
   dealt to as many buckets of its own, so no task holds a gram that a third
   of all documents have.
4. Each bucket sorts its suffixes by multikey quicksort (three-way, eight bytes
   a character).  Longest common prefixes to the right, and the same for the
   bytes before, give the equality classes of every string over an anchor
   exactly; the smallest doc_id of a class keeps it.
5. Across boundaries: the suffixes of a gram that several buckets share are
   compared in one more, pre-aggregated step: equal contexts collapse, and
   strings meet their smallest doc_id in a shuffle.
"""

from __future__ import annotations

from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from basketry.llm.common import durable, small, text_key, utf8, whole_text

LENGTH = 50
GRAM = 16
# Rows of a bucket, and bytes hashed at once: bounds of a task's memory.
BUCKET_ROWS = 100_000
# Sampled suffixes for each bucket, and in all.
SAMPLE_PER_BUCKET = 200
SAMPLE_MOST = 4_000_000
# With very many suffixes a bucket grows before there are more than so many, up to a task's memory (100 bytes a row).
BUCKETS_FEW = 20_000
BUCKET_ROWS_MOST = 2_500_000
CHUNK_BYTES = 2 << 20
CHARACTER = 8


@contextmanager
def _shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Free the shuffle files of each step when it ends: its result is checkpointed."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


# ---------------------------------------------------------------- anchors
def _words_at_each_byte(data: np.ndarray) -> np.ndarray:
    """The 8 bytes from each place, as integers."""
    out = np.empty(len(data) - 7, np.uint64)
    raw = data.tobytes()
    for o in range(8):
        part = np.frombuffer(raw, np.uint64, (len(raw) - o) // 8, o)
        out[o::8] = part[: len(out[o::8])]
    return out


def anchors(data: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """(places, gram hashes) of the anchors of all ``length``-byte strings of ``data``."""
    if len(data) < length:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    w = _words_at_each_byte(data)
    h = w[:-CHARACTER] * np.uint64(0x9E3779B97F4A7C15) ^ w[CHARACTER:] * np.uint64(0xC2B2AE3D27D4EB4F)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    span = length - GRAM + 1
    low, have = h, 1
    while 2 * have <= span:
        low, have = np.minimum(low[:-have], low[have:]), 2 * have
    if have < span:
        low = np.minimum(low[: have - span], low[span - have:])
    # A gram is an anchor where the smallest minimum among the strings over it is its own hash.
    # Going down from the largest of those minima: it must equal the hash.
    pad = np.zeros(span - 1, np.uint64)
    high, have = np.concatenate([pad, low, pad]), 1
    while 2 * have <= span:
        high, have = np.maximum(high[:-have], high[have:]), 2 * have
    if have < span:
        high = np.maximum(high[: have - span], high[span - have:])
    at = np.flatnonzero(high == h)
    return at, h[at]


def _chunks(texts: list[bytes]) -> Iterator[list[int]]:
    """Row numbers in chunks of about ``CHUNK_BYTES`` (one long text may exceed it)."""
    part, size = [], 0
    for i, t in enumerate(texts):
        part.append(i)
        size += len(t)
        if size >= CHUNK_BYTES:
            yield part
            part, size = [], 0
    if part:
        yield part


def _emit_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["key", "th", "doc_id", "place", "known"]
    for batch in batches:
        texts = [t.as_py() for t in batch.column("body")]
        ids, ths = batch.column("doc_id").to_numpy(False), batch.column("th").to_numpy(False)
        for part in _chunks(texts):
            places, grams, rows = [], [], []
            for i in part:
                at, h = anchors(np.frombuffer(texts[i], np.uint8))
                places.append(at), grams.append(h), rows.append(np.full(len(at), i))
            if not places:
                continue
            place, key = np.concatenate(places), np.concatenate(grams).view(np.int64)
            row = np.concatenate(rows)
            th, doc = ths[row], ids[row]
            # Grams of several texts here are known to be shared.  The anchors of two of the
            # texts tell the other chunks, so that a copy of one still sees another text; the
            # rest go to keys of their own, so no gram gathers them all.
            order = np.lexsort((th, key))
            k, t = key[order], th[order]
            head = np.flatnonzero(np.r_[True, k[1:] != k[:-1]]) if len(k) else np.empty(0, int)
            several = np.zeros(len(k), bool)
            if len(k):
                differ = np.minimum.reduceat(t, head) != np.maximum.reduceat(t, head)
                several = np.repeat(differ, np.diff(np.r_[head, len(k)]))
            spread = several.copy()
            spread[head] = False
            spread[np.r_[head[1:], len(k)][: len(head)] - 1] = False
            known = np.empty(len(key), bool)
            known[order] = several
            moved = order[spread]
            key[moved] = (doc[moved] * np.int64(-7046029254386353131)) ^ (place[moved] * np.int64(-4417276706812531889))
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(th), pa.array(doc),
                                              pa.array(place.astype(np.int32)), pa.array(known)], names)


def _shared_places(rows: DataFrame) -> DataFrame:
    """``doc_id, th, places``: the anchors of each row whose gram another text has too."""
    emitted = rows.select("doc_id", "th", "body").mapInArrow(
        _emit_anchors, "key long, th long, doc_id long, place int, known boolean")
    same = Window.partitionBy("key")
    shared = emitted.select("*", (F.min("th").over(same) != F.max("th").over(same)).alias("several"))
    return shared.where("known or several").groupBy("doc_id", "th").agg(F.collect_list("place").alias("places"))


# ---------------------------------------------------------------- suffixes
class Splitters:
    """Bucket of a suffix by its gram; grams that fill several buckets have buckets of their own."""

    def __init__(self, sample: list[bytes], buckets: int) -> None:
        cuts = [sample[len(sample) * i // buckets] for i in range(1, buckets)] if sample else []
        self.cuts = sorted(set(cuts))
        self.plain = len(self.cuts) + 1
        self.shared: dict[bytes, tuple[int, int]] = {}
        self.count = self.plain
        filled = Counter(cuts)
        for gram in self.cuts:
            if (fills := filled[gram]) > 1:
                self.shared[gram] = (self.count, fills)
                self.count += fills

    def bucket(self, gram: bytes, doc: int) -> int:
        if gram in self.shared:
            first, fills = self.shared[gram]
            return first + doc % fills
        return bisect_right(self.cuts, gram)


def _emit_suffixes(batches: Iterator[pa.RecordBatch], splitters: Splitters,
                   rows: int = 16384) -> Iterator[pa.RecordBatch]:
    names = ["suffix", "before", "doc_id", "th", "place", "bucket"]
    reach = LENGTH - GRAM
    suffix, before, doc, th, place, bucket = [], [], [], [], [], []

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([
            pa.array(suffix, pa.binary()), pa.array(before, pa.binary()), pa.array(doc, pa.int64()),
            pa.array(th, pa.int64()), pa.array(place, pa.int32()), pa.array(bucket, pa.int32())], names)

    for part in batches:
        for i, t, body, at in zip(*(part.column(c).to_pylist() for c in ("doc_id", "th", "body", "places"))):
            suffix += [body[p:p + LENGTH] for p in at]
            before += [body[max(0, p - reach):p] for p in at]
            doc += [i] * len(at)
            th += [t] * len(at)
            place += at
            bucket += [splitters.bucket(body[p:p + GRAM], i) for p in at]
            if len(place) >= rows:
                yield batch()
                suffix, before, doc, th, place, bucket = [], [], [], [], [], []
    if place:
        yield batch()


SUFFIX_SCHEMA = "suffix binary, before binary, doc_id long, th long, place int, bucket int"


def _splitters(bodies: DataFrame, n: int) -> Splitters:
    """Splitters of about ``n`` suffixes, from those of a hash sample of the documents."""
    rows = max(BUCKET_ROWS, min(n // BUCKETS_FEW, BUCKET_ROWS_MOST))
    buckets = min(max(1, -(-n // rows)), SAMPLE_MOST // 4)  # the sample has several grams for each splitter
    if buckets == 1:
        return Splitters([], 1)
    share = min(SAMPLE_PER_BUCKET * buckets, SAMPLE_MOST) / n
    part = F.pmod(F.xxhash64("doc_id", "th", F.lit("sample")), F.lit(1 << 30))
    sampled = bodies.where(part < int(share * (1 << 30))).mapInArrow(
        lambda b: _emit_suffixes(b, Splitters([], 1)), SUFFIX_SCHEMA)
    rows = sampled.select(F.substring("suffix", 1, GRAM).alias("gram")).collect()
    return Splitters(sorted(bytes(r["gram"]) for r in rows), buckets)


# ---------------------------------------------------------------- buckets
def _matrix(strings: list[bytes], width: int, right: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Zero-padded bytes (n, width) and the lengths; ``right``: reversed, for bytes before a place."""
    lengths = np.fromiter(map(len, strings), np.int64, len(strings))
    if right:
        data = b"".join(s[::-1].ljust(width, b"\0") for s in strings)
    else:
        data = b"".join(s.ljust(width, b"\0") for s in strings)
    return np.frombuffer(data, np.uint8).reshape(-1, width), lengths


def multikey_quicksort(rows: np.ndarray, small: int = 512) -> np.ndarray:
    """Order of the byte strings ``rows`` (n, width): three-way quicksort, character by character.

    A character is eight bytes.  Ranges split into less, equal and greater than
    a pivot; only the equal part goes on to the next character."""
    width = -(-rows.shape[1] // CHARACTER) * CHARACTER
    padded = np.zeros((len(rows), width), np.uint8)
    padded[:, : rows.shape[1]] = rows
    chars = padded.view(">u8").astype(np.uint64)
    depth_end = chars.shape[1]
    order = np.arange(len(rows))
    todo = [(0, len(rows), 0)]
    while todo:
        a, b, depth = todo.pop()
        if b - a < 2 or depth == depth_end:
            continue
        part = order[a:b]
        if b - a <= small:
            order[a:b] = part[np.lexsort(chars[part, depth:].T[::-1])]
            continue
        c = chars[part, depth]
        pivot = np.sort(c[[0, (b - a) // 4, (b - a) // 2, 3 * (b - a) // 4, b - a - 1]])[2]
        less, equal, more = part[c < pivot], part[c == pivot], part[c > pivot]
        order[a:b] = np.concatenate([less, equal, more])
        x, y = a + len(less), a + len(less) + len(equal)
        todo += [(a, x, depth), (x, y, depth + 1), (y, b, depth)]
    return order


def common_prefixes(rows: np.ndarray) -> np.ndarray:
    """Longest common prefix of each sorted row with the one above (the first: 0)."""
    out = np.zeros(len(rows), np.int64)
    if len(rows) > 1:
        differ = rows[1:] != rows[:-1]
        out[1:] = np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1])
    return out


def removed_spans(suffix: np.ndarray, suffix_len: np.ndarray, before: np.ndarray, before_len: np.ndarray,
                  doc: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, end) of the strings of a row that a row of a smaller doc has.

    Rows are sorted by suffix.  A string that begins ``o`` bytes before its
    anchor is equal in two rows when their suffixes share ``LENGTH - o`` bytes
    and the reversed bytes before share ``o``."""
    n, reach = len(doc), LENGTH - GRAM
    right = common_prefixes(suffix)
    left_order = multikey_quicksort(before)
    left = common_prefixes(before[left_order])
    hit = np.zeros((n, reach + 1), bool)
    for o in range(reach + 1):
        rows = np.flatnonzero((before_len >= o) & (suffix_len >= LENGTH - o))
        if len(rows) < 2:
            continue
        right_class = np.cumsum(right < LENGTH - o)
        left_class = np.empty(n, np.int64)
        left_class[left_order] = np.cumsum(left < o)
        key = right_class[rows] * np.int64(n + 1) + left_class[rows]
        order = np.argsort(key, kind="stable")
        k = key[order]
        head = np.flatnonzero(np.r_[True, k[1:] != k[:-1]])
        least = np.minimum.reduceat(doc[rows][order], head)
        owner = np.repeat(least, np.diff(np.r_[head, len(k)]))
        hit[rows[order], o] = doc[rows][order] > owner
    # Offsets that follow each other are one span: from the largest back to the smallest.
    edge = np.diff(np.pad(hit, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    r, first = np.nonzero(edge == 1)
    r2, stop = np.nonzero(edge == -1)
    return r, place[r] - (stop - 1), place[r] - first + LENGTH


def _sort_bucket(frames: Iterator[pd.DataFrame], plain: int) -> Iterator[pd.DataFrame]:
    """Spans of the bucket's grams (kind 0), or its rows as they are if other buckets share its gram (kind 1)."""
    held = []
    for f in frames:
        if len(f) and f["bucket"].iloc[0] >= plain:
            yield pd.DataFrame({"kind": 1, "doc_id": f["doc_id"], "th": f["th"], "start": f["place"], "stop": 0,
                                "suffix": f["suffix"], "before": f["before"]})
        elif len(f):
            held.append(f)
    if not held:
        return
    bucket = pd.concat(held, ignore_index=True)
    suffix, suffix_len = _matrix(bucket["suffix"].tolist(), LENGTH)
    order = multikey_quicksort(suffix)
    before, before_len = _matrix(bucket["before"].iloc[order].tolist(), LENGTH - GRAM, right=True)
    doc, place = bucket["doc_id"].to_numpy()[order], bucket["place"].to_numpy()[order].astype(np.int64)
    row, start, stop = removed_spans(suffix[order], suffix_len[order], before, before_len, doc, place)
    yield pd.DataFrame({"kind": 0, "doc_id": doc[row], "th": bucket["th"].to_numpy()[order][row],
                        "start": start, "stop": stop, "suffix": None, "before": None})


def _across(open_rows: DataFrame) -> DataFrame:
    """Spans of the rows whose gram is spread over several buckets.

    Equal contexts collapse to one class with its smallest doc_id before the
    strings over the anchor are spelled out, and the strings to their smallest."""
    reach = LENGTH - GRAM
    context = ["suffix", "before"]
    classes = open_rows.groupBy(*context).agg(F.min("doc_id").alias("first"))
    back = F.length("before")
    low = F.greatest(F.lit(LENGTH) - F.length("suffix"), F.lit(0))
    strings = classes.where(low <= back).select(
        *context, "first", F.explode(F.sequence(low, F.least(back, F.lit(reach)))).alias("o"))
    strings = durable(strings.withColumn("string", F.concat(
        F.expr("substring(before, length(before) - o + 1, o)"), F.expr(f"substring(suffix, 1, {LENGTH} - o)"))))
    owners = durable(strings.groupBy("string").agg(F.min("first").alias("owner")))
    owned = durable(strings.join(owners, "string").groupBy(*context).agg(
        F.collect_list(F.struct("o", "owner")).alias("owners")))  # at most reach + 1 offsets
    # One context may have most of the rows: they stay where they are, or the join splits them.
    spans = open_rows.join(small(owned, F.lit(256) + 16 * F.size("owners")), context).select(
        "doc_id", "th", "place", F.explode("owners").alias("w")).where(F.col("doc_id") > F.col("w.owner"))
    start = F.col("place") - F.col("w.o")
    return spans.select("doc_id", "th", start.alias("start"), (start + LENGTH).alias("stop"))


# ---------------------------------------------------------------- result
def merged(starts: np.ndarray, stops: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs of the union of [start, stop)."""
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(stops[order])
    head = np.flatnonzero(np.r_[True, starts[1:] > reach[:-1]])
    return list(zip(starts[head].tolist(), reach[np.r_[head[1:] - 1, len(reach) - 1]].tolist()))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept, spans, sizes = [], [], []
        for body, starts, stops, copy in zip(*(batch.column(c) for c in ("body", "starts", "stops", "copy"))):
            body = body.as_py()
            if copy.as_py() and len(body) >= LENGTH:
                runs = [(0, len(body))]
            elif starts.is_valid and len(starts):
                runs = merged(starts.values.to_numpy(False), stops.values.to_numpy(False))
            else:
                runs = []
            at, parts = 0, []
            for a, b in runs:
                parts.append(body[at:a])
                at = b
            parts.append(body[at:])
            kept.append(b"".join(parts))
            sizes.append(len(body))
            spans.append([{"start": a, "stop": b} for a, b in runs])
        yield pa.RecordBatch.from_arrays([
            batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(kept, pa.binary()),
            pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])))],
            ["doc_id", "n_bytes", "kept", "spans"])


def removal_spans(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, spans): ``doc_id, th, copy`` of every distinct row, and ``doc_id, th, start, stop`` to remove."""
    keyed = docs.where("doc_id is not null").select(
        F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("th"), utf8(whole_text()).alias("body"))
    digests = keyed.select("doc_id", "th", F.unhex(F.sha2("body", 256)).alias("digest")).distinct()
    digests = durable(digests)
    # Only texts with copies need their first doc_id; a hot digest's rows stay where they are, or the join splits them.
    firsts = durable(digests.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n"))
                     .where("n > 1").select("digest", "first"))
    copy = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False))
    rows = durable(digests.join(small(firsts, F.lit(96)), "digest", "left").select("doc_id", "th", copy.alias("copy")))
    places = durable(_shared_places(keyed.where(F.length("body") >= LENGTH)))
    originals = rows.where(~F.col("copy")).select("doc_id", "th")
    wanted = places.join(originals, ["doc_id", "th"])
    bodies = keyed.join(wanted, ["doc_id", "th"]).select("doc_id", "th", "body", "places")
    n = places.agg(F.coalesce(F.sum(F.size("places")), F.lit(0))).first()[0]
    splitters = _splitters(bodies, n)
    suffixes = bodies.mapInArrow(lambda b: _emit_suffixes(b, splitters), SUFFIX_SCHEMA)
    plain = splitters.plain
    sorted_ = durable(suffixes.repartitionById(splitters.count, "bucket").mapInPandas(
        lambda f: _sort_bucket(f, plain),
        "kind int, doc_id long, th long, start long, stop long, suffix binary, before binary"))
    inside = sorted_.where("kind = 0").select("doc_id", "th", "start", "stop")
    across = _across(sorted_.where("kind = 1").select(
        "suffix", "before", "doc_id", "th", F.col("start").alias("place")))
    return rows, inside.union(across)


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, kept`` (remaining bytes) and ``spans`` (removed ``start, stop``) for every row.

    A null text is empty; matches never cross documents, and strings are judged
    on the input.  Rows with a null doc_id neither lose nor claim bytes.  Rows
    that repeat a doc_id do not remove from one another, and share their spans
    only with equal texts.  An empty table gives no rows.
    """
    with _shuffles_freed(docs.sparkSession):
        rows, spans = removal_spans(docs)
        per_doc = durable(spans.groupBy("doc_id", "th").agg(F.collect_list("start").alias("starts"),
                                                            F.collect_list("stop").alias("stops")))
    keyed = docs.select("doc_id", text_key().alias("th"), utf8(whole_text()).alias("body"))
    flags = rows.join(per_doc, ["doc_id", "th"], "left").withColumnRenamed("doc_id", "id").withColumnRenamed("th", "t")
    tagged = keyed.join(flags, keyed["doc_id"].eqNullSafe(F.col("id")) & (keyed["th"] == F.col("t")), "left")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return tagged.select("doc_id", "body", "starts", "stops", F.coalesce("copy", F.lit(False)).alias("copy")
                         ).mapInArrow(_cut, f"doc_id {kind}, n_bytes long, kept binary, "
                                            "spans array<struct<start:bigint,stop:bigint>>")

