"""Spelling variant grouping by Bloom-guided neighbourhoods.

1. Words: one pass over whole texts counts the words of each task (Python), one
   shuffle adds the counts up.  Words that are too short or too rare leave.
2. Filters: the vocabulary's hashes fill blocked Bloom filters, one shard per word
   length, a long shard cut into segments by hash.  Filters are broadcast in rounds
   of at most ``ROUND_BYTES``, so the broadcast has a bound at any vocabulary size.
3. Probes: the hash is a polynomial of the code points, so the hash of every word
   with one code point deleted or replaced follows from the word's own in one step
   (numpy, a matrix per word length).  Insertions are the deletions of the longer
   word, and of two words that differ by a replacement the one with the smaller code
   point asks, so every pair is probed once.
4. Only probes that a filter lets through become text and are shuffled to an exact
   join with the vocabulary, which removes the filters' false positives.
5. Roots: forms are followed by pointer doubling; a form has at least ``RATIO`` times
   its word's count, so chains are short and have no cycle.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import durable

LETTERS = "A-Za-zÀ-ÿ"
MIN_LENGTH = 5
MIN_COUNT = 3
RATIO = 2
# One in so many hashes of "<doc_id>:<run>" loses a code point (the query's planted misspellings).
NOISE = 97
# Bloom filters: bits for each word, bits set in its 64-bit block, largest segment, most that one round broadcasts.
BITS_PER_WORD = 24
BITS_SET = 5
SEGMENT_BYTES = 1 << 20
ROUND_BYTES = 32 << 20
# Words counted in a task before its counts are handed on, and bytes of positives.
FLUSH_WORDS = 400_000
FLUSH_BYTES = 4 << 20

BASE = 0x9E3779B97F4A7C15  # odd, so powers have inverses modulo 2^64
INVERSE = pow(BASE, -1, 1 << 64)


def runs(text: str | None, pattern: re.Pattern) -> list[str]:
    """Maximal letter runs of a text, A-Z lower-cased."""
    return pattern.findall(text.encode("utf-8", "replace").lower().decode("utf-8")) if text else []


def noisy(run: str, seed: int, every: int) -> str:
    """The run, or the run without one code point where its hash (CRC-32 carried on from ``seed``) says so."""
    h = zlib.crc32(run.encode("utf-8"), seed)
    if h % every:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def word_counts(docs: DataFrame, letters: str = LETTERS, noise: int | None = NOISE, min_length: int = MIN_LENGTH,
                min_count: int = MIN_COUNT) -> DataFrame:
    """``word, n``: the words of whole texts that are long and frequent enough."""
    pattern = re.compile(f"[{letters}]+")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()),
                                               pa.array(list(seen.values()), pa.int64())], ["word", "n"])

        for batch in batches:
            for doc, text in zip(batch.column("id"), batch.column("text")):
                mine = Counter(runs(text.as_py(), pattern))
                if noise:
                    seed = zlib.crc32(f"{doc.as_py()}:".encode())
                    for run, n in mine.items():
                        word = noisy(run, seed, noise)
                        if len(word) >= min_length:
                            seen[word] += n
                else:
                    seen.update({w: n for w, n in mine.items() if len(w) >= min_length})
                if len(seen) >= FLUSH_WORDS:
                    yield out()
                    seen.clear()
        yield out()

    cols = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), "text")
    return (cols.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
            .where(F.col("n") >= min_count))


# ---------------------------------------------------------------- hashes and filters
def powers(n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.cumprod(np.r_[np.uint64(1), np.full(max(n - 1, 0), BASE, np.uint64)], dtype=np.uint64)[:n]


def codes(words: list[str]) -> np.ndarray:
    """Code points of words of one length, a row each."""
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), -1).astype(np.uint64)


def word_hash(points: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (points * powers(points.shape[1])).sum(axis=1, dtype=np.uint64)


def _mixed(h: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
        return (h ^ (h >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)


def _segment(mixed: np.ndarray, segments: int) -> np.ndarray:
    return ((mixed >> np.uint64(44)) % np.uint64(segments)).astype(np.int64)


def _block_and_mask(mixed: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    low = _mixed(mixed)
    mask = np.zeros(low.shape, np.uint64)
    for i in range(BITS_SET):
        mask |= np.uint64(1) << ((low >> np.uint64(6 * i)) & np.uint64(63))
    return (((low >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32)).astype(np.int64), mask


def segments_of(n: int) -> int:
    return max(1, -(-n * BITS_PER_WORD // 8 // SEGMENT_BYTES))


def _blocks(n: int) -> int:
    return max(64, -(-n * BITS_PER_WORD // 64))


def bloom(hashes: np.ndarray) -> np.ndarray:
    """The blocked filter of the words with these hashes."""
    table = np.zeros(_blocks(len(hashes)), np.uint64)
    at, mask = _block_and_mask(_mixed(hashes), len(table))
    np.bitwise_or.at(table, at, mask)
    return table


def maybe_in(hashes: np.ndarray, shard: dict[int, np.ndarray], segments: int) -> np.ndarray:
    """Which hashes the filters of one length let through; segments of other rounds let none."""
    mixed = _mixed(hashes)
    out = np.zeros(hashes.shape, bool)
    where = _segment(mixed, segments) if segments > 1 else None
    for s, table in shard.items():
        take = slice(None) if where is None else where == s
        at, mask = _block_and_mask(mixed[take], len(table))
        out[take] = table[at] & mask == mask
    return out


def _filters(vocabulary: DataFrame, sizes: dict[int, int]) -> DataFrame:
    """``length, segment, bits``: a row for each segment, at most ``SEGMENT_BYTES`` (and a little)."""
    spark = vocabulary.sparkSession
    parts = spark.createDataFrame([(k, segments_of(n)) for k, n in sizes.items()], "length int, segments int")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = batch.column("h").to_numpy(zero_copy_only=False).view(np.uint64)
            at = _mixed(h) >> np.uint64(44)
            at = (at % batch.column("segments").to_numpy(zero_copy_only=False).astype(np.uint64)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column("length"), pa.array(at), batch.column("h")],
                                             ["length", "segment", "h"])

    def build(part: pa.Table) -> pa.Table:
        h = part.column("h").to_numpy().view(np.uint64)
        return pa.table({"length": part.column("length")[:1], "segment": part.column("segment")[:1],
                         "bits": pa.array([bloom(h).tobytes()], pa.binary())})

    placed = vocabulary.select("length", "h").join(F.broadcast(parts), "length").mapInArrow(
        place, "length int, segment int, h long")
    return placed.groupBy("length", "segment").applyInArrow(build, "length int, segment int, bits binary")


# ---------------------------------------------------------------- probes
def _deletions(points: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word without position i, and whether i begins a run of equal code points (else it repeats i - 1)."""
    with np.errstate(over="ignore"):
        upto = np.cumsum(points * powers(points.shape[1]), axis=1, dtype=np.uint64)
        before = np.concatenate([np.zeros((len(points), 1), np.uint64), upto[:, :-1]], axis=1)
        return before + (h[:, None] - upto) * np.uint64(INVERSE), np.concatenate(
            [np.ones((len(points), 1), bool), points[:, 1:] != points[:, :-1]], axis=1)


def positives(words: list[str], alphabet: np.ndarray, shards: dict[int, dict[int, np.ndarray]],
              segments: dict[int, int]) -> Iterator[tuple[int, str]]:
    """``(index, other)`` for the edits of words of one length that the filters let through."""
    length = len(words[0])
    points = codes(words)
    h = word_hash(points)
    if shards.get(length - 1):
        edits, first = _deletions(points, h)
        rows, cols = np.nonzero(first)
        hit = maybe_in(edits[rows, cols], shards[length - 1], segments[length - 1])
        for i, at in zip(rows[hit].tolist(), cols[hit].tolist()):
            yield i, words[i][:at] + words[i][at + 1:]
    if shards.get(length):
        power = powers(length)
        for at in range(length):
            here = points[:, at]
            with np.errstate(over="ignore"):
                step = (alphabet[None, :] - here[:, None]) * power[at]
            rows, letter = np.nonzero(alphabet[None, :] > here[:, None])
            with np.errstate(over="ignore"):
                edits = h[rows] + step[rows, letter]
            hit = maybe_in(edits, shards[length], segments[length])
            for i, k in zip(rows[hit].tolist(), letter[hit].tolist()):
                yield i, words[i][:at] + chr(int(alphabet[k])) + words[i][at + 1:]


def _rounds(filters: DataFrame, budget: int) -> list[list[tuple[int, int]]]:
    """Segments in groups of at most ``budget`` bytes; only their numbers and sizes reach the driver."""
    out: list[list[tuple[int, int]]] = []
    left = 0
    for r in filters.select("length", "segment", F.octet_length("bits").alias("b")).orderBy("length", "segment").collect():
        if not out or r["b"] > left:
            out.append([])
            left = budget
        out[-1].append((r["length"], r["segment"]))
        left -= r["b"]
    return out


def near_pairs(vocabulary: DataFrame, letters: str = LETTERS, round_bytes: int = ROUND_BYTES) -> DataFrame:
    """``word, n, other, other_n``: each pair of words one code point apart, once.

    ``vocabulary`` has distinct ``word`` and ``n``.  Replacements use the code points
    of ``letters`` from U+0000 to U+00FF, which hold every word that ``word_counts`` finds."""
    spark = vocabulary.sparkSession

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column("word").to_pylist()
            h = np.zeros(len(words), np.uint64)
            lengths = np.array([len(w) for w in words], np.int32)
            for k in np.unique(lengths):
                at = np.flatnonzero(lengths == k)
                h[at] = word_hash(codes([words[i] for i in at]))
            yield pa.RecordBatch.from_arrays([batch.column("word"), batch.column("n"), pa.array(lengths),
                                              pa.array(h.view(np.int64))], ["word", "n", "length", "h"])

    words = durable(vocabulary.select("word", "n").mapInArrow(hashed, "word string, n long, length int, h long"))
    sizes = {r["length"]: r["n"] for r in words.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    segments = {k: segments_of(n) for k, n in sizes.items()}
    filters = durable(_filters(words, sizes)) if sizes else None
    pattern = re.compile(f"[{letters}]")
    alphabet = np.array([c for c in range(256) if pattern.match(chr(c)) and not "A" <= chr(c) <= "Z"], np.uint64)
    found = None
    for part in _rounds(filters, round_bytes) if sizes else []:
        wanted = spark.createDataFrame(part, "length int, segment int")
        shards: dict[int, dict[int, np.ndarray]] = {}
        for r in filters.join(F.broadcast(wanted), ["length", "segment"]).collect():  # one round's bytes
            shards.setdefault(r["length"], {})[r["segment"]] = np.frombuffer(bytes(r["bits"]), np.uint64)
        sent = spark.sparkContext.broadcast(shards)
        asked = sorted({k for n in shards for k in (n, n + 1)} & set(sizes))

        def probe(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                every, counts = batch.column("word").to_pylist(), batch.column("n").to_pylist()
                by_length: dict[int, list[int]] = {}
                for i, w in enumerate(every):
                    by_length.setdefault(len(w), []).append(i)
                rows: list[tuple[str, int, str]] = []
                used = 0
                for length, at in by_length.items():
                    step = max(1, 100_000 // (length * len(alphabet)) + 1) * 16  # bounds the matrices of a step
                    for s in range(0, len(at), step):
                        mine = at[s:s + step]
                        for i, other in positives([every[j] for j in mine], alphabet, sent.value, segments):
                            rows.append((every[mine[i]], counts[mine[i]], other))
                            used += 2 * length + 8
                            if used >= FLUSH_BYTES:
                                yield _pair_batch(rows)
                                rows, used = [], 0
                yield _pair_batch(rows)

        here = durable(words.where(F.col("length").isin(asked)).select("word", "n")
                       .mapInArrow(probe, "word string, n long, other string"))
        found = here if found is None else found.union(here)
        sent.unpersist()
    exact = words.select(F.col("word").alias("other"), F.col("n").alias("other_n"))
    if found is None:
        return exact.select(F.col("other").alias("word"), F.col("other_n").alias("n"), "other", "other_n").limit(0)
    return found.join(exact, "other").select("word", "n", "other", "other_n")


def _pair_batch(rows: list[tuple[str, int, str]]) -> pa.RecordBatch:
    a, n, b = zip(*rows) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.string()), pa.array(n, pa.int64()), pa.array(b, pa.string())],
                                      ["word", "n", "other"])


# ---------------------------------------------------------------- forms and roots
def _roots(forms: DataFrame) -> DataFrame:
    """``word, root`` of ``forms(word, form)``: each form followed to the last, by pointer doubling."""
    at = durable(forms.select("word", F.col("form").alias("root")))
    while True:
        further = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        stepped = durable(at.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"),
                                                                  F.col("next").isNotNull().alias("moved")))
        at = stepped.select("word", "root")
        if stepped.where("moved").isEmpty():
            return at


def variant_groups(vocabulary: DataFrame, letters: str = LETTERS, ratio: int = RATIO,
                   round_bytes: int = ROUND_BYTES) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for each word of ``vocabulary(word, n)``."""
    words = durable(vocabulary.select("word", "n"))
    pairs = durable(near_pairs(words, letters, round_bytes))
    both = pairs.union(pairs.select("other", "other_n", "word", "n"))
    best = (both.groupBy("word", "n").agg(F.count(F.lit(1)).alias("n_near"),
                                          F.min(F.struct((-F.col("other_n")).alias("o"), "other")).alias("b"))
            .select("word", "n_near", F.when(-F.col("b.o") >= ratio * F.col("n"), F.col("b.other")).alias("form"),
                    F.when(-F.col("b.o") >= ratio * F.col("n"), -F.col("b.o")).alias("form_n")))
    best = durable(best)
    roots = _roots(best.where("form is not null"))
    return words.join(best, "word", "left").join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n")


def spelling_variants(docs: DataFrame, letters: str = LETTERS, noise: int | None = NOISE, min_length: int = MIN_LENGTH,
                      min_count: int = MIN_COUNT, ratio: int = RATIO) -> DataFrame:
    """Variant groups of the words of ``docs``: one row per word, ``word, form, root, n, n_near, form_n``.

    Null and empty texts have no words; a very long text or word is read whole.  A
    null doc_id is the empty text in the hash that drops code points (``noise=None``:
    none are dropped).  Repeated rows count each time.  Ties between forms go to the
    smaller word in code-point order.  Other columns are not read, whatever their
    names.  An empty table gives no rows."""
    return variant_groups(word_counts(docs, letters, noise, min_length, min_count), letters, ratio)
