"""Language-model scoring by prediction by partial matching (PPM).

The model is a trie of byte contexts of up to ``ORDER`` bytes with the counts of
the byte that follows, learned from the training documents.  A byte is coded in
the longest context seen in training: of a context's count n a successor with count
c has (2c - 1) / 2n, and all that never followed share the escape probability, distinct
successors / 2n (method D).  An escape hands on to the context one byte shorter, where
the successors of the longer one are excluded; below the empty context the byte values
left are equally likely.
A document's score is the sum of its bytes' log10 probabilities, its end included, each
rounded to 16 significant bits.

How it runs
-----------
1. ``_packs`` reads every text once, in blocks of at most ``BLOCK_BYTES`` (longer
   texts are blocks of their own).  A block leaves its texts, packed, and its
   *different* grams (a context and its byte, in one long) and words with their
   training counts, cut into shards; the rest of the work moves these, not texts.
2. Trie: all grams whose context ends in the same two bytes meet in a shard, so a
   shard holds whole branches of the trie, from two bytes up, and answers each
   block with the log probability of each gram the block has.  Contexts of one and
   no byte (at most 65,536 counts) go to every task.
3. Words of the unigram base meet in shards by their hash and are answered by counts.
4. Each block meets its answers and scores its texts.

A shard's or a block's rows are packed arrays, sorted and without repeats, so a
gram or word that fills the corpus is one entry of each block.  ``SHARDS`` None
takes ``spark.sql.shuffle.partitions``; more data wants more of them.
"""

from __future__ import annotations

import math
import uuid
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.session import ensure_checkpoint_dir

ORDER = 6
BLOCK_BYTES = 16 << 20
PIECE_BYTES = 2 << 20
SHARDS: int | None = None
HELD_OUT = 10
ALPHA = 0.1
# Of a log probability's 24 significant bits so many are not sent.
DROPPED_BITS = 8
TEXT_LEVEL = 3  # of the texts' compression
STEP = 1 << 15  # places worked on at once
# Neither byte occurs in UTF-8: what stands before a text, and its end.
BEGIN, END = b"\xff", b"\xfe"
DOCS, GRAMS, WORDS, LOW = 0, 1, 2, 3


def lowered(text: str | None) -> bytes:
    """UTF-8 bytes with A-Z lower-cased."""
    return (text or "").encode("utf-8", "replace").lower()


def is_held_out(doc_id, every: int = HELD_OUT) -> bool:
    """Whether the CRC-32 of the doc_id as text (null: empty) is divisible by ``every``."""
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % every == 0


def _windows(line: np.ndarray, width: int) -> np.ndarray:
    """Every run of ``width`` bytes as one unsigned long; in steps that stay in a processor's cache."""
    out = np.empty(max(0, len(line) - width + 1), np.uint64)
    for at in range(0, len(out), STEP):
        here = out[at:at + STEP]
        n = len(here)
        part = line[at:at + n + width - 1].astype(np.uint32)
        low = min(4, width)  # the first bytes in 32 bits, the rest in 64
        head = part[:n].copy()
        for i in range(1, low):
            head <<= np.uint32(8)
            head |= part[i:i + n]
        here[:] = head
        for i in range(low, width):
            here <<= np.uint64(8)
            here |= part[i:i + n]
    return out


def grams(texts: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """The context and byte at each place of some texts, their ends included: ``order + 1`` bytes as one long.

    Also where each text's begin; the places of a text are followed by ``order`` windows into
    the next one, which are ``none(order)``."""
    lead = BEGIN * order
    line = np.frombuffer(b"".join([lead + t + END for t in texts]) + lead, np.uint8)
    out = _windows(line, order + 1)
    sizes = np.array([len(t) for t in texts], np.int64) + order + 1
    starts = np.cumsum(sizes) - sizes
    across = (starts + sizes - order)[:, None] + np.arange(order)
    out[across.ravel()] = none(order)
    return out, starts


def none(order: int) -> np.uint64:
    """Stands for no place: every byte is ``BEGIN``, which never follows a context."""
    return np.uint64((1 << 8 * (order + 1)) - 1)


def _distinct(keys: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct places and how often each comes."""
    keys = np.sort(keys)
    keys = keys[:np.searchsorted(keys, none(order))]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.diff(np.r_[first, len(keys)])


def _counted(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and the sums of their counts."""
    if not len(keys):
        return keys, n
    at = np.argsort(keys)
    keys, n = keys[at], n[at]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return keys[first], np.add.reduceat(n, first)


# Packed arrays: byte planes of longs (differences, where sorted), so that what is small takes little room.
def _planes(values: np.ndarray) -> bytes:
    width = values.dtype.itemsize
    return pa.compress(values.view(np.uint8).reshape(-1, width).T.tobytes(), "zstd", asbytes=True)


def _values(data: bytes, kind) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(zstd(data), np.uint8).reshape(width, -1).T).view(kind).reshape(-1)


def packed_keys(keys: np.ndarray) -> bytes:
    """Sorted unsigned longs."""
    return _planes(np.diff(keys, prepend=np.uint64(0)))


def unpacked_keys(data: bytes) -> np.ndarray:
    return np.cumsum(_values(data, np.uint64), dtype=np.uint64)


def packed_logs(logs: np.ndarray) -> bytes:
    """log10 probabilities, to 16 significant bits."""
    bits = (-logs).astype(np.float32).view(np.uint32)
    return _planes((bits + np.uint32(1 << DROPPED_BITS - 1)) >> np.uint32(DROPPED_BITS))


def unpacked_logs(data: bytes) -> np.ndarray:
    return -(_values(data, np.uint32) << np.uint32(DROPPED_BITS)).view(np.float32)


class GramTable:
    """Grams and their values by open addressing; only grams that are in it are asked."""

    def __init__(self, keys: np.ndarray, values: np.ndarray) -> None:
        self.bits = max(4, int(2.5 * len(keys)).bit_length())
        size = 1 << self.bits
        self.keys, self.values = np.zeros(size, np.uint64), np.zeros(size, values.dtype)
        used, owner = np.zeros(size, bool), np.zeros(size, np.int64)
        left, slot = np.arange(len(keys)), self._slot(keys)
        while len(left):
            free = left[~used[slot[left]]]
            owner[slot[free]] = free
            won = free[owner[slot[free]] == free]  # of several that ask for a slot the last one has it
            used[slot[won]] = True
            self.keys[slot[won]], self.values[slot[won]] = keys[won], values[won]
            left = left[self.keys[slot[left]] != keys[left]]
            slot[left] = (slot[left] + 1) & (size - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def __getitem__(self, asked: np.ndarray) -> np.ndarray:
        out = np.empty(len(asked), self.values.dtype)
        for at in range(0, len(asked), STEP):
            part = asked[at:at + STEP]
            slot = self._slot(part)
            wrong = np.flatnonzero(self.keys[slot] != part)
            while len(wrong):
                slot[wrong] = (slot[wrong] + 1) & ((1 << self.bits) - 1)
                wrong = wrong[self.keys[slot[wrong]] != part[wrong]]
            out[at:at + STEP] = self.values[slot]
        return out


def _shard(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of a gram, by the two bytes before its last."""
    h = ((keys >> np.uint64(8)) & np.uint64(0xFFFF)) * np.uint64(2654435761)
    return (((h & np.uint64(0xFFFFFFFF)) * np.uint64(shards)) >> np.uint64(32)).astype(np.int64)


# ---------------------------------------------------------------- blocks
class _Block:
    """Texts of one block: different grams and words with training counts; texts leave in pieces."""

    def __init__(self, order: int) -> None:
        self.order, self.size, self.words = order, 0, (Counter(), Counter())
        self.keys, self.n = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.more: list[tuple[np.ndarray, np.ndarray]] = []  # of pieces, not merged yet
        self.low = np.zeros(1 << 16, np.int64)
        self.piece: list[tuple] = []
        self.piece_bytes = 0

    def add(self, doc_id, text: bytes, held: bool) -> None:
        self.piece.append((doc_id, text, held))
        self.piece_bytes += len(text)
        self.size += len(text)

    def flush(self) -> tuple[list, list, list, bytes]:
        """Count the piece and hand out its texts."""
        for held in (False, True):
            texts = [t for _, t, h in self.piece if h == held]
            for t in texts:
                self.words[held].update(t.split())
            keys, n = _distinct(grams(texts, self.order)[0], self.order)
            if not held:
                np.add.at(self.low, (keys & np.uint64(0xFFFF)).astype(np.int64), n)
            self.more.append((keys, n * (not held)))
        if sum(len(k) for k, _ in self.more) > max(len(self.keys), 1 << 20):
            self.merge()
        out = ([d for d, _, _ in self.piece], [h for _, _, h in self.piece], [len(t) for _, t, _ in self.piece],
               b"".join(t for _, t, _ in self.piece))
        self.piece, self.piece_bytes = [], 0
        return out

    def merge(self) -> None:
        every = [(self.keys, self.n), *self.more]
        self.keys, self.n = _counted(np.concatenate([k for k, _ in every]), np.concatenate([n for _, n in every]))
        self.more = []


def _packs(docs: DataFrame, order: int, shards: int, every: int, block_bytes: int) -> DataFrame:
    """Rows of every block: packed texts (``DOCS``), and by shard its grams, words and low counts."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["kind", "block", "shard", "ids", "held", "sizes", "data", "counts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_type, seq, lead = None, 0, TaskContext.get().partitionId() << 32

        def row(what: int, shard: int, data: bytes, counts: bytes, ids=None, held=None, sizes=None) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([what], pa.int32()), pa.array([lead + seq], pa.int64()), pa.array([shard], pa.int32()),
                 pa.array([ids], pa.list_(ids_type)), pa.array([held], pa.list_(pa.bool_())),
                 pa.array([sizes], pa.list_(pa.int64())), pa.array([data], pa.binary()), pa.array([counts], pa.binary())], names)

        def texts(block: _Block) -> pa.RecordBatch:
            ids, held, sizes, data = block.flush()
            return row(DOCS, 0, pa.Codec("zstd", TEXT_LEVEL).compress(data, asbytes=True), b"", ids, held, sizes)

        def close(block: _Block) -> Iterator[pa.RecordBatch]:
            if block.piece:
                yield texts(block)
            block.merge()
            at = _shard(block.keys, shards)
            for s in np.unique(at):
                mine = at == s
                yield row(GRAMS, int(s), packed_keys(block.keys[mine]), _planes(block.n[mine]))
            taught, other = block.words
            by_shard: dict[int, list[bytes]] = {}
            for w in taught.keys() | other.keys():
                by_shard.setdefault(zlib.crc32(w) * shards >> 32, []).append(w)
            for s, mine in by_shard.items():
                mine.sort()
                yield row(WORDS, s, pa.compress(b"\n".join(mine), "zstd", asbytes=True),
                          _planes(np.array([taught[w] for w in mine], np.int64)))
            keys = np.flatnonzero(block.low).astype(np.uint64)
            yield row(LOW, 0, packed_keys(keys), _planes(block.low[keys.astype(np.int64)]))

        block = _Block(order)
        for batch in batches:
            ids_type = batch.column("doc_id").type
            for doc, text in zip(batch.column("doc_id"), batch.column("text")):
                doc, text = doc.as_py(), lowered(text.as_py())
                if block.size and block.size + len(text) > block_bytes:
                    yield from close(block)
                    block, seq = _Block(order), seq + 1
                block.add(doc, text, is_held_out(doc, every))
                if block.piece_bytes >= PIECE_BYTES:
                    yield texts(block)
        if block.size or block.piece:
            yield from close(block)

    schema = (f"kind int, block long, shard int, ids array<{kind}>, held array<boolean>, sizes array<long>, "
              "data binary, counts binary")
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def _written(df: DataFrame, name: str) -> DataFrame:
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "uncompressed").parquet(path)  # the columns are compressed already
    return df.sparkSession.read.schema(df.schema).parquet(path)


def zstd(value: bytes) -> bytes:
    return pa.input_stream(pa.BufferReader(value), compression="zstd").read()


# ---------------------------------------------------------------- the trie
class Trie:
    """Counts of one branch set of the context trie: grams whose contexts end in the same bytes, and the low orders.

    ``keys, n``: training grams of ``order`` (sorted); ``low``: counts by (byte, next byte)."""

    def __init__(self, order: int, keys: np.ndarray, n: np.ndarray, low: np.ndarray) -> None:
        self.order = order
        self.levels: list[dict[str, np.ndarray]] = [{} for _ in range(order + 1)]
        pair = np.flatnonzero(low).astype(np.uint64)
        count = low[pair.astype(np.int64)]
        for k in range(order, -1, -1):
            if k <= 1:
                here = _counted(pair & np.uint64((1 << 8 * (k + 1)) - 1), count)
            else:
                here = _counted(keys & np.uint64((1 << 8 * (k + 1)) - 1), n)
            first = np.flatnonzero(np.r_[True, here[0][1:] >> np.uint64(8) != here[0][:-1] >> np.uint64(8)]) \
                if len(here[0]) else np.zeros(0, np.int64)
            self.levels[k] = {
                "keys": here[0], "n": here[1], "contexts": here[0][first] >> np.uint64(8),
                "total": np.add.reduceat(here[1], first) if len(first) else here[1],
                "distinct": np.diff(np.r_[first, len(here[0])]), "first": first}
        for k in range(order, 0, -1):  # what is left in the shorter context once this one's successors are excluded
            mine, above = self.levels[k], self.levels[k - 1]
            short = mine["keys"] & np.uint64((1 << 8 * k) - 1)
            seen = above["n"][np.searchsorted(above["keys"], short)] if len(short) else mine["n"]
            up = np.searchsorted(above["contexts"], mine["contexts"] & np.uint64((1 << 8 * (k - 1)) - 1))
            gone = np.add.reduceat(seen, mine["first"]) if len(mine["first"]) else mine["n"]
            mine["rest"] = above["total"][up] - gone if len(up) else mine["n"]
            mine["rest_distinct"] = above["distinct"][up] - mine["distinct"] if len(up) else mine["n"]

    def log10(self, asked: np.ndarray) -> np.ndarray:
        """log10 probability of each gram's last byte after its context."""
        out = np.zeros(len(asked))
        left = np.arange(len(asked))
        escaped = np.zeros(len(asked), bool)
        rest, rest_distinct = np.zeros(len(asked)), np.zeros(len(asked))
        for k in range(self.order, -1, -1):
            lv = self.levels[k]
            if not len(lv["keys"]):
                continue
            key = asked[left] & np.uint64((1 << 8 * (k + 1)) - 1)
            at = np.minimum(np.searchsorted(lv["keys"], key), len(lv["keys"]) - 1)
            hit = lv["keys"][at] == key
            ctx = np.minimum(np.searchsorted(lv["contexts"], key >> np.uint64(8)), len(lv["contexts"]) - 1)
            known = lv["contexts"][ctx] == key >> np.uint64(8)
            total = np.where(escaped[left], rest[left], lv["total"][ctx])
            distinct = np.where(escaped[left], rest_distinct[left], lv["distinct"][ctx])
            out[left[hit]] += np.log10((lv["n"][at[hit]] - 0.5) / total[hit])
            # An escape costs nothing where every successor is excluded already.
            miss = ~hit & known & (distinct > 0)
            out[left[miss]] += np.log10(0.5 * distinct[miss] / total[miss])
            on = ~hit & known
            if k:
                rest[left[on]] = lv["rest"][ctx[on]]
                rest_distinct[left[on]] = lv["rest_distinct"][ctx[on]]
            escaped[left[on]] = True
            left = left[~hit]
        used = int(self.levels[0]["distinct"][0]) if len(self.levels[0]["distinct"]) else 0
        out[left] -= math.log10(256 - used)
        return out


def _answers(part: pa.Table, order: int, low: np.ndarray) -> pa.Table:
    """A shard's grams of all blocks: counts summed, the branch built, each block answered."""
    asked = [unpacked_keys(x.as_py()) for x in part.column("data")]
    counts = [_values(x.as_py(), np.int64) for x in part.column("counts")]
    keys, n = _counted(np.concatenate(asked), np.concatenate(counts))
    logs = Trie(order, keys[n > 0], n[n > 0], low).log10(keys)
    return pa.table({"kind": part.column("kind"), "block": part.column("block"), "data": part.column("data"),
                     "reply": pa.array([packed_logs(logs[np.searchsorted(keys, a)]) for a in asked], pa.binary())})


def _word_answers(part: pa.Table) -> pa.Table:
    """A shard's words of all blocks: training counts summed, each block answered; one row of totals."""
    words = [zstd(x.as_py()).split(b"\n") for x in part.column("data")]
    total: Counter = Counter()
    for mine, n in zip(words, part.column("counts")):
        for w, c in zip(mine, _values(n.as_py(), np.int64).tolist()):
            if c:
                total[w] += c
    answers = [_planes(np.array([total.get(w, 0) for w in mine], np.int64)) for mine in words]
    return pa.table({
        "kind": pa.array([WORDS] * len(words) + [LOW], pa.int32()),
        "block": pa.concat_arrays([*part.column("block").chunks, pa.array([-1], pa.int64())]),
        "data": pa.array([x.as_py() for x in part.column("data")] + [b""], pa.binary()),
        "reply": pa.array(answers + [f"{sum(total.values())} {len(total)}".encode()], pa.binary())})


def _score(texts: pa.Table, answers: pa.Table, order: int, train: int, distinct: int, ends: int, alpha: float) -> Iterator:
    """Scores of one block's documents."""
    below = train + alpha * (distinct + 1)
    base: dict[bytes, float] = {}
    unknown = math.log10(alpha / below)
    keys, logs = [np.array([none(order)])], [np.zeros(1, np.float32)]  # between texts: probability 1
    for kind, data, values in zip(*(answers.column(c) for c in ("kind", "data", "reply"))):
        if kind.as_py() == GRAMS:
            keys.append(unpacked_keys(data.as_py()))
            logs.append(unpacked_logs(values.as_py()))
        else:
            c = _values(values.as_py(), np.int64)
            base.update(zip(zstd(data.as_py()).split(b"\n"), np.where(c > 0, np.log10((c + alpha) / below), unknown).tolist()))
    table = GramTable(np.concatenate(keys), np.concatenate(logs))
    del keys, logs
    end = math.log10((ends + alpha) / below)
    for ids, held, sizes, data in zip(*(texts.column(c) for c in ("ids", "held", "sizes", "data"))):
        data, start, parts = zstd(data.as_py()), 0, []
        for size in sizes.as_py():
            parts.append(data[start:start + size])
            start += size
        places, starts = grams(parts, order)
        scores = np.add.reduceat(table[places].astype(np.float64), starts)
        rows = []
        for text, value in zip(parts, scores.tolist()):
            tokens = list(map(base.__getitem__, text.split()))
            known = len(tokens) - tokens.count(unknown) + (ends > 0)
            rows.append((len(tokens) + 1, known, train, math.fsum(tokens) + end, value))
        columns = list(zip(*rows)) if rows else [[]] * 5
        yield pa.RecordBatch.from_arrays(
            [ids.values, held.values, *[pa.array(c, pa.int64()) for c in columns[:3]],
             *[pa.array(c, pa.float64()) for c in columns[3:]]],
            ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])


def lm_scores(docs: DataFrame, order: int = ORDER, held_out: int = HELD_OUT, alpha: float = ALPHA,
              shards: int | None = SHARDS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for every row.

    The model learns from rows that are not held out and scores all of them, on texts
    with A-Z lower-cased.  ``base_score`` is the add-``alpha`` unigram score of the
    words and one end; ``score`` the trie's log10 probability of the bytes and the end.
    A null text is empty; an empty text has its end only.  A null doc_id hashes like
    the empty text.  Repeated rows count and are scored each time.  Texts are read
    whole, whatever their length.  Without a training row nothing is known and every
    byte is equally likely.  Other columns are not read, whatever their names.  An
    empty table gives no rows."""
    if not 2 <= order <= 7:
        raise ValueError("order must be 2 to 7")  # a gram is one long
    spark = docs.sparkSession
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    packs = _written(_packs(docs, order, shards, held_out, block_bytes), "ppm-packs")
    low = np.zeros(1 << 16, np.int64)
    # Summed over the blocks by Spark; at most 65,536 counts come to the driver.
    for key, n in _low_counts(packs).toLocalIterator():
        low[key] = n
    ends = int(low.reshape(256, 256)[:, END[0]].sum())  # one end per training document
    answer = "kind int, block long, data binary, reply binary"
    of = packs.select("kind", "block", "shard", "data", "counts")
    trie = of.where(F.col("kind") == GRAMS).groupBy("shard").applyInArrow(lambda part: _answers(part, order, low), answer)
    words = _written(of.where(F.col("kind") == WORDS).groupBy("shard").applyInArrow(_word_answers, answer), "ppm-words")
    totals = words.where(F.col("kind") == LOW).select(F.split(F.col("reply").cast("string"), " ").alias("v")).agg(
        F.sum(F.col("v")[0].cast("long")), F.sum(F.col("v")[1].cast("long"))).first()
    train, distinct = (totals[0] or 0) + ends, (totals[1] or 0) + (ends > 0)
    answers = trie.union(words.where(F.col("kind") == WORDS))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def score(texts: pa.Table, got: pa.Table) -> pa.Table:
        batches = list(_score(texts, got, order, train, distinct, ends, alpha))
        return pa.Table.from_batches(batches)

    blocks = packs.where(F.col("kind") == DOCS).select("block", "ids", "held", "sizes", "data")
    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        score, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, "
               "score double")


def _low_counts(packs: DataFrame) -> DataFrame:
    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total = np.zeros(1 << 16, np.int64)
            for keys, n in zip(batch.column("data"), batch.column("counts")):
                total[unpacked_keys(keys.as_py()).astype(np.int64)] += _values(n.as_py(), np.int64)
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at])], ["key", "n"])

    return (packs.where(F.col("kind") == LOW).select("data", "counts").mapInArrow(unpack, "key long, n long")
            .groupBy("key").agg(F.sum("n").alias("n")))
