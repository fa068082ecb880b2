"""Brute-force versions and small tables for the training-data operators."""

from __future__ import annotations

import hashlib
import re

import xxhash

SF = "/root/testdata/sf0.001"
DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Names that operators use inside; documents may bring columns of the same names.
CLASHES = ["th", "words", "n", "pos", "gram", "key", "place", "fp", "node", "block", "slot", "shard", "size",
           "hilbert", "tokens", "epoch", "h", "digest", "kept", "score", "host", "path", "body"]


def doc_rows(texts: dict) -> list[tuple]:
    return [(i, t, "en" if i is None or i % 2 else None, None if i is None else f"src{i % 3}", len(t or ""))
            for i, t in texts.items()]


def documents(spark, rows: list[tuple], clash: bool = True):
    """Documents with all the clashing extra columns."""
    df = spark.createDataFrame(rows, DOC_SCHEMA)
    if clash:
        from pyspark.sql import functions as F

        df = df.select("*", *[F.lit(f"x-{c}").alias(c) for c in CLASHES])
    return df


def edge_rows(long: str) -> list[tuple]:
    """Null id, null and empty text, no words, one very long text, ties, a repeated row, other text under a used id."""
    base = "the quick brown fox jumps over the lazy dog and then runs back home again before night falls"
    return [
        (1, base, "en", "a", 1), (2, base, "en", "b", 1), (2, base, "en", "b", 1), (3, None, None, None, None),
        (4, "", "en", "a", 0), (5, "?!. ,", "en", "a", 5), (6, long, "en", "a", len(long)),
        (7, base + " And MORE words follow here", "de", "c", 3), (None, base, "en", "a", 1),
        (8, "été naïve Straße übergröße ÉTÉ", "fr", "b", 9), (4, "other text under a used id", "en", "a", 4),
        (9, "ab " * 40, "en", "a", 120), (10, "ab " * 30, "en", "a", 90),
    ]


def words(text: str | None) -> list[str]:
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def contamination(docs: list[tuple], items: list[tuple], window: int = 10) -> list[tuple]:
    wins: dict[tuple, set] = {}
    for item, text in items:
        w = words(text)
        n = min(len(w), window)
        for i in range(len(w) - n + 1 if w else 0):
            wins.setdefault(tuple(w[i:i + n]), set()).add(item)
    sizes = {len(k) for k in wins}
    out = []
    for doc, text in docs:
        w = words(text)
        hit, found = set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                owners = wins.get(tuple(w[i:i + n]))
                if owners:
                    hit.update(range(i, i + n))
                    found |= owners
        ids = sorted(str(x) for x in found if x is not None)
        out.append((doc, len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def repeats(docs: list[tuple], length: int = 50) -> list[tuple]:
    least: dict[bytes, int] = {}
    bodies = [(i, (t or "").encode()) for i, t in docs]
    for i, b in bodies:
        if i is not None:
            for p in range(len(b) - length + 1):
                s = b[p:p + length]
                least[s] = min(least.get(s, i), i)
    out = []
    for i, b in bodies:
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if i is not None and least[b[p:p + length]] < i:
                gone[p:p + length] = b"\1" * length
        spans = sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1]))
        kept = bytes(c for c, g in zip(b, gone) if not g)
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def simhash(text: str | None, size: int = 4) -> int:
    w = re.findall(rb"[^\x20\x09-\x0D]+", bytes(text or "", "utf-8").lower())
    if not w:
        return 0
    shingles = [b" ".join(w[i:i + size]) for i in range(len(w) - size + 1)] or [b" ".join(w)]
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(docs: list[tuple], distance: int = 4) -> list[tuple]:
    fps = [(i, simhash(t)) for i, t in docs]
    root = list(range(len(fps)))

    def top(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a in range(len(fps)):
        for b in range(a):
            if (fps[a][1] ^ fps[b][1]).bit_count() <= distance:
                root[top(a)] = top(b)
    least: dict[int, int | None] = {}
    for k, (i, _) in enumerate(fps):
        r = top(k)
        if i is not None and (least.get(r) is None or i < least[r]):
            least[r] = i
        least.setdefault(r, None)
    return sorted(((i, f"{fp:016x}", least[top(k)]) for k, (i, fp) in enumerate(fps)), key=repr)


def rows_of(df, *columns: str) -> list[tuple]:
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
