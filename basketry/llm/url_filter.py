"""URL filters as a sort-merge range join.

A host becomes a canonical key: its labels reversed, each followed by a dot
(``com.example.www.``).  A rule's host then covers one key interval, the keys
that start with its own, and the intervals of all rules nest or are disjoint.
URLs and rules are merged into one range-partitioned, sorted stream, and a
sweep per partition keeps the stack of rules whose interval is open.  Each URL
is judged by the open rules alone.

A partition may begin inside open intervals.  Its first key names the host prefixes
that can be open there; the rules of those prefixes are joined to it as rows, which
go to the head of its stream and open the stack.  No rule passes through the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import ascii_lower, durable

DEFAULT_VERDICT = "allow"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1)
    return ascii_lower(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    """From the host's end up to ``?``, ``#`` or the end."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1)
    return F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)


def host_key(host: Column) -> Column:
    """Labels reversed, each with a closing dot; the empty host is the empty key."""
    key = F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit("."))
    return F.when(host == "", F.lit("")).otherwise(key)


def _judge(stack: list[tuple[str, dict]], path: str) -> tuple[str, str] | None:
    """Longest fitting (rule, action): host and path length together, then the longer host."""
    best = None
    for _, rules in stack:
        for cut in rules["lengths"]:
            hit = rules["paths"].get(path[:cut]) if cut <= len(path) else None
            if hit and (best is None or len(hit[0]) >= len(best[0])):
                best = hit
    return best


def _opened(stack: list[tuple[str, dict]], key: str, path: str, rule: str, action: str) -> None:
    if not stack or stack[-1][0] != key:
        stack.append((key, {"paths": {}, "lengths": []}))
    at = stack[-1][1]
    old = at["paths"].get(path)
    # The same rule with two verdicts: block wins.
    at["paths"][path] = (rule, "block" if old and old[1] == "block" else action)
    at["lengths"] = sorted({len(p) for p in at["paths"]})


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = DEFAULT_VERDICT) -> DataFrame:
    """``page_id, host, path, rule, verdict``: one row per input row.

    ``rules`` has ``host, path, action`` (allow or block).  A rule fits its
    host and all subdomains when the URL's path starts with the rule's; the
    longest rule wins (the longer host among equals).  A URL without a fitting
    rule has a null ``rule`` and the ``default`` verdict.  A null URL or one
    without ``://`` has an empty host and path and fits no rule.  Rules with a
    null or empty host are ignored, a null path is empty, and of two actions
    for one rule ``block`` wins.  Repeated and tied rows are judged one by one;
    very long URLs are read whole; other columns are not read; an empty table of pages or
    rules gives no rows or default verdicts.
    """
    urls = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    urls = urls.select("page_id", "host", "path", host_key(F.col("host")).alias("key"), F.lit(1).alias("kind"),
                       F.lit(None).cast("string").alias("action"))
    known = rules.select(
        F.lit(None).cast(pages.schema["page_id"].dataType).alias("page_id"), ascii_lower(F.col("host")).alias("host"),
        F.coalesce("path", F.lit("")).alias("path"), F.lower("action").alias("action")
    ).where("coalesce(host, '') != ''").distinct()
    known = durable(known.select("page_id", "host", "path", host_key(F.col("host")).alias("key"),
                                 F.lit(0).alias("kind"), "action"))
    # Rules sort before the URLs of their own host; paths and ids split a hot host.
    order = ["key", "kind", "path", "page_id", "action"]
    merged = durable(urls.unionByName(known).repartitionByRange(*order).withColumn("run", F.spark_partition_id())
                     .withColumn("lead", F.lit(1)))
    firsts = merged.groupBy("run").agg(F.min("key").alias("first"))  # a row per partition
    labels = F.split("first", r"\.", -1)
    prefix = F.transform(F.sequence(F.lit(1), F.size(labels) - 1),
                         lambda i: F.concat(F.array_join(F.slice(labels, F.lit(1), i), "."), F.lit(".")))
    opening = firsts.where("first != ''").select("run", F.explode(prefix).alias("key"))
    seeds = known.join(opening, "key").withColumn("lead", F.lit(0))
    runs = (merged.agg(F.coalesce(F.max("run"), F.lit(0))).first()[0]) + 1
    streams = merged.unionByName(seeds).repartitionById(runs, "run").sortWithinPartitions("lead", *order)

    def sweep(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        stack: list[tuple[str, dict]] = []
        for frame in frames:
            out = []
            for page, host, path, key, kind, action in zip(*(frame[c] for c in (
                    "page_id", "host", "path", "key", "kind", "action"))):
                while stack and not key.startswith(stack[-1][0]):
                    stack.pop()
                if kind == 0:
                    _opened(stack, key, path, host + path, action)
                else:
                    hit = _judge(stack, path)
                    out.append((page, host, path, hit[0] if hit else None, hit[1] if hit else default))
            yield pd.DataFrame(out, columns=["page_id", "host", "path", "rule", "verdict"])

    page_id = pages.schema["page_id"].dataType.simpleString()
    return streams.select("page_id", "host", "path", "key", "kind", "action").mapInPandas(sweep, f"page_id {page_id}, host string, path string, rule string, verdict string")


def allowed_pages(pages: DataFrame, rules: DataFrame, default: str = DEFAULT_VERDICT) -> DataFrame:
    """The pages whose URL is allowed, with all their columns."""
    verdicts = judge_urls(pages, rules, default).where("verdict = 'block'").select(
        F.col("page_id").alias("__id"), F.col("host").alias("__host"), F.col("path").alias("__path")).distinct()
    on = (pages["page_id"].eqNullSafe(verdicts["__id"]) & (host_of(pages["url"]) == verdicts["__host"])
          & (path_of(pages["url"]) == verdicts["__path"]))
    return pages.join(verdicts, on, "left_anti")
