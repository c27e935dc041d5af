"""URL filter rules as a range join of sorted keys.

A host is turned round, ``www.example.net`` becomes ``net.example.www.``, so that a host and
all its subdomains are one interval of keys. Urls are range-partitioned and sorted by key;
each partition gets the rules whose interval touches it; one sweep over urls and rules keeps
the stack of rules that are open. The longest rule wins: the longest host, then the longest
path; of equal rules with different verdicts, block.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from proxysift.llm.common import ascii_lower
from proxysift.session import durable

ALLOW, BLOCK = "allow", "block"

# Kinds of rows in the sweep; of one key, rules come first.
_RULE, _URL, _NO_ID = 0, 1, 2

_OUT = "page_id bigint, host string, path string, rule string, verdict string"


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"://([^/?#]*)", 1), F.lit("")))


def url_path(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def host_key(host: Column) -> Column:
    """Labels from the last to the first, each ended by a dot; empty for an empty host."""
    turned = F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit("."))
    return F.when(host == "", F.lit("")).otherwise(turned)


def _copies(bounds: list[tuple[int, str, str]]):
    """Copy each rule to the partitions that its interval touches."""
    parts, lows, highs = map(list, zip(*bounds, strict=True)) if bounds else ([], [], [])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rules in batches:
            rows = []
            for key, path, verdict in rules.itertuples(index=False):
                at = bisect_left(highs, key)
                while at < len(parts) and (lows[at] <= key or lows[at].startswith(key)):
                    rows.append((parts[at], key, _RULE, path, verdict, 0, None))
                    at += 1
            yield pd.DataFrame(rows, columns=["part", "key", "kind", "path", "verdict", "page_id", "host"]).astype(
                {"page_id": "int64", "part": "int32", "kind": "int32"}
            )

    return run


def _text(key: str) -> str:
    return ".".join(reversed(key[:-1].split(".")))


def _sweep(default: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, stack = None, []  # open rules: (key, path -> verdict, path lengths from the longest)
        for batch in batches:
            rows = []
            for at, key, kind, path, verdict, page, host in batch.itertuples(index=False):
                if at != part:
                    part, stack = at, []
                while stack and not key.startswith(stack[-1][0]):
                    stack.pop()
                if kind == _RULE:
                    if not stack or stack[-1][0] != key:
                        stack.append((key, {}, []))
                    _, paths, lengths = stack[-1]
                    if paths.get(path) != BLOCK:
                        paths[path] = verdict
                    if len(path) not in lengths:
                        lengths.append(len(path))
                        lengths.sort(reverse=True)
                    continue
                found = next(
                    ((k, path[:n], paths[path[:n]]) for k, paths, lengths in reversed(stack)
                     for n in lengths if path[:n] in paths and n <= len(path)),
                    None,
                )
                rule = None if found is None else _text(found[0]) + found[1]
                rows.append((None if kind == _NO_ID else page, host, path, rule, default if found is None else found[2]))
            ids = pd.array([row[0] for row in rows], dtype="Int64")
            out = pd.DataFrame(rows, columns=["page_id", "host", "path", "rule", "verdict"])
            yield out.assign(page_id=ids)

    return run


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = ALLOW) -> DataFrame:
    """``page_id, host, path, rule, verdict`` for each row of ``pages`` (``page_id, url``).

    ``rules`` has ``host, path, verdict``; a rule without a host is left out, a null path
    fits every path. A null url or one without ``://`` has an empty host and path, which
    only a rule with an empty host fits. Equal urls are spread by page_id, so a url that
    holds most rows fills several partitions; repeated rows each get their verdict.
    """
    urls = pages.select("page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    keyed = urls.withColumn("key", host_key(F.col("host")))
    order = ["key", "path", "page_id"]
    placed = durable(keyed.repartitionByRange(*order).withColumn("part", F.spark_partition_id()))
    # One row per partition comes to the driver.
    ends = placed.groupBy("part").agg(F.min("key").alias("low"), F.max("key").alias("high")).collect()
    bounds = sorted((r.low, r.high, r.part) for r in ends)
    keys = (
        rules.where("host IS NOT NULL")
        .select(
            host_key(ascii_lower(F.col("host"))).alias("key"),
            F.coalesce(F.col("path"), F.lit("")).alias("path"), "verdict",
        )
    )
    both = "part int, key string, kind int, path string, verdict string, page_id bigint, host string"
    copied = keys.mapInPandas(_copies([(p, low, high) for low, high, p in bounds]), both)
    rows = placed.select(
        "part", "key", F.when(F.col("page_id").isNull(), _NO_ID).otherwise(_URL).alias("kind"), "path",
        F.lit(None).cast("string").alias("verdict"), F.coalesce("page_id", F.lit(0)).alias("page_id"), "host",
    )
    sorted_rows = copied.unionByName(rows).repartition("part").sortWithinPartitions("part", "key", "kind")
    return sorted_rows.mapInPandas(_sweep(default), _OUT)
