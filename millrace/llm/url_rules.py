"""URL filters as a sort-merge range join with a sweep."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.storage import measured

#: Bytes of rules that one pass over the urls takes along to every task.
MAX_RULE_BYTES = 16 << 20


_ASKED = ("id", "host", "path", "at")
_FOUND = {"rule": pa.string(), "verdict": pa.string(), "size": pa.int32(), "host_size": pa.int32()}


def host_of(url: Column) -> Column:
    """What stands between the first `://` and the next `/`, `?`, `#` or the end, A-Z lower-cased."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host up to `?`, `#` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def host_key(host: Column) -> Column:
    """The labels reversed, each closed by `/`, which no host holds.

    The key of a host is a prefix of the keys of its subdomains and of no others.
    """
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "/"), F.lit("/"))


class _Sweep:
    """Rules against keys in ascending order; the stack holds the hosts whose interval is open."""

    def __init__(self, rules: list[tuple[str, str, str, str]]) -> None:
        self._hosts: list[tuple[str, str, list[tuple[str, str]]]] = []
        for key, host, path, verdict in sorted(rules):
            if not self._hosts or self._hosts[-1][0] != key:
                self._hosts.append((key, host, []))
            self._hosts[-1][2].append((path, verdict))
        self._next = 0
        self._stack: list[tuple[str, str, list[tuple[str, str]]]] = []

    def best(self, key: str, path: str) -> tuple[str, str, int, int] | None:
        """Rule, verdict, length of the rule and of its host."""
        while self._next < len(self._hosts) and self._hosts[self._next][0] <= key:
            opened = self._hosts[self._next]
            while self._stack and not opened[0].startswith(self._stack[-1][0]):
                self._stack.pop()
            self._stack.append(opened)
            self._next += 1
        while self._stack and not key.startswith(self._stack[-1][0]):
            self._stack.pop()
        found = None
        for _, host, paths in reversed(self._stack):
            hit = _longest_prefix(paths, path)
            if hit is not None and (found is None or len(host) + len(hit[0]) > found[2]):
                found = (host + hit[0], hit[1], len(host) + len(hit[0]), len(host))
        return found


def _longest_prefix(paths: list[tuple[str, str]], path: str) -> tuple[str, str] | None:
    """The last path at or before `path` is its longest prefix, or tells how much to cut off."""
    end = path
    while True:
        i = bisect_right(paths, end, key=lambda p: p[0]) - 1
        if i < 0:
            return None
        found = paths[i]
        if path.startswith(found[0]):
            return found
        shared = 0
        while shared < len(found[0]) and shared < len(end) and found[0][shared] == end[shared]:
            shared += 1
        end = end[:shared]


def url_verdicts(
    pages: DataFrame,
    rules: DataFrame,
    *,
    key: str = "page_id",
    url: str = "url",
    default: str = "allow",
    max_rule_bytes: int = MAX_RULE_BYTES,
) -> DataFrame:
    """The rule that decides each url.

    `rules` has host, path and verdict (allow or block). A rule fits its host and all of its
    subdomains if the url's path starts with the rule's path. The longest rule (host and path
    together) wins, of equally long ones that with the longer host. Of rules equal in host and
    path a block wins. Rules with a null in host, path or verdict are left out.

    Returns `key`, host, path, rule (null if none fits) and verdict (`default` then). A null
    url, and one without `://`, has empty host and path. Repeated rows stay; other columns of
    `pages` are not looked at, so they may have any name.

    The urls are not shuffled: each task sorts its urls by reversed host and merges them with
    the sorted rules, so a host that holds most rows stays spread over the tasks. Rules beyond
    `max_rule_bytes` are merged in several passes, each with a range of the rules.
    """
    spark = pages.sparkSession
    given = (
        rules.select("host", "path", "verdict")
        .dropna()
        .groupBy("host", "path")
        .agg(F.max("verdict").alias("verdict"))
        .select(host_key(F.col("host")).alias("at"), "host", "path", "verdict")
    )
    blocks = _blocks(given, max_rule_bytes)
    swept = (
        pages.select(F.col(key).alias("id"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
        .withColumn("at", host_key(F.col("host")))
        .withColumn("rule", F.lit(None).cast("string"))
        .withColumn("verdict", F.lit(None).cast("string"))
        .withColumn("size", F.lit(-1))
        .withColumn("host_size", F.lit(-1))
    )
    schema = swept.schema
    for block in blocks:
        shared = spark.sparkContext.broadcast(block)
        swept = swept.sortWithinPartitions("at").mapInArrow(_merge(shared), schema)
    return swept.select(
        F.col("id").alias(key), "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict")
    )


def _blocks(rules: DataFrame, max_bytes: int) -> list[list[tuple[str, str, str, str]]]:
    """The rules in parts of a bounded size, dealt by a hash of the host."""
    rows, size = measured(rules)
    n = max(1, -(-size // max_bytes))
    if not rows:
        return []
    if n == 1:
        return [[tuple(r) for r in rules.collect()]]
    part = F.pmod(F.xxhash64("at"), F.lit(n))
    return [[tuple(r) for r in rules.where(part == i).collect()] for i in range(n)]


def _merge(shared):
    def merge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sweep = _Sweep(shared.value)
        for batch in batches:
            old = zip(*(batch.column(c).to_pylist() for c in _FOUND))
            rows = []
            for at, path, was in zip(batch.column("at").to_pylist(), batch.column("path").to_pylist(), old):
                now = sweep.best(at, path)
                better = now is not None and now[2:] > was[2:]
                rows.append(now if better else was)
            found = zip(*rows) if rows else ((), (), (), ())
            columns = [batch.column(c) for c in _ASKED] + [pa.array(x, t) for x, t in zip(found, _FOUND.values())]
            yield pa.RecordBatch.from_arrays(columns, names=[*_ASKED, *_FOUND])

    return merge
