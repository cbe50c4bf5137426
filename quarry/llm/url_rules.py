"""URL allow / block rules by a sorted sweep over reversed-host keys.

A rule is ``(host, path, action)``; it fits its host and every subdomain when the
url's path starts with the rule's path, and the longest fitting rule wins.  The labels
of a host in reverse order, each closed by a dot (``www.example.com`` ->
``com.example.www.``), turn "host and subdomains" into a prefix, and a prefix into the
half-open key interval ``[key, key + U+10FFFF)``.  Intervals of prefixes nest, so one pass
over the sorted urls with a stack of the rules whose interval is open yields every
fitting rule.

Spark range-partitions the urls on (key, path, id), so a host with a third of the rows is
spread over many tasks; each task sweeps its own sorted run, starting with the rules whose
intervals are open at its first key.  The rules are the operator's parameter: a block of at
most ``rules_per_block`` rules travels with the task, and more rules mean more passes whose
longest winner is kept.

Nulls: a null url, or one without ``://``, has an empty host and path, fits no rule and
gets the default verdict.  Repeated rows are judged alike.  An empty table gives no rows.
Input columns beyond the id and the url are ignored, whatever their names.  Two rules with
the same host and path: ``block`` wins.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Rule = tuple[str, str, str]

#: Sorts behind every character that can follow a key.
_LAST = "\U0010ffff"


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    lower = F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(lower, F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def reversed_host(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def _key(host: str) -> str:
    return ".".join(reversed(host.split("."))) + "."


class Sweep:
    """The stack of open rule intervals while keys come in ascending order."""

    def __init__(self, rules: Sequence[Rule]):
        ordered = sorted(set(rules), key=lambda r: (_key(r[0]), r[1], r[2] != "allow"))
        self.intervals = []
        for key, group in groupby(ordered, key=lambda r: _key(r[0])):
            paths = {path: (f"{host}{path}", action) for host, path, action in group}
            self.intervals.append((key, key + _LAST, paths, sorted({len(p) for p in paths}, reverse=True)))
        self.next = 0
        self.stack: list[tuple] = []

    def seek(self, key: str) -> None:
        """Close the intervals that end at or before ``key`` and open those that start."""
        while self.stack and self.stack[-1][1] <= key:
            self.stack.pop()
        while self.next < len(self.intervals) and self.intervals[self.next][0] <= key:
            interval = self.intervals[self.next]
            self.next += 1
            if interval[1] > key:
                while self.stack and self.stack[-1][1] < interval[1]:
                    self.stack.pop()
                self.stack.append(interval)

    def best(self, path: str) -> tuple[str, str] | None:
        """The longest rule of the stack whose path is a prefix of ``path``; between rules
        of equal length the one of the more specific host."""
        found = None
        for _, _, paths, lengths in reversed(self.stack):
            for n in lengths:
                hit = paths.get(path[:n]) if n <= len(path) else None
                if hit:
                    if found is None or len(hit[0]) > len(found[0]):
                        found = hit
                    break
        return found


def judge(pages: DataFrame, rules: Sequence[Rule], id_col: str = "page_id", url_col: str = "url",
          default: str = "allow", rules_per_block: int = 200_000) -> DataFrame:
    """``(id, host, path, rule, verdict)`` for every row of ``pages``."""
    cut = pages.select(F.col(id_col).alias("id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    keyed = cut.withColumn("key", reversed_host(F.col("host")))
    dealt = keyed.repartitionByRange("key", "path", "id").sortWithinPartitions("key", "path", "id")
    blocks = [list(rules[i:i + rules_per_block]) for i in range(0, len(rules), rules_per_block)] or [[]]

    def sweep(batches):
        open_ = [Sweep(block) for block in blocks]
        last, seen = None, False
        for batch in batches:
            keys, paths = batch.column("key").to_pylist(), batch.column("path").to_pylist()
            rule, verdict = [], []
            for key, path in zip(keys, paths):
                if not seen or key != last:
                    for s in open_:
                        s.seek(key)
                    last, seen = key, True
                hits = [h for h in (s.best(path) for s in open_) if h]
                hit = max(hits, key=lambda h: len(h[0]), default=(None, default))
                rule.append(hit[0])
                verdict.append(hit[1])
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("host"), batch.column("path"), pa.array(rule, pa.string()), pa.array(verdict, pa.string())],
                names=["id", "host", "path", "rule", "verdict"])

    id_type = cut.schema["id"].dataType.simpleString()
    out = dealt.mapInArrow(sweep, f"id {id_type}, host string, path string, rule string, verdict string")
    return out.withColumnRenamed("id", id_col)
