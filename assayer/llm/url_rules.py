"""URL filter by a sort-merge range join of urls and nested prefix rules.

A host is turned round (``www.example.com`` becomes ``com.example.www.``), so that a host and all its subdomains share a
prefix: one interval of the sorted keys. Each partition is sorted by that key, which needs no shuffle and spills to disk, and
swept once together with the sorted rules. A stack holds the rule hosts whose intervals are open at the current key; each
carries its paths as nested intervals too. The longest rule on the stack that fits decides.

The rules are sorted and handed to the tasks in blocks of at most ``BLOCK_RULES``; more rules mean more sweeps over the rows,
not a larger broadcast. Between sweeps the better rule stays.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayer.llm.common import LETTERS, picked

BLOCK_RULES = 500_000


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; empty without ``://``."""
    return F.translate(F.regexp_extract(_after_scheme(url), r"^([^/?#]*)", 1), LETTERS, LETTERS.lower())


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def turned(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, "\\.", -1)), "."), F.lit("."))


@dataclass
class Node:
    """The rules of one host: its key and its paths, sorted, each with the nearest path that is a prefix of it."""

    key: str
    paths: list[str] = field(default_factory=list)
    rules: list[tuple] = field(default_factory=list)
    outer: list[int] = field(default_factory=list)

    def add(self, path: str, rule: tuple) -> None:
        """Paths come in order; of equal paths the last one holds."""
        if self.paths and self.paths[-1] == path:
            self.rules[-1] = rule
            return
        up = len(self.paths) - 1
        while up >= 0 and not path.startswith(self.paths[up]):
            up = self.outer[up]
        self.paths.append(path)
        self.rules.append(rule)
        self.outer.append(up)

    def longest(self, path: str) -> tuple | None:
        at = bisect.bisect_right(self.paths, path) - 1
        while at >= 0 and not path.startswith(self.paths[at]):
            at = self.outer[at]
        return self.rules[at] if at >= 0 else None


def nodes_of(rules: list[tuple[str, str, str, str]]) -> list[Node]:
    """Nodes from sorted (key, path, rule, verdict) rows, in the order of their keys."""
    nodes: list[Node] = []
    for key, path, rule, verdict in rules:
        if not nodes or nodes[-1].key != key:
            nodes.append(Node(key))
        nodes[-1].add(path, _merit(rule, len(rule) - len(path), verdict))
    return nodes


def _merit(rule: str, host: int, verdict: str) -> tuple[int, int, bool, str, str]:
    """What decides between rules that fit: length, length of the host, ``block`` over others; then the rule and its verdict."""
    return len(rule), host, verdict == "block", rule, verdict


def sweep(batches: Iterator[pa.RecordBatch], nodes: list[Node]) -> Iterator[pa.RecordBatch]:
    """One pass over batches sorted by ``key``; fills in rule and verdict where a longer rule fits."""
    at, stack, last = 0, [], ""
    for batch in batches:
        keys, paths = batch.column("key").to_pylist(), batch.column("path").to_pylist()
        rules, verdicts = batch.column("rule").to_pylist(), batch.column("verdict").to_pylist()
        for row, (key, path) in enumerate(zip(keys, paths, strict=True)):
            if key != last:
                while at < len(nodes) and nodes[at].key <= key:
                    while stack and not nodes[at].key.startswith(stack[-1].key):
                        stack.pop()
                    stack.append(nodes[at])
                    at += 1
                while stack and not key.startswith(stack[-1].key):
                    stack.pop()
                last = key
            found = [r for node in stack if (r := node.longest(path))]
            if found:
                best = max(found, key=lambda r: r[:3])
                if rules[row] is None or best[:3] > _merit(rules[row], (rules[row] + "/").index("/"), verdicts[row])[:3]:
                    rules[row], verdicts[row] = best[3:]
        yield batch.set_column(batch.schema.get_field_index("rule"), "rule", pa.array(rules, pa.string())).set_column(
            batch.schema.get_field_index("verdict"), "verdict", pa.array(verdicts, pa.string())
        )


def judged(pages: DataFrame, rules: DataFrame, default: str = "allow", id_column="page_id", url_column="url") -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict.

    ``rules`` has host, path and verdict. A rule fits its host and all subdomains where the url's path starts with its own;
    of several the longest (host and path together) wins, then the one of the longer host, then ``block`` over ``allow``. A
    rule with a null host, path or verdict fits nothing. Without a fitting rule the verdict is ``default`` and the rule null.
    Urls that are null or have no ``://`` have an empty host and path, which no rule with a host fits. Repeated pages are
    judged each; empty tables give no rows, or the default for all.
    """
    rows = picked(pages, id=id_column, url=url_column)
    url = F.coalesce("url", F.lit(""))
    rows = rows.select("id", host_of(url).alias("host"), path_of(url).alias("path"))
    rows = rows.withColumns({"key": turned(F.col("host")), "rule": F.lit(None).cast("string")})
    rows = rows.withColumn("verdict", F.lit(None).cast("string"))
    known = picked(rules, host="host", path="path", verdict="verdict").dropna()
    known = known.withColumn("host", F.translate("host", LETTERS, LETTERS.lower()))
    known = known.select(turned(F.col("host")).alias("key"), "path", F.concat("host", "path").alias("rule"), "verdict")
    blocks = -(-known.count() // BLOCK_RULES)
    known = known.withColumn("block", F.pmod(F.xxhash64("key"), F.lit(max(1, blocks))))
    schema = T.StructType(rows.schema.fields)
    for block in range(blocks):
        nodes = nodes_of(sorted(map(tuple, known.where(F.col("block") == block).drop("block").collect()), key=_rule_order))
        shared = pages.sparkSession.sparkContext.broadcast(nodes)
        rows = rows.sortWithinPartitions("key").mapInArrow(lambda batches, shared=shared: sweep(batches, shared.value), schema)
    return rows.select(F.col("id").alias(id_column), "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))


def _rule_order(rule: tuple[str, str, str, str]) -> tuple[str, str, bool]:
    return rule[0], rule[1], rule[3] == "block"
