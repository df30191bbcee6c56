"""URL rules by a sort-merge range join.

A host's labels in reverse order, each closed by a dot, are its canonical key: a rule's host and all its subdomains
are then the interval of keys with the rule's key as prefix. Pages are range-partitioned and sorted by key; a sweep
over each sorted partition keeps the stack of rule hosts whose intervals are open, which are nested. Of the open
hosts' path prefixes the longest rule (host and path) that fits wins; of two of one length the longer host.

Rules go to the tasks in broadcasts of at most `RULES_AT_ONCE`; a larger list is swept in further passes over the
same order, each carrying the best rule so far, so no rule is left out. Hot hosts are split by path and page_id in
the range partitioning, so no host has to fit a task.

Defined cases: a null url or one without :// has an empty host and path and fits no rule; a page without a rule
gets the default verdict; a rule given twice counts once, with block if its verdicts differ. Repeated rows each
give a row; empty tables give empty results. Only page_id and url are read, never the html.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RULES_AT_ONCE = 100_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def rule_key(host: str) -> str:
    return ".".join(reversed(host.split("."))) + "."


def judge(pages: DataFrame, rules: list[tuple[str, str]], default: str = "allow") -> DataFrame:
    """page_id, host, path, rule, verdict; rules are (host/path, verdict)."""
    host, path = host_and_path(F.col("url"))
    out = pages.select("page_id", host.alias("host"), path.alias("path"))
    out = out.withColumn("key", canonical(F.col("host"))).withColumn("rule", F.lit(None).cast("string")).withColumn("verdict", F.lit(default))
    out = out.repartitionByRange("key", "path", "page_id").sortWithinPartitions("key", "path")
    merged: dict[str, str] = {}
    for rule, verdict in rules:
        merged[rule] = "block" if merged.get(rule, verdict) != verdict else verdict
    listed = sorted(merged.items())
    for start in range(0, len(listed), RULES_AT_ONCE):
        out = _sweep(out, listed[start : start + RULES_AT_ONCE])
    return out.select("page_id", "host", "path", "rule", "verdict")


def _sweep(pages: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    hosts: dict[str, list[tuple[int, str, str, str]]] = {}
    for rule, verdict in rules:
        host, slash, path = rule.partition("/")
        hosts.setdefault(rule_key(host), []).append((len(rule), slash + path, rule, verdict))
    for own in hosts.values():
        own.sort(reverse=True)
    shared = pages.sparkSession.sparkContext.broadcast(sorted((k.encode(), own) for k, own in hosts.items()))

    def run(batches):
        intervals, at = shared.value, 0
        stack: list[tuple[bytes, list]] = []
        for batch in batches:
            rule, verdict = batch.column("rule").to_pylist(), batch.column("verdict").to_pylist()
            keys = [k.encode() for k in batch.column("key").to_pylist()]
            for i, (key, path) in enumerate(zip(keys, batch.column("path").to_pylist(), strict=True)):
                # Close what the key has left, then open what starts at or before it.
                while stack and not key.startswith(stack[-1][0]):
                    stack.pop()
                while at < len(intervals) and intervals[at][0] <= key:
                    if key.startswith(intervals[at][0]):
                        stack.append(intervals[at])
                    at += 1
                best = len(rule[i]) if rule[i] is not None else -1
                for _, own in reversed(stack):
                    fit = next((x for x in own if path.startswith(x[1])), None)
                    if fit and fit[0] > best:
                        best, rule[i], verdict[i] = fit[0], fit[2], fit[3]
            for name, values in (("rule", rule), ("verdict", verdict)):
                at_col = batch.schema.get_field_index(name)
                batch = batch.set_column(at_col, batch.schema.field(at_col), pa.array(values, batch.schema.field(at_col).type))
            yield batch

    return pages.mapInArrow(run, pages.schema)
