"""URL rules by a sort-merge range join.

A rule names a host, with all its subdomains, and the beginning of a path. Written with its
labels reversed (``com.example.www.``) a host's subdomains are exactly the keys that begin
with the host's key: an interval of the sorted keys, and two such intervals are nested or
apart. Rules and pages are sorted together by key and range-partitioned; a sweep keeps the
stack of rules whose interval the current key lies in.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chainlake.llm.base import in_slices

SAMPLE = 100_000
# Pages that one range of keys holds about.
RANGE = 500_000


def host_of(url: Column) -> Column:
    """What stands after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in
    lower case; empty for null and for urls without ``://``."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1)
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(host, upper, upper.lower())


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1)
    return F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def host_key(host: Column) -> Column:
    """Labels from the last to the first, each ended by a character below all others, so
    that keys sort label by label."""
    return F.when(host == "", F.lit("")).otherwise(
        F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "\x01"), F.lit("\x01"))
    )


def cut_points(keyed: DataFrame) -> list[str]:
    """Keys that cut the pages to ranges of about RANGE rows. They come from a bounded sample
    and decide only which task a page goes to; a key of many pages is a cut point several
    times."""
    total = keyed.count()
    ranges = -(-total // RANGE)
    if ranges < 2:
        return []
    some = keyed.where(F.rand(7) < SAMPLE / total).select("_key").limit(2 * SAMPLE)
    keys = sorted(row[0].encode() for row in some.collect())
    return [keys[len(keys) * i // ranges].decode() for i in range(1, ranges)] if keys else []


class Stack:
    """The rules whose interval holds the current key, outermost first."""

    def __init__(self):
        self.levels: list[tuple[str, str, dict[str, str]]] = []

    def forget(self) -> None:
        self.levels = []

    def move(self, key: str) -> None:
        while self.levels and not key.startswith(self.levels[-1][0]):
            self.levels.pop()

    def add(self, key: str, host: str, path: str, verdict: str) -> None:
        self.move(key)
        if not self.levels or self.levels[-1][0] != key:
            self.levels.append((key, host, {}))
        paths = self.levels[-1][2]
        # Of rules that differ in nothing but the verdict, block wins.
        paths[path] = "block" if "block" in (verdict, paths.get(path)) else verdict

    def best(self, key: str, host: str, path: str) -> tuple[str | None, str | None]:
        """The longest rule that fits, and its verdict; of equally long ones that with the
        longer host."""
        self.move(key)
        found: tuple[int, int, str, str] | None = None
        for _, name, paths in self.levels:
            if host != name and not host.endswith("." + name):
                continue
            for length in sorted({len(p) for p in paths}, reverse=True):
                start = path[:length]
                if len(start) == length and start in paths:
                    one = (len(name) + length, len(name), name + start, paths[start])
                    found = one if found is None else max(found, one)
                    break
        return (None, None) if found is None else (found[2], found[3])


def judge(
    pages: DataFrame, rules: DataFrame, default: str = "allow", id: str = "page_id", url: str = "url"
) -> DataFrame:
    """The longest fitting rule of every page: ``page_id, host, path, rule, verdict``.

    ``rules`` has ``host, path, verdict`` (allow or block). A rule fits its host and all
    subdomains when the page's path starts with the rule's. Pages without one get
    ``default``; null urls and those without ``://`` have an empty host and path and fit no
    rule. Rules with a null or empty host fit nothing; a null path is empty. One row per
    input row, repeated rows and null ids included; other columns are ignored.
    """
    link = F.col(f"`{url}`").cast("string")
    keyed = pages.select(F.col(f"`{id}`").alias("page_id"), host_of(link).alias("host"), path_of(link).alias("path"))
    keyed = keyed.withColumn("_key", host_key(F.col("host")))
    kind = keyed.schema["page_id"].dataType.simpleString()
    cuts = cut_points(keyed)
    raw = [c.encode() for c in cuts]

    def page_range(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = 0
        for batch in batches:
            where = []
            for key in batch.column(batch.schema.get_field_index("_key")).to_pylist():
                low, high = bisect.bisect_left(raw, key.encode()), bisect.bisect_right(raw, key.encode())
                # A key that fills several ranges is dealt out to them in turn.
                where.append(low + turn % (high - low + 1))
                turn += 1
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(where, pa.int32())], names=[*batch.schema.names, "_range"])

    def rule_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            where, take = [], []
            for i, key in enumerate(batch.column(batch.schema.get_field_index("_key")).to_pylist()):
                # The interval ends below the key with its last character raised by one.
                end = key[:-1].encode() + b"\x02"
                span = range(bisect.bisect_left(raw, key.encode()), bisect.bisect_left(raw, end) + 1)
                where += span
                take += [i] * len(span)
            out = pa.Table.from_batches([batch]).take(pa.array(take, pa.int64())).append_column("_range", pa.array(where, pa.int32()))
            yield from in_slices(out.combine_chunks())

    on_pages = keyed.mapInArrow(page_range, f"page_id {kind}, host string, path string, _key string, _range int")
    clean = rules.select(
        F.translate(F.col("host").cast("string"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz").alias("host"),
        F.coalesce(F.col("path").cast("string"), F.lit("")).alias("path"), F.col("verdict").cast("string").alias("verdict"),
    ).where("host != ''")
    on_rules = clean.withColumn("_key", host_key(F.col("host"))).mapInArrow(
        rule_ranges, "host string, path string, verdict string, _key string, _range int"
    )
    both = on_pages.select("_range", "_key", F.lit(1).alias("_kind"), "page_id", "host", "path", F.lit(None).cast("string").alias("verdict")).unionByName(
        on_rules.select("_range", "_key", F.lit(0).alias("_kind"), F.lit(None).cast(kind).alias("page_id"), "host", "path", "verdict")
    )
    ordered = both.repartition(len(cuts) + 1, "_range").sortWithinPartitions("_range", "_key", "_kind")

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stack, current = Stack(), None
        for batch in batches:
            got = batch.to_pydict()
            take, names, verdicts = [], [], []
            for i in range(batch.num_rows):
                if got["_range"][i] != current:
                    current = got["_range"][i]
                    stack.forget()
                key, host, path = got["_key"][i], got["host"][i], got["path"][i]
                if got["_kind"][i] == 0:
                    stack.add(key, host, path, got["verdict"][i])
                    continue
                rule, verdict = stack.best(key, host, path)
                take.append(i)
                names.append(rule)
                verdicts.append(verdict or default)
            if take:
                rows = batch.take(pa.array(take))
                yield pa.RecordBatch.from_arrays(
                    [*[rows.column(rows.schema.get_field_index(c)) for c in ("page_id", "host", "path")], pa.array(names, pa.string()), pa.array(verdicts, pa.string())],
                    names=["page_id", "host", "path", "rule", "verdict"],
                )

    return ordered.mapInArrow(sweep, f"page_id {kind}, host string, path string, rule string, verdict string")
