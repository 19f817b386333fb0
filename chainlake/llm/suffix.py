"""Removing repeated byte strings with suffix arrays.

Stretches of bytes that share an anchor (see :mod:`chainlake.llm.anchors`) come to one task
and are put into shards of bounded size. Each shard gets a suffix array by Larsson and
Sadakane's refinement: suffixes are sorted by 8 bytes, then by twice as many in each round
by the ranks of the round before, and groups of one suffix are left alone. Common prefixes
follow from Kasai's observation that the prefix a suffix shares with its predecessor is at
most one shorter than that of the suffix one byte to the left. Where the stretches of an
anchor fill several shards, the sorted windows of one are sought in the others by binary
search.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chainlake.llm.anchors import Units, as_runs, compared, cover, digest, shared_stretches, windows_of
from chainlake.llm.base import by_batch, written
from chainlake.llm.chunks import ranges

LENGTH = 200
GRAM = 32
# Bytes of one shard.
SHARD = 2 << 20
RUNS = "runs array<struct<start:int,end:int>>"


def refined(rank: np.ndarray, at: np.ndarray, step: int) -> np.ndarray:
    """Sort the suffixes ``at`` within their groups by the rank ``step`` bytes further on;
    sets their new ranks and returns those that still share one."""
    key = rank[at] * np.int64(len(rank) + 1) + rank[at + step]
    order = np.argsort(key, kind="stable")
    at, key = at[order], key[order]
    new = np.concatenate([[True], key[1:] != key[:-1]])
    old = rank[at]
    fresh = np.concatenate([[True], old[1:] != old[:-1]])
    place = np.arange(len(at))
    group = np.maximum.accumulate(np.where(fresh, place, 0))
    begin = np.maximum.accumulate(np.where(new, place, 0))
    rank[at] = old + begin - group
    alone = new & np.concatenate([new[1:], [True]])
    return at[~alone]


def sorted_suffixes(data: np.ndarray, left: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Sort the suffixes at ``starts`` by their first ``length`` bytes; ``left`` tells how
    many bytes each position has before its string ends. Returns those that share these
    bytes with another, in order, and their ranks."""
    n = len(data)
    wide = np.concatenate([data, np.zeros(8, dtype=np.uint8)]).astype(np.uint64)
    key = np.zeros(n, dtype=np.uint64)
    for i in range(8):
        key = (key << np.uint64(8)) | wide[i : n + i]
    # Suffixes of fewer bytes are in no group: their rank is their own.
    rank = np.arange(n, 2 * n, dtype=np.int64)
    at = np.flatnonzero(left >= 8)
    order = at[np.argsort(key[at], kind="stable")]
    ordered = key[order]
    new = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
    at = order[~(new & np.concatenate([new[1:], [True]]))]
    size = 8
    while size * 2 <= length and len(at):
        at = refined_ranks(rank, at[left[at] >= 2 * size], size)
        size *= 2
    wanted = np.zeros(n, dtype=bool)
    wanted[starts] = True
    at = at[wanted[at] & (left[at] >= length)]
    if size < length and len(at):
        at = refined_ranks(rank, at, length - size)
    return at, rank[at]


def refined_ranks(rank: np.ndarray, at: np.ndarray, step: int) -> np.ndarray:
    return refined(rank, at, step) if len(at) else at


def common_prefixes(data: np.ndarray, left: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Bytes that each suffix of ``order`` shares with the one before it.

    Taken by position: where a suffix and its predecessor both lie one byte right of a pair
    that shares its first byte, their common prefix is one byte shorter than that pair's; only
    other pairs are compared.
    """
    if len(order) < 2:
        return np.zeros(len(order), dtype=np.int64)
    before = order[:-1]
    here = order[1:]
    by_place = np.argsort(here, kind="stable")
    p, q = here[by_place], before[by_place]
    follows = np.concatenate([[False], (p[1:] == p[:-1] + 1) & (q[1:] == q[:-1] + 1)])
    # Nothing follows from a pair that shares no byte, or whose strings end with it.
    follows[1:] &= (data[p[:-1]] == data[q[:-1]]) & (np.minimum(left[p[:-1]], left[q[:-1]]) > 1)
    heads = np.flatnonzero(~follows)
    most = np.minimum(left[p[heads]], left[q[heads]])
    shared = np.zeros(len(heads), dtype=np.int64)
    going = np.arange(len(heads))
    while len(going):
        same = (shared[going] < most[going])
        going = going[same]
        equal = data[p[heads[going]] + shared[going]] == data[q[heads[going]] + shared[going]]
        going = going[equal]
        shared[going] += 1
    head_of = np.maximum.accumulate(np.where(follows, 0, np.arange(len(p))))
    value = np.zeros(len(p), dtype=np.int64)
    value[heads] = shared
    value = value[head_of] - (np.arange(len(p)) - head_of)
    out = np.zeros(len(order), dtype=np.int64)
    out[1:][by_place] = value
    return out


def repeated_starts(contents: list[bytes], counts: list[int], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows of one shard: the bytes, where each content begins, and for each position
    whether a window begins there whose bytes begin another window of the shard."""
    sizes = np.array([len(c) for c in contents], dtype=np.int64)
    ends = np.cumsum(sizes)
    data = np.frombuffer(b"".join(contents), dtype=np.uint8)
    left = np.repeat(ends, sizes) - np.arange(len(data))
    starts = ranges(ends - sizes, np.array(counts, dtype=np.int64))
    order, _ = sorted_suffixes(data, left, starts, length)
    hit = np.zeros(len(data) + 1, dtype=bool)
    if len(order):
        equal = common_prefixes(data, left, order) >= length
        hit[order[equal]] = True
        hit[order[:-1][equal[1:]]] = True
    return data, ends - sizes, hit


def windows_at(data: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """Windows as fixed-width strings, in the order of ``starts``."""
    return np.lib.stride_tricks.sliding_window_view(data, length)[starts].copy().view(f"S{length}").ravel()


class Shards:
    """The shards of a task. Of an anchor that goes on in the next shard the sorted windows
    are kept, and shards are merged by seeking the windows of one in those of the other."""

    def __init__(self, length: int):
        self.length = length
        self.rows: list[tuple] = []
        self.size = 0
        self.held: list[tuple] = []
        self.open: int | None = None

    def add(self, anchor: int, key: bytes, content: bytes, count: int, several: bool) -> Iterator[tuple]:
        if self.size >= SHARD:
            yield from self.close(anchor)
        self.rows.append((anchor, key, content, count, several))
        self.size += len(content)

    def close(self, following: int | None) -> Iterator[tuple]:
        """Sort the shard; gives (anchor, key, hits, all) of what is complete. ``following``
        is the anchor that the next shard begins with."""
        rows, self.rows, self.size = self.rows, [], 0
        if not rows:
            return
        data, begins, hit = repeated_starts([r[2] for r in rows], [r[3] for r in rows], self.length)
        done = [(r[0], r[1], hit[b : b + r[3]], r[4]) for r, b in zip(rows, begins.tolist())]
        carried = self.open if self.open == rows[0][0] else None
        if self.open is not None and carried is None:
            yield from self.flush()
        self.open = None
        apart = [a for a in (carried, following if following == rows[-1][0] else None) if a is not None]
        for anchor in dict.fromkeys(apart):
            mine = [i for i, r in enumerate(rows) if r[0] == anchor]
            starts = ranges(begins[mine], np.array([rows[i][3] for i in mine], dtype=np.int64))
            self.merge([done[i] for i in mine], windows_at(data, starts, self.length))
            if anchor == following:
                self.open = anchor
            else:
                yield from self.flush()
        yield from (d for d in done if d[0] not in apart)

    def merge(self, rows: list[tuple], windows: np.ndarray) -> None:
        order = np.argsort(windows, kind="stable")
        flags = np.concatenate([r[2] for r in rows])
        cuts = np.cumsum([len(r[2]) for r in rows])[:-1]
        for other in self.held:
            place = np.minimum(np.searchsorted(other[2], windows), len(other[2]) - 1)
            same = other[2][place] == windows
            flags |= same
            # All equal windows of the other shard, not only the first.
            low = np.searchsorted(other[2], windows[same], "left")
            high = np.searchsorted(other[2], windows[same], "right")
            other[1][other[3][ranges(low, high - low)]] = True
        self.held.append((rows, flags, windows[order], order, cuts))

    def flush(self) -> Iterator[tuple]:
        for rows, flags, _, _, cuts in self.held:
            for row, mine in zip(rows, np.split(flags, cuts)):
                yield (row[0], row[1], mine, row[3])
        self.held, self.open = [], None


def hits(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Runs of repeated windows per stretch, for stretches in the order of their anchors."""
    shards = Shards(length)
    made: list[tuple] = []

    def out() -> pa.RecordBatch:
        rows = [
            (a, k, [{"start": 0, "end": len(h)}] if several else [{"start": s, "end": e} for s, e in as_runs(h)])
            for a, k, h, several in made
        ]
        made.clear()
        anchor, key, runs = zip(*rows)
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        return pa.RecordBatch.from_arrays(
            [pa.array(anchor, pa.int64()), pa.array(key, pa.binary()), pa.array(runs, kind)], names=["anchor", "key", "runs"]
        )

    for batch in batches:
        for row in zip(*[batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("anchor", "key", "content", "count", "several")]):
            made.extend(shards.add(*row))
            if len(made) >= 5000:
                yield out()
    made.extend(shards.close(None))
    made.extend(shards.flush())
    if made:
        yield out()


def hot_hits(contents: DataFrame, units: Units) -> DataFrame:
    """The same for anchors with very many different stretches: their windows are grouped."""
    each = written(windows_of(contents, units).join(contents.select("anchor", "key", "several"), ["anchor", "key"]), "windows")
    again = each.groupBy("digest").agg((F.count(F.lit(1)) > 1).alias("again"))
    return (
        each.join(again, "digest").where("again or several").groupBy("anchor", "key")
        .agg(F.sort_array(F.collect_list(F.struct(F.col("window").alias("start"), (F.col("window") + 1).alias("end")))).alias("runs"))
    )


def without_repeats(
    docs: DataFrame, length: int = LENGTH, id: str = "doc_id", text: str = "text", keep: tuple[str, ...] = ()
) -> DataFrame:
    """Remove every byte covered by a string of ``length`` bytes that also starts elsewhere,
    in another document or in the same one: ``doc_id, n_bytes, n_removed, n_spans,
    kept_sha256, kept_text`` and the columns of ``keep`` as ``kept_<name>``. The digest is of
    the remaining bytes; in the text, characters of which only some bytes remain are left out.

    Null texts are empty; texts shorter than ``length`` lose nothing. Rows that repeat id
    and text are one document, and each gets its result; rows with the same text under
    several ids are copies. Null ids are ids. An empty table gives no rows.
    """
    units = Units(words=False, length=length, gram=min(GRAM, length // 2))
    found = shared_stretches(docs, units, id, text)
    contents = found.contents.withColumn("several", F.col("first") != F.col("last"))
    marks = compared(contents, units, lambda b: hits(b, length), f"anchor long, key binary, {RUNS}", lambda hot: hot_hits(hot, units))
    marks = marks.where(F.size("runs") > 0)
    spans = (
        found.occurrences.select("rid", "anchor", "key", F.col("start").alias("_at")).join(marks, ["anchor", "key"])
        .select("rid", F.transform("runs", lambda r: F.struct((r["start"] + F.col("_at")).alias("start"), (r["end"] + F.col("_at")).alias("end"))).alias("runs"))
        .groupBy("rid").agg(F.flatten(F.collect_list("runs")).alias("runs"))
    )
    # Copied texts go as a whole; of the others each is one document.
    fate = found.texts.join(spans, "rid", "left").select("digest", "copied", "runs").where("copied or runs is not null")
    kept = [F.col(f"`{c}`").alias(f"kept_{c}") for c in keep]
    rows = docs.select(
        F.col(f"`{id}`").alias("doc_id"), *kept, F.encode(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")), "UTF-8").alias("_utf8")
    ).withColumn("digest", digest("_utf8"))
    joined = rows.join(fate, "digest", "left").drop("digest")
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in joined.schema if f.name not in ("_utf8", "copied", "runs")]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        names = batch.schema.names
        n_bytes, n_removed, n_spans, sha, left = [], [], [], [], []
        for raw, copied, runs in zip(*[batch.column(names.index(c)).to_pylist() for c in ("_utf8", "copied", "runs")]):
            n = len(raw)
            if copied and n >= length:
                removed, gone, rest = n, 1, b""
            elif runs:
                hit = cover(runs, n, length)
                removed, gone = int(hit.sum()), len(as_runs(hit))
                rest = np.frombuffer(raw, dtype=np.uint8)[~hit].tobytes()
            else:
                removed, gone, rest = 0, 0, raw
            for column, value in zip((n_bytes, n_removed, n_spans, sha, left), (n, removed, gone, hashlib.sha256(rest).hexdigest(), rest.decode("utf-8", "ignore"))):
                column.append(value)
        others = [c for c in names if c not in ("_utf8", "copied", "runs")]
        return pa.RecordBatch.from_arrays(
            [*[batch.column(names.index(c)) for c in others], *[pa.array(c, pa.int64()) for c in (n_bytes, n_removed, n_spans)], pa.array(sha), pa.array(left, pa.string())],
            names=[*others, "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text"],
        )

    return by_batch(joined, run, ", ".join([*fields, "n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept_text string"]))
