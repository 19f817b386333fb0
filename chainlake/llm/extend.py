"""Removing repeated runs of words by seeding and extending.

Documents meet on winnowed anchors (see :mod:`chainlake.llm.anchors`). All stretches that
share one are extended together, a word at a time to the right and to the left: those that
go on alike stay in one class, so classes stand for maximal repeats without any pair being
written out. A repeat counts once both sides add up to the length asked for.
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
from chainlake.llm.words import coded, dense, joined

LENGTH = 20
GRAM = 5
# Bytes of stretches that are extended together.
TOGETHER = 4 << 20
RUNS = "runs array<struct<start:int,end:int>>"


def extended(classes: np.ndarray, words: np.ndarray, at: np.ndarray, ok: np.ndarray) -> np.ndarray:
    """Classes after one more word; rows without that word are alone from here on."""
    here = np.where(ok, words[np.where(ok, at, 0)], -1 - np.arange(len(at)))
    return joined(classes, here - here.min(initial=0))


def later_windows(
    anchors: np.ndarray, contents: list[bytes], counts: np.ndarray, places: np.ndarray, order: np.ndarray, units: Units
) -> list[np.ndarray]:
    """Per stretch, for each of its windows, whether equal words begin at an earlier place.
    ``places``: the anchor's place from the first window; ``order``: rank of the stretch's
    first occurrence, by the place of its anchor."""
    words, bounds, _ = coded(contents)
    words = words.astype(np.int64)
    begin, end = bounds[:-1], bounds[1:]
    seed = begin + places
    right = dense(anchors)
    rights: list[np.ndarray] = [right]
    for step in range(units.length):
        right = extended(right, words, seed + step, seed + step < end)
        rights.append(right)
    # The anchors' own words count to both sides, so that equal hashes are not enough.
    left = rights[units.gram]
    later = [np.zeros(c, dtype=bool) for c in counts.tolist()]
    for step in range(units.length - units.gram + 1):
        if step:
            left = extended(left, words, seed - step, seed - step >= begin)
        number = places - step
        rows = np.flatnonzero((number >= 0) & (number < counts))
        if not len(rows):
            continue
        alike = joined(left[rows], rights[units.length - step][rows])
        first = np.full(int(alike.max()) + 1, np.iinfo(np.int64).max)
        np.minimum.at(first, alike, order[rows])
        for row in rows[order[rows] > first[alike]].tolist():
            later[row][number[row]] = True
    return later


def place_order(first: list[dict], places: list[int]) -> np.ndarray:
    """Ranks of the stretches' first occurrences by document and place of the anchor."""
    keys = [
        (f["doc_id"] is not None, 0 if f["doc_id"] is None else f["doc_id"], f["rid"], f["start"] + p)
        for f, p in zip(first, places)
    ]
    rank = np.empty(len(keys), dtype=np.int64)
    rank[sorted(range(len(keys)), key=keys.__getitem__)] = np.arange(len(keys))
    return rank


def shard(batches: Iterator[pa.RecordBatch], units: Units) -> Iterator[pa.RecordBatch]:
    """Extend the stretches of whole anchors; they come in the order of their anchors."""
    rows: list[tuple] = []
    size = 0

    def done(part: list[tuple]) -> pa.RecordBatch:
        anchor, key, content, count, at, first = map(list, zip(*part))
        later = later_windows(
            np.array(anchor), content, np.array(count, dtype=np.int64), np.array(at, dtype=np.int64), place_order(first, at), units
        )
        runs = [[{"start": s, "end": e} for s, e in as_runs(one)] for one in later]
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        return pa.RecordBatch.from_arrays(
            [pa.array(anchor, pa.int64()), pa.array(key, pa.binary()), pa.array(runs, kind)], names=["anchor", "key", "runs"]
        )

    for batch in batches:
        columns = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("anchor", "key", "content", "count", "at", "first")]
        for row in zip(*columns):
            if size >= TOGETHER and row[0] != rows[-1][0]:
                yield done(rows)
                rows, size = [], 0
            rows.append(row)
            size += len(row[2])
    if rows:
        yield done(rows)


def hot_later(contents: DataFrame, units: Units) -> DataFrame:
    """The same for anchors with very many different stretches: their windows are grouped."""
    each = written(windows_of(contents, units), "windows")
    place = F.struct("first.doc_id", "first.rid", (F.col("first.start") + F.col("window")).alias("at"))
    best = each.groupBy("digest").agg(F.min(place).alias("best"))
    return (
        each.withColumn("place", place).join(best, "digest").groupBy("anchor", "key")
        .agg(F.sort_array(F.collect_list(F.when(F.col("place") > F.col("best"), F.struct(F.col("window").alias("start"), (F.col("window") + 1).alias("end"))))).alias("runs"))
    )


def without_later_repeats(
    docs: DataFrame, length: int = LENGTH, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Remove every word covered by ``length`` words in a row that also start earlier, in a
    document with a smaller id or further left in the same one: ``doc_id, n_words,
    n_removed, kept_sha256, kept_text``.

    Null texts have no words; texts of fewer words lose nothing. Rows that repeat id and
    text are one document, and each gets its result. Null ids come first; texts that share
    an id are ordered as they are stored. An empty table gives no rows.
    """
    units = Units(words=True, length=length, gram=min(GRAM, length))
    found = shared_stretches(docs, units, id, text)
    marks = compared(found.contents, units, lambda b: shard(b, units), f"anchor long, key binary, {RUNS}", lambda hot: hot_later(hot, units))
    firsts = found.contents.select("anchor", "key", F.col("first").alias("_first"), F.col("count").alias("_count"))
    spans = (
        found.occurrences.join(marks.join(firsts, ["anchor", "key"]), ["anchor", "key"])
        # What is not a stretch's first occurrence starts earlier as a whole.
        .withColumn("runs", F.when(
            (F.col("_first.rid") == F.col("rid")) & (F.col("_first.start") == F.col("start")), F.col("runs")
        ).otherwise(F.array(F.struct(F.lit(0).alias("start"), F.col("_count").alias("end")))))
        .where(F.size("runs") > 0)
        .select("rid", F.transform("runs", lambda r: F.struct((r["start"] + F.col("start")).alias("start"), (r["end"] + F.col("start")).alias("end"))).alias("runs"))
        .groupBy("rid").agg(F.flatten(F.collect_list("runs")).alias("runs"))
    )
    fate = found.texts.join(spans, "rid", "left").select("digest", F.col("doc_id").alias("_first_id"), "copied", "runs").where("copied or runs is not null")
    rows = docs.select(
        F.col(f"`{id}`").alias("doc_id"), F.encode(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")), "UTF-8").alias("_utf8")
    ).withColumn("digest", digest("_utf8"))
    marked = rows.join(fate, "digest", "left").select(
        "doc_id", "_utf8", "runs", (F.col("copied") & ~F.col("doc_id").eqNullSafe(F.col("_first_id"))).alias("copy")
    )
    kind = marked.schema["doc_id"].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        n_words, n_removed, sha, left = [], [], [], []
        for raw, runs, copy in zip(*[batch.column(c).to_pylist() for c in (1, 2, 3)]):
            words = raw.split()
            n = len(words)
            if copy and n >= length:
                kept: list[bytes] = []
            elif runs:
                hit = cover(runs, n, length)
                kept = [w for w, gone in zip(words, hit.tolist()) if not gone]
            else:
                kept = words
            rest = b" ".join(kept)
            for column, value in zip((n_words, n_removed, sha, left), (n, n - len(kept), hashlib.sha256(rest).hexdigest(), rest.decode("utf-8", "replace"))):
                column.append(value)
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(sha), pa.array(left, pa.string())],
            names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"],
        )

    return by_batch(marked, run, f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string, kept_text string")
