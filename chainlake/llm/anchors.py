"""Finding repeated windows of bytes or words through shared anchors.

Every window of ``length`` units is owned by one of its short grams, the one with the
smallest hash. Equal windows own the same gram at the same place, so windows need comparing
only where their anchors are equal. A document is cut to *stretches*: the windows in a row
that share an anchor, with the units they cover. Stretches whose anchor occurs once hold no
repeated window and go no further; equal stretches are combined before they are compared.

Documents are told apart by id and text. Rows that repeat both are one document; texts that
several documents share are compared once, for the first of them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chainlake.llm.base import by_batch, gathered, written
from chainlake.llm.words import coded, document_of

# Units whose place is kept in the low bits of a key while minima are sought.
PLACE_BITS = 24
# Bytes of text that are searched for anchors at once.
GATHER = 2 << 20
# Different stretches of one anchor that a single task compares; beyond, windows are compared
# one by one through Spark's grouping.
HOT = 20_000


@dataclass(frozen=True)
class Units:
    """Windows of ``length`` bytes or words; anchors of ``gram`` units."""

    words: bool
    length: int
    gram: int

    def split(self, text: bytes) -> bytes | list[bytes]:
        return text.split() if self.words else text

    def piece(self, units: bytes | list[bytes], start: int, stop: int) -> bytes:
        return b" ".join(units[start:stop]) if self.words else units[start:stop]

    def hashes(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """A hash of every unit, and where each text begins and ends."""
        if self.words:
            codes, bounds, vocabulary = coded(texts)
            table = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in vocabulary), np.uint64, len(vocabulary))
            return table[codes], bounds
        bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        table = np.random.default_rng(1).integers(0, 2**63, 256, dtype=np.uint64)
        return table[np.frombuffer(b"".join(texts), dtype=np.uint8)], bounds


def gram_hashes(units: np.ndarray, gram: int) -> np.ndarray:
    """Hashes of all runs of ``gram`` units, put together from runs of powers of two."""
    made, width = None, 0
    power, size = units, 1
    while True:
        if gram & size:
            if made is None:
                made, width = power, size
            else:
                n = len(units) - width - size + 1
                made = stir(made[:n], power[width : width + n])
                width += size
        if size * 2 > gram:
            return made
        n = max(0, len(power) - size)
        power, size = stir(power[:n], power[size : size + n]), size * 2


def stir(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    out = left * np.uint64(0x9E3779B97F4A7C15)
    out ^= out >> np.uint64(29)
    out += right
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(32)
    return out


def smallest(keys: np.ndarray, width: int) -> np.ndarray:
    """The smallest key of each ``width`` keys in a row."""
    size = 1
    while size * 2 <= width:
        keys = np.minimum(keys[: len(keys) - size], keys[size:])
        size *= 2
    rest = width - size
    return np.minimum(keys[: len(keys) - rest], keys[rest:]) if rest else keys


def stretches(units: Units, texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """Per stretch: document, hash of the anchor, first window, windows, place of the anchor
    from the first window; and the units of each document."""
    hashes, bounds = units.hashes(texts)
    sizes = np.diff(bounds)
    none = np.zeros(0, dtype=np.int64)
    if len(hashes) < units.length:
        return none, none, none, none, none, sizes
    if len(hashes) >= 1 << PLACE_BITS:
        # One very long text: its windows are searched part by part, parts overlapping.
        return long_stretches(units, hashes, bounds)
    return (*found_stretches(units, hashes, bounds), sizes)


def found_stretches(units: Units, hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, ...]:
    grams = gram_hashes(hashes, units.gram)
    last = np.uint64((1 << PLACE_BITS) - 1)
    place = np.arange(len(grams), dtype=np.uint64)
    # Equal hashes: the gram furthest right wins, wherever the window lies.
    keys = smallest((grams & ~last) | (last - place), units.length - units.gram + 1)
    owner = (last - (keys & last)).astype(np.int64)
    docs = document_of(bounds)
    n = len(owner)
    inside = docs[:n] == docs[units.length - 1 :][:n]
    first = inside.copy()
    first[1:] &= ~inside[:-1] | (owner[1:] != owner[:-1]) | (docs[1:n] != docs[: n - 1])
    begin = np.flatnonzero(first)
    ends = np.concatenate([begin[1:], [n]])
    total = np.concatenate([[0], np.cumsum(inside)])
    count = total[ends] - total[begin]
    doc = docs[begin]
    anchor = grams[owner[begin]].astype(np.int64)
    return doc, anchor, begin - bounds[doc], count, owner[begin] - begin


def long_stretches(units: Units, hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, ...]:
    """As above for more units than places: a stretch that is cut where parts meet gives two
    stretches, which hold the same windows."""
    step = (1 << PLACE_BITS) - units.length
    parts = []
    for doc in range(len(bounds) - 1):
        low, high = int(bounds[doc]), int(bounds[doc + 1])
        for start in range(low, max(low + 1, high - units.length + 1), step):
            stop = min(high, start + step + units.length - 1)
            if stop - start < units.length:
                continue
            _, anchor, begin, count, at = found_stretches(units, hashes[start:stop], np.array([0, stop - start]))
            parts.append((np.full(len(anchor), doc), anchor, begin + start - low, count, at))
    joined = [np.concatenate(column) for column in zip(*parts)] if parts else [np.zeros(0, np.int64)] * 5
    return (*joined, np.diff(bounds))


# First window, number of windows and place of the anchor travel as one number.
ANCHORED = "digest binary, n long, stretches array<struct<anchor:long,place:long>>"


def packed(start: np.ndarray, count: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (start.astype(np.int64) << 32) | (count.astype(np.int64) << 16) | at.astype(np.int64)


def unpacked(place: int) -> tuple[int, int, int]:
    return place >> 32, place >> 16 & 0xFFFF, place & 0xFFFF


def anchored(docs: DataFrame, units: Units, id: str, text: str) -> DataFrame:
    """One row per row: ``doc_id, digest, n`` (units) and its stretches."""
    source = sources(docs, id, text)
    kind = source.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for got in gathered(batches, "_utf8", GATHER):
            texts = [bytes(t) for t in got["_utf8"].to_pylist()]
            doc, anchor, start, count, at, sizes = stretches(units, texts)
            offsets = np.searchsorted(doc, np.arange(len(texts) + 1)).astype(np.int32)
            rows = pa.StructArray.from_arrays(
                [pa.array(anchor, pa.int64()), pa.array(packed(start, count, at), pa.int64())], names=["anchor", "place"]
            )
            yield pa.RecordBatch.from_arrays(
                [
                    got["doc_id"].combine_chunks(), pa.array([hashlib.md5(t).digest() for t in texts], pa.binary()),
                    pa.array(sizes, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), rows),
                ],
                names=["doc_id", "digest", "n", "stretches"],
            )

    return source.mapInArrow(run, f"doc_id {kind}, {ANCHORED}")


def sources(docs: DataFrame, id: str, text: str) -> DataFrame:
    return docs.select(
        F.col(f"`{id}`").alias("doc_id"),
        F.encode(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")), "UTF-8").alias("_utf8"),
    )


def digest(column: str) -> Column:
    return F.unhex(F.md5(column))


def same_document(left: DataFrame, right: DataFrame) -> Column:
    return left["doc_id"].eqNullSafe(right["doc_id"]) & (left["digest"] == right["digest"])


@dataclass(frozen=True)
class Found:
    """``texts``: one row per different text with ``rid, doc_id`` (the first with it),
    ``digest, n, copied``. ``occurrences``: stretches with an anchor that occurs again.
    ``contents``: the different ones of these, with the first and last place of each."""

    texts: DataFrame
    occurrences: DataFrame
    contents: DataFrame


def shared_stretches(docs: DataFrame, units: Units, id: str, text: str) -> Found:
    rows = written(anchored(docs, units, id, text).withColumn("rid", F.monotonically_increasing_id()), "anchored")
    first = F.min(F.struct("doc_id", "rid")).alias("first")
    texts = written(
        rows.groupBy("digest", "n")
        .agg(first, (F.min(F.struct("doc_id")) != F.max(F.struct("doc_id"))).alias("copied"))
        .select("digest", "n", "copied", "first.doc_id", "first.rid"),
        "texts",
    )
    # Copies of a text are counted here and left out once only little is left of the rows.
    places = rows.select("rid", F.inline("stretches"))
    again = places.groupBy("anchor").agg(F.count(F.lit(1)).alias("_times")).where("_times > 1").select("anchor")
    # Written, so that Spark may split the join where an anchor is very common.
    again = written(again, "again")
    wanted = places.join(again, "anchor").groupBy("rid").agg(F.collect_list(F.struct("anchor", "place")).alias("wanted"))
    keyed = sources(docs, id, text).withColumn("digest", digest("_utf8"))
    named = wanted.join(texts.select("rid", "doc_id", "digest"), "rid")
    cut_from = keyed.join(named, same_document(keyed, named)).select("rid", named["doc_id"], "wanted", "_utf8")
    kind = keyed.schema["doc_id"].dataType.simpleString()

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        take, flat, made = [], {c: [] for c in ("anchor", "start", "count", "at")}, []
        raw, lists = batch.column(3), batch.column(2).to_pylist()
        for row, wanted_here in enumerate(lists):
            parts = units.split(raw[row].as_py())
            for one in wanted_here:
                start, count, at = unpacked(one["place"])
                take.append(row)
                for c, value in (("anchor", one["anchor"]), ("start", start), ("count", count), ("at", at)):
                    flat[c].append(value)
                made.append(units.piece(parts, start, start + count - 1 + units.length))
        where = pa.array(take, pa.int64())
        return pa.RecordBatch.from_arrays(
            [
                batch.column(0).take(where), batch.column(1).take(where), pa.array(flat["anchor"], pa.int64()),
                *[pa.array(flat[c], pa.int32()) for c in ("start", "count", "at")],
                pa.array([hashlib.md5(m).digest() for m in made], pa.binary()), pa.array(made, pa.binary()),
            ],
            names=["rid", "doc_id", "anchor", "start", "count", "at", "key", "content"],
        )

    occurrences = written(
        by_batch(cut_from, cut, f"rid long, doc_id {kind}, anchor long, start int, count int, at int, key binary, content binary"),
        "stretches",
    )
    place = F.struct("doc_id", "rid", "start")
    contents = occurrences.groupBy("anchor", "key").agg(
        F.first("content").alias("content"), F.first("count").alias("count"), F.first("at").alias("at"),
        F.min(place).alias("first"), F.max(place).alias("last"),
    )
    return Found(texts, occurrences.drop("content"), written(contents, "contents"))


def compared(
    contents: DataFrame, units: Units, shard: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str,
    hot: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """Compare the stretches of each anchor. ``shard`` gets all stretches of its anchors,
    ordered by anchor; anchors with more than HOT different ones go to ``hot``."""
    many = contents.groupBy("anchor").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > HOT).select("anchor")
    usual = contents.join(many, "anchor", "left_anti").repartition("anchor").sortWithinPartitions("anchor", "key")
    # Written, so that the stretches' shuffle files go before the documents are shuffled.
    return written(usual.mapInArrow(shard, schema).unionByName(hot(contents.join(many, "anchor"))), "marks")


def windows_of(contents: DataFrame, units: Units) -> DataFrame:
    """The windows of stretches, each by itself: ``anchor, key, window`` (its number in the
    stretch), ``digest`` of its units, and the place of its first occurrence."""
    rows = contents.select("anchor", "key", "count", "first", "content")
    place = contents.schema["first"].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        take, number, made = [], [], []
        for row, (count, content) in enumerate(zip(batch.column(2).to_pylist(), batch.column(4).to_pylist())):
            parts = units.split(content)
            for w in range(count):
                take.append(row)
                number.append(w)
                made.append(hashlib.md5(units.piece(parts, w, w + units.length)).digest())
        where = pa.array(take, pa.int64())
        return pa.RecordBatch.from_arrays(
            [batch.column(0).take(where), batch.column(1).take(where), batch.column(3).take(where), pa.array(number, pa.int32()), pa.array(made, pa.binary())],
            names=["anchor", "key", "first", "window", "digest"],
        )

    return by_batch(rows, run, f"anchor long, key binary, first {place}, window int, digest binary")


def as_runs(marked: np.ndarray) -> list[tuple[int, int]]:
    """Runs of true values as (start, end)."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], marked.astype(np.int8), [0]])))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist()))


def cover(runs: list[dict] | None, n: int, length: int) -> np.ndarray:
    """Which of ``n`` units lie in a window that begins in one of the runs."""
    change = np.zeros(n + 1, dtype=np.int32)
    for run in runs or ():
        change[run["start"]] += 1
        change[run["end"] - 1 + length] -= 1
    return np.cumsum(change[:-1]) > 0
