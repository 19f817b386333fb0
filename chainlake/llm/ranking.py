"""The best documents for each of many items, by products of dense matrices.

Items are taken in tiles with a compact vocabulary of their own: the distinct terms of the
tile's items. Documents are reduced to counts of these terms; a block of documents becomes a
dense matrix of impacts (documents x terms), a tile one of weights (terms x items), and their
product holds all scores at once. Impacts, weights and scores are whole numbers in float64,
so they are exact as long as sums stay below 2^53: a product takes no more terms at once than
this bound allows, and the sums of several products are added as 64-bit integers. A task
keeps the best of each item over its blocks, equal scores by id, so nothing that belongs to
the result is lost among ties.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chainlake.llm.base import written

# Different (item, term) pairs of one tile, the bound of what a tile sends to tasks.
TILE = 200_000
# Elements of a block's matrices.
BLOCK = 4_000_000
EXACT = 1 << 53
# An impact is below IMPACT / RATIO: the quotient of IMPACT tf and RATIO tf + LENGTH m.
IMPACT, RATIO, LENGTH, SHARE = 1_000_000_000, 1000, 20, 50

# Terms are runs of letters and digits of ASCII and of all characters beyond it; only A-Z are lowered.
TERM_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)


def terms(text: str | None) -> list[bytes]:
    return text.encode().translate(TERM_BYTES).split() if text else []


@dataclass
class Tile:
    """Items and the terms they hold."""

    items: list
    vocabulary: dict[bytes, int]
    # Of each (item, term) pair the item's place and the term's.
    pair_item: np.ndarray
    pair_term: np.ndarray

    @classmethod
    def of(cls, rows: list[tuple]) -> Tile:
        """A tile of ``(item, text)`` rows."""
        vocabulary: dict[bytes, int] = {}
        at, of = [], []
        for place, (_, text) in enumerate(rows):
            for term in set(terms(text)):
                at.append(place)
                of.append(vocabulary.setdefault(term, len(vocabulary)))
        return cls([item for item, _ in rows], vocabulary, np.array(at, dtype=np.int64), np.array(of, dtype=np.int64))


def counted(docs: DataFrame, tile: Tile, id: str, text: str) -> DataFrame:
    """Per document ``id, n`` (its terms with repeats) and ``terms, counts``: those of the tile's
    vocabulary it holds, and how often."""
    source = docs.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(tile.vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = shared.value.get
        for batch in batches:
            sizes, ids, counts = [], [], []
            for t in batch.column("text").to_pylist():
                words = terms(t)
                found = np.fromiter((p for p in map(place, words) if p is not None), np.int32)
                held, often = np.unique(found, return_counts=True)
                sizes.append(len(words))
                ids.append(held)
                counts.append(often)
            made = [batch.column("id"), pa.array(sizes, pa.int64()), pa.array(ids, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(made, names=["id", "n", "terms", "counts"])

    return source.mapInArrow(run, f"id {kind}, n long, terms array<int>, counts array<long>")


def weights(held: DataFrame, size: int, documents: int) -> np.ndarray:
    """The weight of each term of a tile, from how many documents hold it."""
    rows = held.select(F.explode("terms").alias("term")).groupBy("term").count().collect()
    df = np.zeros(size, dtype=np.int64)
    for term, n in rows:
        df[term] = n
    return np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * n + 1))) for n in df.tolist()], dtype=np.int64)


def impacts(n: np.ndarray, counts: np.ndarray, documents: int, length: int) -> np.ndarray:
    """What an occurrence count adds to a score for each unit of weight, in a document of ``n`` terms."""
    m = 100 - SHARE + (SHARE * n * documents) // length
    return (IMPACT * counts) // (RATIO * counts + LENGTH * m)


def best(scores: np.ndarray, ids: np.ndarray, most: int) -> np.ndarray:
    """Places of the ``most`` highest scores above 0, equal ones by id; missing ids come last."""
    at = np.flatnonzero(scores > 0)
    if len(at) > most:
        # All that equal the last of the highest stay until ids decide.
        least = np.partition(scores[at], len(at) - most)[len(at) - most]
        at = at[scores[at] >= least]
    return at[np.lexsort((ids[at], -scores[at]))][:most]


def products(impact: np.ndarray, weight: np.ndarray, heaviest: int) -> np.ndarray:
    """The product of two matrices of whole numbers, exact: so many terms at once that no sum
    reaches 2^53."""
    most = max(EXACT // max(heaviest * (IMPACT // RATIO), 1), 1)
    total = np.zeros((len(impact), weight.shape[1]), dtype=np.int64)
    for at in range(0, impact.shape[1], most):
        total += (impact[:, at : at + most] @ weight[at : at + most]).astype(np.int64)
    return total


class Scorer:
    """Scores blocks of documents against a tile and keeps the best of each item."""

    def __init__(self, tile: Tile, weight: np.ndarray, documents: int, length: int, most: int):
        self.tile, self.weight, self.documents, self.length, self.most = tile, weight, documents, length, most
        self.kept = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in tile.items]
        order = np.argsort(tile.pair_term, kind="stable")
        self.pair_item, self.pair_term = tile.pair_item[order], tile.pair_term[order]

    def add(self, numbers: np.ndarray, n: np.ndarray, cuts: np.ndarray, held: np.ndarray, counts: np.ndarray) -> None:
        """Documents known by ``numbers``; document ``i`` holds ``held[cuts[i]:cuts[i + 1]]``."""
        rows = np.repeat(np.arange(len(n)), np.diff(cuts))
        used, column = np.unique(held, return_inverse=True)
        if not len(used):
            return
        impact = np.zeros((len(n), len(used)))
        impact[rows, column] = impacts(n[rows], counts, self.documents, self.length)
        # Weights of the used terms only, for blocks of items.
        place = np.full(len(self.weight), -1, dtype=np.int64)
        place[used] = np.arange(len(used))
        wide = max(BLOCK // len(used), 1)
        heaviest = int(self.weight[used].max(initial=0))
        for first in range(0, len(self.tile.items), wide):
            here = (self.pair_item >= first) & (self.pair_item < first + wide) & (place[self.pair_term] >= 0)
            items, terms_ = self.pair_item[here], self.pair_term[here]
            if not len(items):
                continue
            weight = np.zeros((len(used), min(wide, len(self.tile.items) - first)))
            weight[place[terms_], items - first] = self.weight[terms_]
            scores = products(impact, weight, heaviest)
            for i in np.unique(items).tolist():
                self.merge(i, scores[:, i - first], numbers)

    def merge(self, item: int, scores: np.ndarray, numbers: np.ndarray) -> None:
        old_scores, old_numbers = self.kept[item]
        if len(old_scores) == self.most and scores.max(initial=0) < old_scores[-1]:
            return
        at = best(scores, numbers, self.most)
        both, ids = np.concatenate([old_scores, scores[at]]), np.concatenate([old_numbers, numbers[at]])
        at = best(both, ids, self.most)
        self.kept[item] = both[at], ids[at]


def scored(held: DataFrame, tile: Tile, weight: np.ndarray, documents: int, length: int, most: int) -> DataFrame:
    """The best documents of each item of a tile, per task: ``place`` of the item, ``id, score``."""
    shared = held.sparkSession.sparkContext.broadcast((tile, weight))
    # Ids are compared in the engine; a task numbers those of its rows by their order.
    ordered = held.where(F.size("terms") > 0).select("id", "n", "terms", "counts")
    kind = held.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, weight = shared.value
        scorer = Scorer(tile, weight, documents, length, most)
        for batch in batches:
            ids = batch.column("id")
            known = ids.fill_null(2**63 - 1).to_numpy(zero_copy_only=False)
            n = batch.column("n").to_numpy()
            held_, cuts = batch.column("terms").values.to_numpy(), batch.column("terms").offsets.to_numpy()
            counts = batch.column("counts").values.to_numpy()
            rows = max(min(BLOCK // max(len(weight), 1), BLOCK // max(len(tile.items), 1)), 1)
            for a in range(0, batch.num_rows, rows):
                b = min(a + rows, batch.num_rows)
                part = slice(cuts[a], cuts[b])
                scorer.add(known[a:b], n[a:b], cuts[a : b + 1] - cuts[a], held_[part], counts[part])
        found = [(place, number, score) for place, (scores, numbers) in enumerate(scorer.kept) for number, score in zip(numbers.tolist(), scores.tolist())]
        if found:
            places, numbers, scores = zip(*found)
            ids = pa.array([None if i == 2**63 - 1 else i for i in numbers], pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(places, pa.int32()), ids, pa.array(scores, pa.int64())], names=["place", "id", "score"])

    return ordered.mapInArrow(run, "place int, id long, score long").withColumn("id", F.col("id").cast(kind))


def tiles(items: DataFrame, id: str, text: str) -> Iterator[Tile]:
    """The items in tiles of bounded size: the items, and their texts, of one tile at a time
    come to the driver. An item without terms is in no tile."""
    source = items.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").cast("string").alias("text")).where(F.length("text") > 0)
    size = source.agg(F.sum(F.length("text")).alias("n")).first()["n"] or 0
    # A term takes two characters at least, the one that ends it included.
    parts = max(-(-size // (2 * TILE)), 1)
    for part in range(parts if size else 0):
        rows = source.where(F.pmod(F.xxhash64("id", "text"), F.lit(parts)) == part).collect()
        tile = Tile.of([(r["id"], r["text"]) for r in rows])
        if tile.vocabulary:
            yield tile


def ranked(docs: DataFrame, items: DataFrame, most: int = 50, id: str = "doc_id", text: str = "text", item: str = "item_id", query: str = "text") -> DataFrame:
    """For each row of ``items`` its ``most`` highest-scoring rows of ``docs`` with a score above 0:
    ``item_id, rank, doc_id, score``, equal scores by ascending ``doc_id``, missing ids last.

    ``docs`` need whole numbers below 2^63 - 1 as ids. Null texts have no terms; items without terms, and documents
    without one of an item's terms, give no rows. Repeated documents are ranked one by one;
    a repeated item (id and text) is ranked as often as it occurs. Other columns are ignored.
    """
    spark = docs.sparkSession
    item_kind = items.schema[item].dataType.simpleString()
    doc_kind = docs.schema[id].dataType.simpleString()
    made = []
    for tile in tiles(items, item, query):
        held = written(counted(docs, tile, id, text), "terms")
        whole = held.agg(F.count(F.when(F.col("n") > 0, 1)).alias("documents"), F.sum("n").alias("length")).first()
        documents, length = whole["documents"], whole["length"] or 0
        if not documents:
            break
        weight = weights(held, len(tile.vocabulary), documents)
        found = scored(held, tile, weight, documents, length, most)
        order = Window.partitionBy("place").orderBy(F.desc("score"), F.col("id").asc_nulls_last())
        names = spark.createDataFrame(list(enumerate(tile.items)), f"place int, item_id {item_kind}")
        made.append(
            found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most).join(names, "place")
            .select("item_id", "rank", F.col("id").alias("doc_id"), "score")
        )
    if not made:
        return spark.createDataFrame([], f"item_id {item_kind}, rank int, doc_id {doc_kind}, score long")
    out = made[0]
    for more in made[1:]:
        out = out.unionByName(more)
    return out
