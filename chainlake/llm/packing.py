"""Packing documents into training sequences by sum of squares.

Texts are tokenized where they are read; only lengths and digests of pieces move on. A
piece goes to an open sequence such that, over all residual gaps, the squared numbers of
open sequences with that gap add up to as little as possible. Pieces are dealt to shards of
bounded size, each packed in one task from long to short; the sequences that shards leave
rather empty are packed once more, as pieces of what they hold.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chainlake.llm.base import gathered, in_slices, written
from chainlake.llm.bpe import on_worker
from chainlake.llm.chunks import Memo

CAPACITY = 2048
END = 0
GATHER = 16 << 20
# Pieces a shard packs; the last sequences of a shard meet those of others in a later round.
SHARD = 50_000


def byte_alphabet() -> dict[str, int]:
    """The characters by which byte-level vocabulary files stand for bytes: printable ones
    stand for themselves, the others are shifted to 256 and above."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    shifted = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(shifted)}


class Tokens:
    """Ids of a ``tokenizers`` vocabulary file with byte-level BPE. The chunks are encoded
    by tiktoken from the same vocabulary, which gives the same ids several times as fast."""

    def __init__(self, path: str, pattern: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        byte_of = byte_alphabet()
        special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        ranks = {
            bytes(byte_of[c] for c in token): rank
            for token, rank in spec["model"]["vocab"].items()
            if token not in special
        }
        self.special = special
        self.coder = tiktoken.Encoding("pieces", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)
        self.memo = Memo(self.learn)

    def learn(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        encode = self.coder.encode if self.special else self.coder.encode_ordinary
        plain = self.coder.encode_ordinary
        made = [
            encode(c, allowed_special="all") if "<|" in c and any(s in c for s in self.special) else plain(c)
            for c in chunks
        ]
        lens = np.array([len(m) for m in made], dtype=np.int64)
        flat = np.fromiter((i for m in made for i in m), np.int32, int(lens.sum()))
        return flat, lens

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        ids, bounds = self.memo.encode(texts)
        return np.split(ids, bounds[1:-1])


@lru_cache(maxsize=2)
def tokens(path: str, pattern: str) -> Tokens:
    return Tokens(on_worker(path), pattern)


def pieces(
    docs: DataFrame, path: str, pattern: str, capacity: int = CAPACITY, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Tokenize every text, end it with id 0 and cut what is longer than ``capacity``; all
    pieces of a document but the first are full. One row per piece:
    ``doc_id, piece, start, length, ids_crc32``, and ``lot``, by which pieces are dealt out:
    it numbers the rows of a task, so that no id, however often repeated, is a hot key."""
    source = docs.select(F.col(f"`{id}`").alias("doc_id"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = tokens(path, pattern)
        lot = TaskContext.get().partitionId() << 40
        for got in gathered(batches, "text", GATHER):
            made = iter(coder.encode(got["text"].to_pylist()))
            for batch in in_slices(got):
                where: list[int] = []
                rows: list[tuple[int, int, int, int]] = []
                for row in range(batch.num_rows):
                    ids = np.append(next(made), END).astype("<u4")
                    count = -(-len(ids) // capacity)
                    start = 0
                    for piece in range(count):
                        stop = len(ids) - (count - 1 - piece) * capacity
                        rows.append((piece, start, stop - start, zlib.crc32(ids[start:stop].tobytes())))
                        where.append(row)
                        start = stop
                number, start, length, crc = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(pa.array(where)), pa.array(number, pa.int32()),
                        pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64()),
                        pa.array(range(lot, lot + len(rows)), pa.int64()),
                    ],
                    names=["doc_id", "piece", "start", "length", "ids_crc32", "lot"],
                )
                lot += len(rows)

    return source.mapInArrow(run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, lot long")


def pack(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sum-of-squares packing of sizes in the order given: the sequence and offset of each,
    and the gap of each sequence.

    With N(g) open sequences of gap g, taking one of gap g for size s changes the sum of
    squares by 2 (N(g - s) - N(g) + 1), or by 1 - 2 N(g) when nothing is left of the gap;
    a new sequence changes it by 2 N(capacity - s) + 1. Of equal choices the tightest wins.
    """
    count = np.zeros(capacity + 1, dtype=np.int64)
    open_at: list[list[int]] = [[] for _ in range(capacity + 1)]
    where = np.empty(len(sizes), dtype=np.int64)
    offset = np.empty(len(sizes), dtype=np.int64)
    gaps: list[int] = []
    for i, size in enumerate(sizes.tolist()):
        rest = capacity - size
        if rest == 0:
            best_gap = capacity
        else:
            # Gaps size .. capacity - 1; a gap equal to the size is filled up.
            have = count[size:capacity]
            cost = 2 * (count[: capacity - size] - have) + 2
            cost[0] = 1 - 2 * have[0]
            cost[have == 0] = np.iinfo(np.int64).max
            best = int(cost.argmin())
            best_gap = size + best if cost[best] <= 2 * count[rest] + 1 else capacity
        if best_gap == capacity:
            where[i], offset[i] = len(gaps), 0
            gaps.append(rest)
        else:
            sequence = open_at[best_gap].pop()
            count[best_gap] -= 1
            where[i], offset[i] = sequence, capacity - best_gap
            gaps[sequence] = best_gap - size
        left = gaps[where[i]]
        if left:
            count[left] += 1
            open_at[left].append(int(where[i]))
    return where, offset, np.array(gaps, dtype=np.int64)


def pack_shards(items: DataFrame, size: str, capacity: int) -> DataFrame:
    """Pack rows in shards of about SHARD rows: appends ``shard``, ``seq`` (the sequence's
    number in the shard), ``at`` (the place in it) and ``gap`` (what the sequence leaves)."""
    shards = max(1, -(-items.count() // SHARD))
    dealt = items.withColumn("shard", F.pmod(F.xxhash64("lot"), F.lit(shards)))

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values([size, "lot"], ascending=[False, True], ignore_index=True)
        where, offset, gaps = pack(rows[size].to_numpy(), capacity)
        return rows.assign(seq=where, at=offset, gap=gaps[where])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in dealt.schema)
    return dealt.groupBy("shard").applyInPandas(run, f"{fields}, seq long, at long, gap long")


def packed(
    docs: DataFrame, path: str, pattern: str, capacity: int = CAPACITY, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Pack all documents: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``.

    A null or empty text is one piece holding the end id only. Repeated rows and null ids
    are packed like any others; columns other than the two named are ignored. An empty
    table gives no rows.
    """
    cut = written(pieces(docs, path, pattern, capacity, id, text), "pieces")
    first = written(pack_shards(cut, "length", capacity), "packed")
    # What a shard leaves at least an eighth empty is packed again, across shards.
    loose = (
        first.where((F.col("at") == 0) & (F.col("gap") >= capacity // 8))
        .select("shard", "seq", (F.lit(capacity) - F.col("gap")).alias("held"), "lot")
        .withColumnsRenamed({"shard": "from_shard", "seq": "from_seq"})
    )
    again = pack_shards(loose, "held", capacity).select(
        F.col("from_shard").alias("shard"), F.col("from_seq").alias("seq"),
        # Numbers below zero belong to the second round.
        (-1 - (F.shiftleft(F.col("shard"), 32) + F.col("seq"))).alias("_sequence"), F.col("at").alias("_base"),
    )
    return first.join(again, ["shard", "seq"], "left").select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        F.coalesce("_sequence", F.shiftleft(F.col("shard"), 32) + F.col("seq")).alias("sequence_id"),
        (F.coalesce("_base", F.lit(0)) + F.col("at")).alias("offset"),
    )
