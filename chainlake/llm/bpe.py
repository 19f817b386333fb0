"""Byte-level BPE by replaying the merges over a whole vocabulary of words at once.

Each task gathers the distinct words of its documents, lays their bytes out in one array
and keeps an inverted index from rank (the token a pair merges to) to the positions of such
pairs. Ranks are taken in order; all pairs of a rank merge in one step, and only the pairs
beside a merged one are looked up again. Words don't touch one another, so the steps give
each word the tokens it would get alone.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chainlake.llm.base import gathered, in_slices
from chainlake.llm.chunks import Codes, Memo, ranges

# No pair, or one that merges to nothing.
NONE = np.int32(2**31 - 1)
# Bytes of text whose new words are replayed together.
GATHER = 24 << 20


class Merges:
    """The ranks of a vocabulary and the pairs of tokens that merge."""

    def __init__(self, ranks: dict[bytes, int]):
        self.bytes_of = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.bytes_of[rank] = token
        self.blob = np.frombuffer(b"".join(self.bytes_of), dtype=np.uint8)
        self.blob_len = np.array([len(token) for token in self.bytes_of], dtype=np.int64)
        self.blob_at = np.cumsum(self.blob_len) - self.blob_len
        self.text_of = [str(rank) for rank in range(len(self.bytes_of))]
        self.single = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        self.width = np.int64(len(self.bytes_of))
        pairs = []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs.append((left * len(self.bytes_of) + right, rank))
        pairs.sort()
        self.keys = np.array([key for key, _ in pairs], dtype=np.int64)
        self.ranks = np.array([rank for _, rank in pairs], dtype=np.int32)

    def lookup(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank each pair merges to, or NONE."""
        key = left * self.width + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NONE)

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes that ids stand for."""
        return self.blob[ranges(self.blob_at[ids], self.blob_len[ids])].tobytes()

    def replay(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of all words one after another, and where each word's tokens begin."""
        lens = np.array([len(word) for word in words], dtype=np.int64)
        ends = np.cumsum(lens)
        ids = self.single[np.frombuffer(b"".join(words), dtype=np.uint8)]
        n = len(ids)
        starts = np.concatenate([[0], ends])
        if n == 0:
            return ids, np.zeros(len(words) + 1, dtype=np.int64)
        after = np.arange(1, n + 1, dtype=np.int32)
        before = np.arange(-1, n - 1, dtype=np.int32)
        full = lens > 0
        after[ends[full] - 1] = -1
        before[ends[full] - lens[full]] = -1
        rank = np.full(n, NONE, dtype=np.int32)
        pair = np.flatnonzero(after >= 0).astype(np.int32)
        if len(self.keys):
            rank[pair] = self.lookup(ids[pair].astype(np.int64), ids[pair + 1])

        index: dict[int, list[np.ndarray]] = {}
        waiting: list[int] = []

        def remember(at: np.ndarray) -> None:
            """Index the pairs that begin at these positions under their rank."""
            at = at[rank[at] != NONE]
            if not len(at):
                return
            at = at[np.argsort(rank[at], kind="stable")]
            found = rank[at]
            cuts = np.flatnonzero(found[1:] != found[:-1]) + 1
            for part in np.split(at, cuts) if len(cuts) else [at]:
                key = int(rank[part[0]])
                if key in index:
                    index[key].append(part)
                else:
                    index[key] = [part]
                    heapq.heappush(waiting, key)

        remember(pair)
        while waiting:
            key = heapq.heappop(waiting)
            parts = index.pop(key)
            at = np.sort(parts[0] if len(parts) == 1 else np.concatenate(parts))
            at = at[(rank[at] == key) & np.concatenate([[True], at[1:] != at[:-1]])]
            if not len(at):
                continue
            if len(at) > 1:
                # Of overlapping pairs (aaa) every second one merges, from the left.
                linked = np.concatenate([[False], after[at[:-1]] == at[1:]])
                if linked.any():
                    place = np.arange(len(at))
                    begin = np.maximum.accumulate(np.where(linked, 0, place))
                    at = at[(place - begin) % 2 == 0]
            gone = after[at]
            beyond = after[gone]
            ids[at] = key
            ids[gone] = -1
            rank[gone] = NONE
            after[at] = beyond
            inner = beyond >= 0
            before[beyond[inner]] = at[inner]
            left = before[at]
            touched = np.concatenate([at, left[left >= 0]])
            right = after[touched]
            there = np.maximum(right, 0)
            rank[touched] = np.where(right >= 0, self.lookup(ids[touched].astype(np.int64), ids[there]), NONE)
            remember(touched)

        alive = ids >= 0
        kept = np.concatenate([[0], np.cumsum(alive)])
        return ids[alive], kept[starts]


@lru_cache(maxsize=4)
def merges(path: str) -> Merges:
    """The vocabulary of a rank file: one base64 token and its rank per line."""
    with open(path, "rb") as lines:
        return Merges({base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)})


class Encoder:
    """Encodes texts; keeps the chunks it has met."""

    def __init__(self, path: str, pattern: str):
        self.merges = merges(path)
        self.pattern = regex.compile(pattern)
        self.memo = Memo(self.learn)

    def learn(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the chunks; the merges are replayed over all distinct words at once."""
        words = Codes()
        code, split = words.__getitem__, self.pattern.findall
        flat: list[int] = []
        counts: list[int] = []
        for c in chunks:
            if c[1:].isalpha() and (c[0] == " " or c[0].isalpha()):
                flat.append(code(c))
                counts.append(1)
            else:
                found = split(c)
                flat.extend(map(code, found))
                counts.append(len(found))
        ids, starts = self.merges.replay([w.encode() for w in words])
        made = np.array(flat, dtype=np.int64)
        lens = np.diff(starts)[made]
        ends = np.concatenate([[0], np.cumsum(lens)])
        bounds = ends[np.concatenate([[0], np.cumsum(np.array(counts, dtype=np.int64))])]
        return ids[ranges(starts[made], lens)], np.diff(bounds)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        ids, bounds = self.memo.encode(texts)
        return np.split(ids, bounds[1:-1])

    def digests(self, ids: np.ndarray) -> tuple[int, str, str]:
        """Number of ids, digest of the ids, digest of the bytes that the ids stand for."""
        joined = ",".join(map(self.merges.text_of.__getitem__, ids.tolist()))
        return len(ids), hashlib.sha256(joined.encode()).hexdigest(), hashlib.sha256(self.merges.decode(ids)).hexdigest()


def on_worker(path: str) -> str:
    """A file that every node has, or one shipped with ``SparkContext.addFile``."""
    return path if path.startswith("/") else SparkFiles.get(path)


_ENCODERS: dict[tuple[str, str], Encoder] = {}


def encoder(path: str, pattern: str) -> Encoder:
    """One encoder for all tasks of a worker, so that its memo is used again."""
    key = (path, pattern)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(on_worker(path), pattern)
    return _ENCODERS[key]


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Append the token ids of each row's text as an array column.

    Null and empty texts give an empty array. Rows are independent of one another: repeated
    rows give repeated results. A column that already has the name ``ids`` is replaced.
    """
    others = [c for c in docs.columns if c != ids]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name in others)
    source = docs.select(*[F.col(f"`{c}`") for c in others], F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path, pattern)
        for got in gathered(batches, "_text", GATHER):
            made = iter(coder.encode(got["_text"].to_pylist()))
            for batch in in_slices(got):
                found = [next(made).tolist() for _ in range(batch.num_rows)]
                columns = [batch.column(batch.schema.get_field_index(c)) for c in others]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(found, pa.list_(pa.int32()))], names=[*others, ids])

    return source.mapInArrow(run, f"{fields}, `{ids}` array<int>")


def decode(df: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Append the bytes an array of ids stands for; null and empty arrays give no bytes."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name != out)
    source = df.select(*[F.col(f"`{c}`") for c in df.columns if c != out])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = merges(on_worker(path))
        for batch in batches:
            rows = batch.column(batch.schema.get_field_index(ids)).to_pylist()
            made = [vocabulary.decode(np.array(row or [], dtype=np.int64)) for row in rows]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.binary())], names=[*batch.schema.names, out])

    return source.mapInArrow(run, f"{fields}, `{out}` binary")


def round_trip(docs: DataFrame, path: str, pattern: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode each text, decode its ids, and return digests of both per row:
    ``doc_id, n_tokens, ids_sha256, decoded_sha256``.

    Null and empty texts have no tokens and the digests of nothing. One row per input row,
    repeated rows and null ids included; columns other than the two named are ignored.
    """
    source = docs.select(F.col(f"`{id}`").alias("doc_id"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path, pattern)
        for got in gathered(batches, "text", GATHER):
            made = iter(coder.encode(got["text"].to_pylist()))
            for batch in in_slices(got):
                rows = [coder.digests(next(made)) for _ in range(batch.num_rows)]
                counts, ids, raw = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(ids), pa.array(raw)],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    return source.mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
