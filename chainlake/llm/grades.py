"""Quality grades by ordinal regression on hashed text.

Ratings are grades in order. One weight per hashed feature gives a document a score, and
ordered thresholds cut the scores to grades (a cumulative link): the chance of a grade of at
least k is the logistic of score minus threshold k. Expected grade and tail probability
follow, and select documents.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chainlake.llm.base import by_batch
from chainlake.llm.words import coded, document_of

# Features are hashed to so many buckets.
BUCKETS = 1 << 18
# Most labelled documents the model is fitted on: those whose ids have the lowest hashes.
SAMPLE = 10_000
# Buckets met in fewer documents of the sample keep the weight zero.
LEAST_DOCS = 4
ROUNDS = 300
RATE = 0.1
# What a weight has to gain in likelihood per document.
SPARSE = 3e-4
# A document is selected when it has the highest grade with at least this probability.
LEAST_TAIL = 0.5


def bucket(kind: bytes, value: bytes) -> int:
    return xxhash.xxh3_64_intdigest(kind + value) % BUCKETS


def word_features(word: bytes) -> tuple[int, int, int]:
    """The word without marks and in lower case, the marks it ends in, and its case."""
    core = word.strip(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")
    tail = word[len(word.rstrip(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")) :]
    case = b"digit" if core.isdigit() else b"upper" if len(core) > 1 and core.isupper() else b"other"
    return bucket(b"w", core.lower()), bucket(b"t", tail), bucket(b"c", case)


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct buckets of each text, one text after another, and where each begins and
    ends. Besides its words a text has one feature for the share of words that are new and
    one for the logarithm of its length."""
    codes, bounds, vocabulary = coded(texts)
    table = np.array([word_features(w) for w in vocabulary], dtype=np.int64).reshape(-1, 3)
    docs = document_of(bounds)
    words = np.unique(docs * np.int64(len(vocabulary) + 1) + codes)
    different = np.bincount(words // (len(vocabulary) + 1), minlength=len(texts))
    n = np.diff(bounds)
    share = (10 * different) // np.maximum(n, 1)
    length = np.log2(n + 1).astype(np.int64)
    lookup = np.array([[bucket(b"s", b"%d" % i), bucket(b"l", b"%d" % i)] for i in range(64)], dtype=np.int64)
    at = np.concatenate([np.repeat(words // (len(vocabulary) + 1), 3), np.arange(len(texts)), np.arange(len(texts))])
    found = np.concatenate([table[words % (len(vocabulary) + 1)].ravel(), lookup[share, 0], lookup[length, 1]])
    keys = np.unique(at * np.int64(BUCKETS) + found)
    begins = np.searchsorted(keys // BUCKETS, np.arange(len(texts) + 1))
    return (keys % BUCKETS).astype(np.int32), begins


@dataclass(frozen=True)
class Model:
    """Weights per bucket and thresholds in rising order; ``thresholds[k - 1]`` belongs to
    grade k."""

    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, found: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Per text the probability of each grade from 1 upward, or a higher one."""
        score = summed(self.weights[found], bounds)
        return logistic(score[:, None] - self.thresholds[None, :])


def logistic(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1.0 + np.tanh(0.5 * x))


def summed(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    return total[bounds[1:]] - total[bounds[:-1]]


def cuts_of(free: np.ndarray) -> np.ndarray:
    """Thresholds in rising order from a first one and the logarithms of the steps between."""
    return free[0] + np.concatenate([[0.0], np.cumsum(np.exp(free[1:]))])


def loss_and_gradient(
    weights: np.ndarray, free: np.ndarray, docs: np.ndarray, cols: np.ndarray, grades: np.ndarray
) -> tuple[float, np.ndarray]:
    """Mean negative log-likelihood of the grades, and its gradient by weights and thresholds.
    Feature ``cols[i]`` occurs in document ``docs[i]``."""
    n, top = len(grades), len(free)
    rows = np.arange(n)
    score = np.bincount(docs, weights=weights[cols], minlength=n)
    tail = logistic(score[:, None] - cuts_of(free)[None, :])
    edge = np.concatenate([np.ones((n, 1)), tail, np.zeros((n, 1))], axis=1)
    chance = np.maximum(edge[rows, grades] - edge[rows, grades + 1], 1e-12)
    slope = edge * (1 - edge)
    by_score = -(slope[rows, grades] - slope[rows, grades + 1]) / chance / n
    by_cut = np.zeros(top)
    for k in range(1, top + 1):
        by_cut[k - 1] = (np.sum((slope[:, k] / chance)[grades == k]) - np.sum((slope[:, k] / chance)[grades == k - 1])) / n
    by_free = np.concatenate([[by_cut.sum()], [by_cut[k:].sum() * np.exp(free[k]) for k in range(1, top)]])
    return -float(np.log(chance).mean()), np.concatenate([np.bincount(cols, weights=by_score[docs], minlength=len(weights)), by_free])


def fit(found: np.ndarray, bounds: np.ndarray, grades: np.ndarray, top: int, sparse: float = SPARSE) -> Model:
    """Maximum likelihood by Adam over all documents. Weights are drawn to zero by a step of
    fixed size, so that only features that tell grades apart keep one."""
    n = len(grades)
    docs = document_of(bounds)
    common = np.bincount(found, minlength=BUCKETS) >= LEAST_DOCS
    used = common[found]
    docs, cols = docs[used], found[used]
    names, cols = np.unique(cols, return_inverse=True)
    weights = np.zeros(len(names))
    # Thresholds start at the sample's own shares; steps between them stay positive.
    shares = np.array([(np.sum(grades >= k) + 1) / (n + 2) for k in range(1, top + 1)])
    cuts = -np.log(shares / (1 - shares))
    free = np.concatenate([cuts[:1], np.log(np.maximum(np.diff(cuts), 1e-3))])
    state = np.zeros((2, len(weights) + len(free)))
    for turn in range(1, ROUNDS + 1):
        gradient = loss_and_gradient(weights, free, docs, cols, grades)[1]
        state[0] = 0.9 * state[0] + 0.1 * gradient
        state[1] = 0.99 * state[1] + 0.01 * gradient**2
        scale = RATE / (np.sqrt(state[1] / (1 - 0.99**turn)) + 1e-4)
        move = scale * state[0] / (1 - 0.9**turn)
        free -= move[len(weights) :]
        weights -= move[: len(weights)]
        weights = np.sign(weights) * np.maximum(np.abs(weights) - sparse * scale[: len(weights)], 0)
    every = np.zeros(BUCKETS)
    every[names] = weights
    return Model(every, cuts_of(free))


def utf8(docs: DataFrame, id: str, text: str) -> DataFrame:
    return docs.select(
        F.col(f"`{id}`").alias("doc_id"), F.encode(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")), "UTF-8").alias("_utf8")
    )


def sample_of(docs: DataFrame, labels: DataFrame, grade: Column, top: int, most: int, id: str, text: str) -> list:
    """Buckets and grade of at most ``most`` labelled documents, told apart by id and text; a
    document with several grades has the lowest. Grades but 0 to ``top`` are no ratings."""
    rated = labels.select(F.col(f"`{id}`").alias("doc_id"), grade.cast("int").alias("grade")).where("doc_id is not null")
    rated = rated.where(F.col("grade").between(0, top))
    chosen = rated.groupBy("doc_id").agg(F.min("grade").alias("grade")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    # No more than ``most`` rows of two numbers.
    rows = utf8(docs, id, text).join(F.broadcast(chosen), "doc_id").withColumn("digest", F.md5("_utf8"))
    rows = rows.dropDuplicates(["doc_id", "digest"]).select("doc_id", "_utf8", "grade", "digest")
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found, bounds = features([bytes(t) for t in batch.column(1).to_pylist()])
        lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(found))
        return pa.RecordBatch.from_arrays([*[batch.column(i) for i in (0, 2, 3)], lists], names=["doc_id", "grade", "digest", "found"])

    made = by_batch(rows, run, f"doc_id {kind}, grade int, digest string, found array<int>")
    # An id may stand for many texts.
    out = made.orderBy(F.xxhash64("doc_id", "digest"), "doc_id", "digest").limit(most).toArrow().to_pylist()
    return sorted(out, key=lambda r: (r["doc_id"], r["found"]))


def train(
    docs: DataFrame, labels: DataFrame, grade: Column, top: int, most: int = SAMPLE, id: str = "doc_id", text: str = "text"
) -> Model:
    """Fit on a sample of at most ``most`` labelled documents, graded 0 to ``top``; labels with
    another grade, or none, are left out. Without any, all weights are zero and every grade
    has the same chance."""
    rows = sample_of(docs, labels, grade, top, most, id, text)
    if not rows:
        chance = np.arange(top, 0, -1) / (top + 1)
        return Model(np.zeros(BUCKETS), -np.log(chance / (1 - chance)))
    found = np.concatenate([np.array(r["found"], dtype=np.int64) for r in rows])
    bounds = np.concatenate([[0], np.cumsum([len(r["found"]) for r in rows])])
    return fit(found, bounds, np.array([r["grade"] for r in rows]), top)


def graded(docs: DataFrame, model: Model, least: float = LEAST_TAIL, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Grade every document: ``doc_id, expected_grade, tail`` (chance of the highest grade)
    and ``kept`` (tail at least ``least``).

    Null and empty texts have no words and are graded by their length alone. One row per
    input row, repeated rows and null ids included; other columns are ignored.
    """
    source = utf8(docs, id, text)
    kind = source.schema["doc_id"].dataType.simpleString()
    # One number per bucket: a size fixed by BUCKETS.
    shared = docs.sparkSession.sparkContext.broadcast((model.weights.astype(np.float32), model.thresholds))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        weights, thresholds = shared.value
        tails = Model(weights, thresholds).tails(*features([bytes(t) for t in batch.column(1).to_pylist()]))
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(tails.sum(axis=1)), pa.array(tails[:, -1]), pa.array(tails[:, -1] >= least)],
            names=["doc_id", "expected_grade", "tail", "kept"],
        )

    return by_batch(source, run, f"doc_id {kind}, expected_grade double, tail double, kept boolean")
