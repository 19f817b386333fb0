"""Near-duplicate embeddings by hashing to the E8 lattice.

Each of several tables projects the vectors to 8 random directions and takes the nearest
point of the E8 lattice, the densest in 8 dimensions, as the cell. A vector lies in its own
cell and visits the neighbouring cells nearest to it; vectors that meet are compared by
cosine in double precision. A pair may meet in many cells and is counted in one of them:
the first table, and there the smaller cell, which both sides can tell from their vectors.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chainlake.llm.base import by_batch, written
from chainlake.llm.components import components
from chainlake.llm.ngram_join import Groups

TABLES = 7
PROBES = 4
# Size of the cells. A pair at cosine 0.9 meets in one table with a probability of 0.52, in
# one of seven with 0.99; random vectors share a cell with a probability below 0.0005.
SCALE = 1.5
COSINE = 0.9
# Vectors of a cell that one task compares at once; larger cells are cut to blocks.
BLOCK = 2048


@lru_cache(maxsize=1)
def neighbours() -> np.ndarray:
    """The 240 shortest vectors of E8: two coordinates of +-1, or all of +-1/2 with an even
    number of minus signs."""
    out = []
    for i in range(8):
        for j in range(i):
            for a, b in product((1.0, -1.0), repeat=2):
                row = np.zeros(8)
                row[i], row[j] = a, b
                out.append(row)
    out += [np.array(signs) / 2 for signs in product((1.0, -1.0), repeat=8) if np.prod(signs) > 0]
    return np.array(out)


def nearest_even(x: np.ndarray) -> np.ndarray:
    """The nearest integer point whose coordinates have an even sum: where the rounded point
    has an odd sum, the coordinate furthest from its integer goes to the other side."""
    point = np.rint(x)
    rest = x - point
    odd = np.flatnonzero(point.sum(axis=1).astype(np.int64) & 1)
    worst = np.abs(rest[odd]).argmax(axis=1)
    point[odd, worst] += np.where(rest[odd, worst] >= 0, 1.0, -1.0)
    return point


def nearest_point(x: np.ndarray) -> np.ndarray:
    """The nearest point of E8: of the even integer points and those shifted by one half."""
    whole, half = nearest_even(x), nearest_even(x - 0.5) + 0.5
    closer = ((x - whole) ** 2).sum(axis=1) <= ((x - half) ** 2).sum(axis=1)
    return np.where(closer[:, None], whole, half)


@lru_cache(maxsize=8)
def directions(size: int, tables: int) -> np.ndarray:
    return np.random.default_rng(size).standard_normal((size, tables * 8)) / SCALE


def cell_number(points: np.ndarray) -> np.ndarray:
    """A 64-bit number per table and lattice point: ``points`` is (vectors, tables, ..., 8)."""
    twice = np.rint(points * 2).astype(np.int64).astype(np.uint64)
    shape = (1, -1) + (1,) * (points.ndim - 3)
    out = np.broadcast_to(np.arange(1, points.shape[1] + 1, dtype=np.uint64).reshape(shape), points.shape[:-1]).copy()
    for i in range(8):
        out = (out ^ twice[..., i]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(31)
    return out.astype(np.int64)


def cells(unit: np.ndarray, tables: int, probes: int) -> np.ndarray:
    """Per vector and table its own cell and, after it, those it visits."""
    n, size = unit.shape
    # Rounded, so that the order of additions does not matter.
    x = np.round(unit @ directions(size, tables), 6).reshape(n * tables, 8)
    point = nearest_point(x)
    near = np.argsort(-np.round((x - point) @ neighbours().T, 6), axis=1, kind="stable")[:, :probes]
    points = np.concatenate([point[:, None, :], point[:, None, :] + neighbours()[near]], axis=1)
    return cell_number(points.reshape(n, tables, probes + 1, 8))


def units(raw: list[bytes], kind: str) -> np.ndarray:
    x = np.frombuffer(b"".join(raw), dtype=kind).astype(np.float64).reshape(len(raw), -1)
    # By the largest component first, so that squares neither overflow nor vanish.
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def by_size(raw: list[bytes]) -> Iterator[np.ndarray]:
    """Rows of equal numbers of components; only such vectors are compared."""
    sizes = np.array([len(r) for r in raw])
    for size in np.unique(sizes):
        yield np.flatnonzero(sizes == size)


def first_meeting(home: np.ndarray, other: np.ndarray) -> np.ndarray:
    """The cell in which pairs of vectors are counted, from the cells of both sides."""
    a, b = home[:, :, 0], other[:, :, 0]
    at_a = (other == a[:, :, None]).any(axis=2)
    at_b = (home == b[:, :, None]).any(axis=2)
    table = (at_a | at_b).argmax(axis=1)
    row = np.arange(len(home))
    a, b, at_a, at_b = a[row, table], b[row, table], at_a[row, table], at_b[row, table]
    return np.where(at_a & at_b, np.minimum(a, b), np.where(at_a, a, b))


def compare_cells(
    batches: Iterator[pa.RecordBatch], kind: str, cosine: float, tables: int, probes: int
) -> Iterator[pa.RecordBatch]:
    """Compare the vectors of each cell; rows come in the order of cell and block. Gives the
    weight of the links a vector has in a cell, and links that connect what they can."""
    groups = Groups()
    key, rows = None, []
    a_out: list[int] = []
    b_out: list[int | None] = []
    n_out: list[int] = []

    def done() -> None:
        if len(rows) < 2:
            return
        everything = [r[2] for r in rows]
        for same in by_size(everything):
            part = [rows[i] for i in same.tolist()]
            if len(part) > 1:
                compare(key[0], part)

    def compare(cell: int, part: list[tuple]) -> None:
        rid = np.array([r[0] for r in part], dtype=np.int64)
        weight = np.array([r[1] for r in part], dtype=np.int64)
        own = np.array([r[3] for r in part], dtype=bool)
        as_row, as_column = np.array([r[4] for r in part], dtype=bool), np.array([r[5] for r in part], dtype=bool)
        vectors = units([r[2] for r in part], kind)
        left, right = np.flatnonzero(own & as_row), np.flatnonzero(as_column)
        degree = np.zeros(len(part), dtype=np.int64)
        for start in range(0, len(left), BLOCK):
            some = left[start : start + BLOCK]
            i, j = np.nonzero(vectors[some] @ vectors[right].T >= cosine)
            i, j = some[i], right[j]
            # Two vectors of this cell are one pair, not two.
            once = (rid[i] != rid[j]) & (~own[j] | (rid[i] < rid[j]))
            i, j = i[once], j[once]
            if not len(i):
                continue
            met, back = np.unique(np.concatenate([i, j]), return_inverse=True)
            where = cells(vectors[met], tables, probes)
            for begin in range(0, len(i), 1 << 18):
                x, y = i[begin : begin + (1 << 18)], j[begin : begin + (1 << 18)]
                bx, by = back[: len(i)][begin : begin + len(x)], back[len(i) :][begin : begin + len(x)]
                here = np.concatenate(
                    [first_meeting(where[bx[k : k + 8192]], where[by[k : k + 8192]]) for k in range(0, len(x), 8192)]
                ) == cell
                x, y = x[here], y[here]
                np.add.at(degree, x, weight[y])
                np.add.at(degree, y, weight[x])
                for p, q in zip(rid[x].tolist(), rid[y].tolist()):
                    if groups.join(p, q):
                        a_out.append(p)
                        b_out.append(q)
                        n_out.append(0)
        linked = np.flatnonzero(degree)
        a_out.extend(rid[linked].tolist())
        b_out.extend([None] * len(linked))
        n_out.extend(degree[linked].tolist())

    def out() -> pa.RecordBatch:
        made = pa.RecordBatch.from_arrays(
            [pa.array(a_out, pa.int64()), pa.array(b_out, pa.int64()), pa.array(n_out, pa.int64())], names=["a", "b", "n"]
        )
        for column in (a_out, b_out, n_out):
            column.clear()
        return made

    names = ("cell", "left", "right", "rid", "weight", "raw", "own", "as_row", "as_column")
    for batch in batches:
        for cell, low, high, *row in zip(*[batch.column(batch.schema.get_field_index(c)).to_pylist() for c in names]):
            if key != (cell, low, high):
                done()
                key, rows = (cell, low, high), []
            rows.append(tuple(row))
        if len(a_out) > 10_000:
            yield out()
    done()
    if a_out:
        yield out()


def raw_vectors(vectors: DataFrame, id: str, vector: str) -> tuple[DataFrame, str]:
    """``vec_id, raw, key``: the components as bytes (null for vectors that link with
    nothing) and a digest of them."""
    element = vectors.schema[vector].dataType.elementType
    kind = "<f4" if isinstance(element, T.FloatType) else "<f8"
    numbers = "float" if kind == "<f4" else "double"
    source = vectors.select(F.col(f"`{id}`").alias("vec_id"), F.col(f"`{vector}`").cast(f"array<{numbers}>").alias("vector"))
    id_kind = source.schema["vec_id"].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        raw: list[bytes | None] = []
        for value in batch.column(1):
            row = value.values
            usable = value.is_valid and len(row) and row.null_count == 0
            x = row.to_numpy(zero_copy_only=False).astype(kind) if usable else None
            raw.append(x.tobytes() if usable and np.isfinite(x).all() and x.any() else None)
        keys = [None if r is None else hashlib.md5(r).digest() for r in raw]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(raw, pa.binary()), pa.array(keys, pa.binary())], names=["vec_id", "raw", "key"])

    return by_batch(source, run, f"vec_id {id_kind}, raw binary, key binary"), kind


def visits(classes: DataFrame, kind: str, tables: int, probes: int, with_vector: bool) -> DataFrame:
    """A row per vector and cell that it lies in (``own``) or visits."""
    rows = classes.select("rid", "weight", "raw")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (p for start in range(0, batch.num_rows, 256) for p in [batch.slice(start, 256)]):
                raw = part.column(2).to_pylist()
                for same in by_size(raw):
                    found = cells(units([raw[i] for i in same.tolist()], kind), tables, probes).reshape(-1)
                    take = pa.array(np.repeat(same, tables * (probes + 1)))
                    own = pa.array(np.tile(np.arange(tables * (probes + 1)) % (probes + 1) == 0, len(same)))
                    columns = [pa.array(found), part.column(0).take(take), part.column(1).take(take), own]
                    if with_vector:
                        columns.append(part.column(2).take(take))
                    yield pa.RecordBatch.from_arrays(columns, names=["cell", "rid", "weight", "own", "raw"][: len(columns)])

    return rows.mapInArrow(run, "cell long, rid long, weight long, own boolean" + (", raw binary" if with_vector else ""))


def near_duplicates(
    vectors: DataFrame, cosine: float = COSINE, tables: int = TABLES, probes: int = PROBES,
    id: str = "vec_id", vector: str = "embedding",
) -> DataFrame:
    """Link vectors whose cosine is at least ``cosine``: ``vec_id, n_links, component_id,
    kept``. Of the pairs at exactly 0.9 about 99 of 100 are found, of closer ones more; no
    pair below the threshold is linked.

    Null, empty and zero vectors and those with null or non-finite components link with
    nothing. Vectors of different lengths don't link. Rows that repeat an id and a vector
    are one vector; equal vectors are compared as one and count as many links as there are.
    Null ids are one id, smaller than all others. An empty table gives no rows.
    """
    made, kind = raw_vectors(vectors, id, vector)
    rows = written(made.withColumn("rid", F.monotonically_increasing_id()), "vectors")
    one_each = rows.where("key is not null").groupBy("key", "vec_id").agg(F.min(F.struct("rid", "raw")).alias("one"))
    classes = written(
        one_each.groupBy("key").agg(F.count(F.lit(1)).alias("weight"), F.min("one").alias("one"))
        .select("key", "weight", "one.rid", "one.raw"), "classes",
    )
    crowded = (
        visits(classes, kind, tables, probes, False).groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("own").alias("lived"))
        .where("lived and n > 1").select("cell", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    )
    met = visits(classes, kind, tables, probes, True).join(crowded, "cell")
    block = F.pmod(F.xxhash64("rid"), F.col("blocks")).cast("int")
    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    usual = met.where("blocks = 1").select(
        "*", F.lit(0).alias("left"), F.lit(0).alias("right"), F.lit(True).alias("as_row"), F.lit(True).alias("as_column")
    )
    grid = met.where("blocks > 1")
    in_rows = grid.where("own").select("*", block.alias("left"), F.explode(every).alias("right"), F.lit(True).alias("as_row"), F.lit(False).alias("as_column"))
    in_columns = grid.select("*", F.explode(every).alias("left"), block.alias("right"), F.lit(False).alias("as_row"), F.lit(True).alias("as_column"))
    placed = usual.unionByName(in_rows.select(usual.columns)).unionByName(in_columns.select(usual.columns))
    ordered = placed.repartition("cell", "left", "right").sortWithinPartitions("cell", "left", "right")
    found = written(ordered.mapInArrow(lambda b: compare_cells(b, kind, cosine, tables, probes), "a long, b long, n long"), "links")
    degree = found.where("b is null").groupBy("a").agg(F.sum("n").alias("others"))
    parts = components(found.where("b is not null").select("a", "b"))
    named = (
        classes.select("key", "weight", "rid").join(degree, F.col("rid") == F.col("a"), "left")
        .join(parts, F.col("rid") == F.col("node"), "left")
        .select("key", (F.col("weight") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), F.coalesce("component", "rid").alias("part"))
    )
    all_rows = rows.select("vec_id", "key").join(named, "key", "left")
    least = all_rows.where("part is not null").groupBy("part").agg(F.min(F.struct("vec_id"))["vec_id"].alias("least"))
    component = F.when(F.col("part").isNull(), F.col("vec_id")).otherwise(F.col("least"))
    return all_rows.join(least, "part", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
