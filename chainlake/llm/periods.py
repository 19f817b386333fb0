"""Stretches of words that repeat with a period: maximal runs of three periods or more.

A document's words are numbered, and the document is exploded into overlapping tiles, once for
each octave of periods (1-15, then 16-31, 32-63, ...). The overlap holds two periods, so every
two periods of a run lie in one tile whole. Tiles are dealt to tasks and solved independently:
borders stand so close that two periods of a run contain one, followed by words that come
again a period further on. From such a border a Z-function over what follows tells for all
periods at once how far the words match forwards, one over the reversed words how far they
match backwards; both together are the fragment of a run inside the tile. Fragments are
shuffled by document and period and stitched where they overlap by a period or more.

Only borders whose next eight words come again in the document can lie in a run; other tiles
are not made.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from fractions import Fraction
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chainlake.llm.base import gathered, in_slices, written
from chainlake.llm.chunks import ranges
from chainlake.llm.words import coded, document_of

# A run has so many periods and words at least.
TIMES = 3
SHORTEST = 24
# Words that must come again behind a border, and the first period of the second octave.
SEED = 8
FIRST = 16
# Words of a tile beside its overlap: at least so many, and so many times its shortest period.
TILE = 1024
SPAN = 8
# Bytes of text whose words are numbered together.
GATHER = 8 << 20

MARKED = (
    "row long, n_words long, text_sha256 string, text string, words array<int>, "
    "tiles array<struct<octave:int,start:int,stop:int>>"
)
FRAGMENTS = "row long, period int, start long, stop long"
RESULT = (
    "n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string, "
    "n_words long, runs array<struct<start:long,length:long,period:long>>"
)


def octave(k: int) -> tuple[int, int, int, int]:
    """Of octave ``k``: its shortest period, the first period beyond it, how far its borders
    lie apart, and the words that two neighbouring tiles share."""
    if k == 0:
        return 1, FIRST, SEED, 2 * FIRST
    low = FIRST << (k - 1)
    return low, 2 * low, low // 2, 4 * low


def octaves(words: int) -> int:
    """How many octaves hold a period that ``words`` words can contain often enough."""
    k = 0
    while octave(k)[0] * TIMES <= words and words >= SHORTEST:
        k += 1
    return k


def tiles_of(words: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the tiles of an octave begin and end; a begin is a multiple of the borders' distance."""
    low, _, apart, shared = octave(k)
    step = max(SPAN * low, TILE)
    starts = np.arange(0, max(words - shared, 1), step)
    return starts, np.minimum(starts + step + shared, words)


def grams(codes: np.ndarray) -> np.ndarray:
    """A hash of the ``SEED`` words from each place on; the last places have fewer."""
    n = len(codes)
    value = (codes.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    made = value.copy()
    for i in range(1, min(SEED, n)):
        made[: n - i] = made[: n - i] * np.uint64(0xD6E8FEB86659FD93) + value[i:]
        made[: n - i] ^= made[: n - i] >> np.uint64(29)
    return made


def seeds(gram: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Which places begin ``SEED`` words that come again in the same document (judged by their
    hashes: a few others may be among them)."""
    n = len(gram)
    out = np.zeros(n, dtype=bool)
    doc = document_of(bounds)
    inside = np.flatnonzero(np.arange(n) + SEED <= bounds[1:][doc])
    key = gram[inside] + doc[inside].astype(np.uint64) * np.uint64(0xA24BAED4963EE407)
    order = np.argsort(key, kind="stable")
    ranked = key[order]
    same = ranked[1:] == ranked[:-1]
    again = np.concatenate([[False], same]) | np.concatenate([same, [False]]) if len(ranked) else same
    out[inside[order[again]]] = True
    return out


def worth(again: np.ndarray) -> list[tuple[int, int, int]]:
    """Octave, start and stop of the tiles of a document with a border whose words come again."""
    made = []
    if not again.any():
        return made
    for k in range(octaves(len(again))):
        apart = octave(k)[2]
        starts, stops = tiles_of(len(again), k)
        at = np.flatnonzero(again[::apart]) * apart
        found = np.searchsorted(at, stops) > np.searchsorted(at, starts)
        made += [(k, int(a), int(b)) for a, b in zip(starts[found], stops[found])]
    return made


@lru_cache(maxsize=1 << 16)
def divided(period: int) -> tuple[int, ...]:
    """The period divided by each of its prime factors."""
    primes, rest, p = [], period, 2
    while p * p <= rest:
        if rest % p == 0:
            primes.append(p)
            while rest % p == 0:
                rest //= p
        p += 1
    if rest > 1:
        primes.append(rest)
    return tuple(period // p for p in primes)


def alike(words: np.ndarray, a: int, b: int, most: int) -> int:
    """How many words from ``a`` and from ``b`` on are the same, ``most`` at the most."""
    done, step = 0, 16
    while done < most:
        step = min(step, most - done)
        same = words[a + done : a + done + step] == words[b + done : b + done + step]
        if not same.all():
            return done + int(np.argmin(same))
        done += step
        step *= 4
    return done


def near(words: np.ndarray, gram: np.ndarray, border: int, apart: int, high: int) -> bool:
    """Whether the words from a border on repeat with a period of at most ``apart``, as far as
    any period below ``high`` and the next border reach, or to the end of the tile. Then a
    longer period that holds up to the next border is a multiple of that one."""
    n = len(words)
    found = np.flatnonzero(gram[border + 1 : border + min(apart, n - border - SEED) + 1] == gram[border])
    if not len(found):
        return False
    shift = int(found[0]) + 1
    most = min(high + apart, n - border - shift)
    return alike(words, border, border + shift, most) == most


def z_function(words: np.ndarray, upto: int) -> list[int]:
    """For each shift below ``upto`` how many words match between the words and themselves
    shifted, by the Z-algorithm: what a match reaching further has shown is not compared again."""
    n = len(words)
    z = [0] * max(upto, 1)
    each = words.tolist()
    # Shifts whose first word differs match nothing and need no look.
    begin, end = 0, 0
    for shift in (np.flatnonzero(words[1:upto] == words[0]) + 1).tolist():
        known = 0
        if shift < end:
            known = z[shift - begin]
            if known < end - shift:
                z[shift] = known
                continue
            known = end - shift
        if shift + known < n and each[known] == each[shift + known]:
            known += alike(words, known, shift + known, n - shift - known)
        z[shift] = known
        if shift + known > end:
            begin, end = shift, shift + known
    return z


def solve(words: np.ndarray, k: int) -> set[tuple[int, int, int]]:
    """Fragments ``(period, start, stop)`` of all runs inside one tile, whose smallest period
    belongs to the octave and which hold two periods."""
    low, high, apart, _ = octave(k)
    n = len(words)
    found: set[tuple[int, int, int]] = set()
    gram = grams(words)
    borders = np.flatnonzero(seeds(gram, np.array([0, n]))[::apart]) * apart
    for border in borders.tolist():
        # Periods at which the words up to the next border come again.
        most = min(high, n - border - apart + 1)
        shifts = (np.flatnonzero(gram[border + low : border + most] == gram[border]) + low).tolist() if most > low else []
        # Where words repeat with a far shorter period, all that fits here is a multiple of it.
        if not shifts or k and near(words, gram, border, apart, high):
            continue
        # A fragment that holds the border is known already.
        shifts = [p for p in shifts if not any(q == p and a <= border < b - p for q, a, b in found)]
        shifts = [p for p in shifts if alike(words, border, border + p, apart) == apart]
        if not shifts:
            continue
        forwards = z_function(words[border:], min(high, n - border))
        # A shorter period of the same words is found in its own octave.
        periods = [p for p in shifts if not any(forwards[d] >= p - d for d in divided(p))]
        if not periods:
            continue
        last = min(border + high - 1, n)
        backwards = back(words, border, last)
        for period in periods:
            start = border - backwards[last - border - period]
            stop = border + period + forwards[period]
            if stop - start >= 2 * period:
                found.add((period, start, stop))
    return found


def back(words: np.ndarray, border: int, stop: int) -> list[int]:
    """For each place from ``stop`` down to ``border`` how many words before it match those
    before ``border``: the Z-function of the reversed words before the border, a gap, and the
    reversed words before ``stop``."""
    if not border:
        return [0] * (stop - border + 1)
    head = words[:border][::-1]
    joined = np.concatenate([head, np.array([-1], dtype=words.dtype), words[:stop][::-1]])
    return z_function(joined, border + 1 + stop - border + 1)[border + 1 :]


def marked(docs: DataFrame, text: str, keep: tuple[str, ...]) -> DataFrame:
    """Number each document's words and mark the tiles that may hold a run. Only documents with
    such tiles keep their text and numbers. ``row`` tells rows apart from here on."""
    kept = [F.col(f"`{c}`").alias(f"kept_{c}") for c in keep]
    source = docs.select(F.monotonically_increasing_id().alias("row"), *kept, F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema if f.name.startswith("kept_"))
    tile = pa.struct([("octave", pa.int32()), ("start", pa.int32()), ("stop", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for got in gathered(batches, "text", GATHER):
            texts = [t.encode() for t in got["text"].to_pylist()]
            codes, bounds, _ = coded(texts)
            again = seeds(grams(codes), bounds)
            at = 0
            for batch in in_slices(got):
                here = range(at, at + batch.num_rows)
                at += batch.num_rows
                spans = [(bounds[i], bounds[i + 1]) for i in here]
                tiles = [worth(again[a:b]) for a, b in spans]
                plain = [hashlib.sha256(b" ".join(texts[i].split())).hexdigest() for i in here]
                out = [
                    batch.column("row"), pa.array([int(b - a) for a, b in spans], pa.int64()), pa.array(plain),
                    pa.array([texts[i].decode() if t else None for i, t in zip(here, tiles)], pa.string()),
                    pa.array([codes[a:b] if t else None for (a, b), t in zip(spans, tiles)], pa.list_(pa.int32())),
                    pa.array([[{"octave": k, "start": a, "stop": b} for k, a, b in t] for t in tiles], pa.list_(tile)),
                    *[batch.column(f"kept_{c}") for c in keep],
                ]
                names = ["row", "n_words", "text_sha256", "text", "words", "tiles", *[f"kept_{c}" for c in keep]]
                yield pa.RecordBatch.from_arrays(out, names=names)

    return source.mapInArrow(run, f"{MARKED}{', ' if fields else ''}{fields}")


def fragments(tiles: DataFrame) -> DataFrame:
    """Solve tiles (``row, octave, start, words``): fragments of runs, numbered by the document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, periods, starts, stops = [], [], [], []
            words = batch.column("words")
            flat, cuts = words.values.to_numpy(zero_copy_only=False), words.offsets.to_numpy()
            head = zip(batch.column("row").to_pylist(), batch.column("octave").to_pylist(), batch.column("start").to_pylist())
            for i, (row, k, start) in enumerate(head):
                for period, a, b in sorted(solve(flat[cuts[i] : cuts[i + 1]], k)):
                    rows.append(row)
                    periods.append(period)
                    starts.append(start + a)
                    stops.append(start + b)
            if rows:
                made = [pa.array(rows, pa.int64()), pa.array(periods, pa.int32()), pa.array(starts, pa.int64()), pa.array(stops, pa.int64())]
                yield pa.RecordBatch.from_arrays(made, names=["row", "period", "start", "stop"])

    return tiles.mapInArrow(run, FRAGMENTS)


def stitched(found: DataFrame) -> DataFrame:
    """Join fragments of a document and period that overlap by a period or more; returns the
    runs, ``row, period, start, length``."""
    order = Window.partitionBy("row", "period").orderBy("start", "stop")
    before = F.max("stop").over(order.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.when(before - F.col("start") >= F.col("period"), 0).otherwise(1)
    return (
        found.distinct()
        .withColumn("_fresh", fresh).withColumn("_run", F.sum("_fresh").over(order))
        .groupBy("row", "period", "_run").agg(F.min("start").alias("start"), F.max("stop").alias("stop"))
        .select("row", "period", "start", (F.col("stop") - F.col("start")).alias("length"))
        .where((F.col("length") >= SHORTEST) & (F.col("length") >= TIMES * F.col("period")))
    )


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words without those of a run behind its first period."""
    gone = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in runs:
        gone[start + period] += 1
        gone[start + length] -= 1
    return b" ".join(w for w, g in zip(words, np.cumsum(gone).tolist()) if not g)


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int]:
    """The run of the most periods; of equals the first, then the one of the shortest period."""
    return max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]))


def described(df: DataFrame, keep: tuple[str, ...]) -> DataFrame:
    """Digests and texts from documents and their runs."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name.startswith("kept_"))
    nothing = hashlib.sha256(b"").hexdigest()
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def result(n: int, plain: str, text: str | None, found: list[dict] | None) -> tuple:
        if not found:
            return 0, None, None, None, None, nothing, plain, n, []
        runs = sorted((r["start"], r["length"], r["period"]) for r in found)
        runs.sort(key=lambda r: (r[0], r[2]))
        start, length, period = strongest(runs)
        lines = "".join(f"{a},{b},{p}\n" for a, b, p in runs).encode()
        left = collapsed(text.encode().split(), runs)
        listed = [{"start": a, "length": b, "period": p} for a, b, p in runs]
        digests = hashlib.sha256(lines).hexdigest(), hashlib.sha256(left).hexdigest()
        return len(runs), start, length, period, 1000 * length // period, *digests, n, listed

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64()] * 5 + [pa.string()] * 2 + [pa.int64(), kind]
        names = ["n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256", "n_words", "runs"]
        for batch in batches:
            given = zip(*[batch.column(c).to_pylist() for c in ("n_words", "text_sha256", "text", "found")])
            columns = list(zip(*[result(*row) for row in given]))
            if columns:
                made = [pa.array(c, t) for c, t in zip(columns, types)]
                yield pa.RecordBatch.from_arrays([*[batch.column(f"kept_{c}") for c in keep], *made], names=[*[f"kept_{c}" for c in keep], *names])

    return df.mapInArrow(run, f"{fields}{', ' if fields else ''}{RESULT}")


def periodic_runs(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs`` its maximal runs: stretches of consecutive words with a smallest period
    ``q``, of at least ``max(24, 3 q)`` words, that no neighbouring word extends.

    Returns ``doc_id, n_runs``; ``start, length, period, exponent_milli`` of the run of the
    most periods (nulls without a run); ``runs_sha256`` of all runs as lines; ``collapsed_sha256``
    of the words left when each run keeps its first period; ``n_words`` and ``runs``.

    Null, empty and blank texts have no words. Each input row gives one row, whatever its id;
    repeated rows give repeated results. Other columns are ignored.
    """
    numbered = written(marked(docs, text, (id,)), "periods")
    cut = F.slice("words", F.col("t.start") + 1, F.col("t.stop") - F.col("t.start"))
    # Tiles of one document go to many tasks.
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tiles = (
        numbered.where(F.size("tiles") > 0).select("row", "words", F.explode("tiles").alias("t"))
        .select("row", F.col("t.octave").alias("octave"), F.col("t.start").cast("long").alias("start"), cut.alias("words"))
        .repartition(parts, "row", "octave", "start")
    )
    runs = stitched(fragments(tiles)).groupBy("row").agg(F.collect_list(F.struct("start", "length", F.col("period").cast("long").alias("period"))).alias("found"))
    joined = numbered.join(runs, "row", "left").select("n_words", "text_sha256", "text", "found", f"kept_{id}")
    return described(joined, (id,)).withColumnRenamed(f"kept_{id}", "doc_id")
