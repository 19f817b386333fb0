"""Cleaning a chain's observed head numbers.

The safe head follows the observed one, except that a step back of more than ``tolerance``
blocks is ignored and a step forward of more than ``jump`` blocks is shortened to ``jump``.
Each value depends on the one before, so a chain is a sequential fold. Its observations are
cut to slices of sequence numbers: a slice is first summed up as a function of the head it
starts from, the slices' starting heads follow from these functions, and then all slices
are folded at the same time.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from chainlake.operators import ordered
from chainlake.operators.ordered import Running

# Limits of the tracker, and the jump of the batch provider.
TOLERANCE = 5
JUMP = 100
BATCH_JUMP = 200

FRESH_SECONDS = 15

# Sequence numbers folded in one task.
SLICE = 50_000


def step(safe: int | None, raw: int, tolerance: int, jump: int) -> int:
    if safe is None:
        return raw
    if raw < safe - tolerance:
        return safe
    return min(raw, safe + jump)


def fold(raws: Iterable[int], safe: int | None, tolerance: int, jump: int) -> list[int]:
    out = []
    for raw in raws:
        safe = step(safe, raw, tolerance, jump)
        out.append(safe)
    return out


# A piece (start, fixed, value) covers starting heads from ``start`` to the next piece:
# the slice ends at ``value`` if fixed, otherwise at the starting head plus ``value``.
Piece = tuple[int, bool, int]


def follow(pieces: list[Piece], raw: int, tolerance: int, jump: int, highest: int) -> list[Piece]:
    """The function for a slice extended by one observation, for starting heads from the
    first piece's start up to ``highest``."""
    out: list[Piece] = []

    def add(start: int, fixed: bool, value: int) -> None:
        if start <= highest and (not out or out[-1][1:] != (fixed, value)):
            out.append((start, fixed, value))

    for i, (start, fixed, value) in enumerate(pieces):
        if fixed:
            add(start, True, step(value, raw, tolerance, jump))
            continue
        end = pieces[i + 1][0] if i + 1 < len(pieces) else highest + 1
        near, far = raw - jump - value, raw + tolerance + 1 - value
        if start < near:
            add(start, False, value + jump)
        if max(start, near) < min(end, far):
            add(max(start, near), True, raw)
        if far < end:
            add(max(start, far), False, value)
    return out


def summed_up(raws: Iterable[int], lowest: int, highest: int, tolerance: int, jump: int) -> list[Piece]:
    """A slice as a function of the head it starts from. A safe head never leaves the span
    of the heads observed before it, so no other starting heads are followed."""
    pieces: list[Piece] = [(lowest, False, 0)]
    for raw in raws:
        pieces = follow(pieces, raw, tolerance, jump, highest)
    return pieces


def value_of(pieces: list[Piece], start: int) -> int:
    _, fixed, value = pieces[bisect.bisect_right(pieces, start, key=lambda p: p[0]) - 1]
    return value if fixed else start + value


def with_safe_block(observations: DataFrame) -> StructType:
    return StructType([*observations.schema, StructField("safe_block", LongType())])


def safe_head(
    observations: DataFrame, tolerance: int = TOLERANCE, jump: int = JUMP, width: int | None = None,
    start: DataFrame | None = None,
) -> DataFrame:
    """Append ``safe_block`` to observations (chain, seq, raw_block, …), in slices of
    ``width`` sequence numbers. ``start`` (chain, safe_block) gives heads to go on from."""
    placed = observations.withColumn("_slice", ordered.by_span("seq", width or SLICE))
    spans = placed.groupBy("chain", "_slice").agg(F.min("raw_block").alias("low"), F.max("raw_block").alias("high"))
    known = observations.select("chain").distinct().withColumn("known", F.lit(None).cast("bigint"))
    if start is not None:
        known = known.drop("known").join(start.select("chain", F.col("safe_block").alias("known")), "chain", "left")
    before = Window.partitionBy("chain").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    # One row per chain and slice.
    bounds = spans.join(known, "chain").select(
        "chain", "_slice", "known",
        F.least(F.min("low").over(before), "known").alias("lowest"),
        F.greatest(F.max("high").over(before), "known").alias("highest"),
    )
    rows = placed.select("chain", "_slice", "seq", "raw_block").join(bounds, ["chain", "_slice"])

    def summary(pdf: pd.DataFrame) -> pd.DataFrame:
        raws = [int(r) for r in pdf.sort_values("seq")["raw_block"]]
        known, lowest = pdf["known"].iloc[0], pdf["lowest"].iloc[0]
        if pd.isna(lowest):
            # A chain's first slice, which nothing goes before.
            pieces = [(0, True, fold(raws, None, tolerance, jump)[-1])]
        else:
            pieces = summed_up(raws, int(lowest), int(pdf["highest"].iloc[0]), tolerance, jump)
        starts, fixed, amounts = map(list, zip(*pieces))
        return pd.DataFrame({
            "chain": [pdf["chain"].iloc[0]], "_slice": [pdf["_slice"].iloc[0]], "known": pd.array([known], dtype="Int64"),
            "starts": [starts], "fixed": [fixed], "amounts": [amounts],
        })

    summaries = rows.groupBy("chain", "_slice").applyInPandas(
        summary, "chain string, _slice bigint, known bigint, starts array<bigint>, fixed array<boolean>, amounts array<bigint>"
    )

    def chained(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_slice")
        safe = None if pd.isna(pdf["known"].iloc[0]) else int(pdf["known"].iloc[0])
        entry = []
        for row in pdf.itertuples():
            entry.append(safe)
            pieces = [(int(s), bool(f), int(a)) for s, f, a in zip(row.starts, row.fixed, row.amounts)]
            safe = pieces[0][2] if safe is None else value_of(pieces, safe)
        return pd.DataFrame({"chain": pdf["chain"], "_slice": pdf["_slice"], "entry": pd.array(entry, dtype="Int64")})

    entries = summaries.groupBy("chain").applyInPandas(chained, "chain string, _slice bigint, entry bigint")
    columns = observations.columns

    def part(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("seq")
        entry = pdf["entry"].iloc[0]
        safe = None if pd.isna(entry) else int(entry)
        return pdf[columns].assign(safe_block=fold((int(r) for r in pdf["raw_block"]), safe, tolerance, jump))

    return (
        placed.join(entries, ["chain", "_slice"]).groupBy("chain", "_slice").applyInPandas(part, with_safe_block(observations))
    )


def arbitrate(observations: DataFrame, fresh_seconds: int = FRESH_SECONDS) -> DataFrame:
    """The head to use at each observation: the pushed one while it is fresh, otherwise
    the last polled one."""
    pushed = F.col("source") == "ws"
    tagged = observations.select(
        "*",
        F.when(pushed, F.col("raw_block")).alias("_ws"),
        F.when(pushed, F.col("ts")).alias("_ws_at"),
        F.when(~pushed, F.col("raw_block")).alias("_http"),
    )
    last = ordered.running(
        tagged, ["chain"], ["seq"],
        {"ws_block": Running("last", "_ws"), "ws_at": Running("last", "_ws_at"),
         "http_block": Running("last", "_http")},
        ordered.by_span("seq"),
    )
    age = F.unix_micros("ts") - F.unix_micros("ws_at")
    fresh = F.coalesce(age <= fresh_seconds * 1_000_000, F.lit(False))
    return last.select(
        "chain", "seq",
        F.when(fresh, F.col("ws_block")).otherwise(F.col("http_block")).alias("candidate"),
        F.when(fresh, "ws").otherwise("http").alias("used_source"),
    )
