"""Ordered operators (row number, running values, previous row) that survive hot keys.

A window partitioned by a key sends the whole key to one task. Where the data model does
not bound a key, the caller names slices of the order: a day, a block bucket, a span of
sequence numbers. Each slice of a key is a window of its own; its last row is handed to
the next slices, and every row takes up what the slices before its own hand on. The plan
is the same for any number of rows, and nothing runs before the query does.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Sequence numbers in one slice.
SLICE = 100_000


# Kinds whose value over a whole slice does not depend on its order.
UNORDERED = {"count", "sum", "max", "max_before"}


@dataclass(frozen=True)
class Running:
    """A value computed over the rows of a key up to the current one.

    ``kind``: ``count`` | ``sum`` | ``max`` | ``last`` (latest non-null); without the
    current row: ``max_before`` | ``lag`` (the previous row's value).
    """

    kind: str
    value: str | None = None

    def over(self, rows) -> Column:
        match self.kind:
            case "max_before":
                return F.max(self.value).over(rows.rowsBetween(Window.unboundedPreceding, -1))
            case "lag":
                return F.lag(self.value).over(rows)
        return self.upto(rows)

    def upto(self, rows) -> Column:
        """The value with the current row; at a slice's last row, what the slice hands on."""
        up_to_here = rows.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        match self.kind:
            case "count":
                return F.row_number().over(rows).cast("bigint")
            case "sum":
                return F.sum(self.value).over(up_to_here)
            case "max" | "max_before":
                return F.max(self.value).over(up_to_here)
            case "last":
                return F.last(self.value, ignorenulls=True).over(up_to_here)
            case "lag":
                return F.col(self.value)
        raise ValueError(self.kind)

    def whole(self) -> Column:
        """What a slice hands on, by grouping."""
        match self.kind:
            case "count":
                return F.count(F.lit(1))
            case "sum":
                return F.sum(self.value)
            case "max" | "max_before":
                return F.max(self.value)
        raise ValueError(self.kind)

    def carry(self, column: str, slices) -> Column:
        """What all earlier slices of the key hand on."""
        before = slices.rowsBetween(Window.unboundedPreceding, -1)
        match self.kind:
            case "count" | "sum":
                return F.sum(column).over(before)
            case "max" | "max_before":
                return F.max(column).over(before)
            case "last":
                return F.last(column, ignorenulls=True).over(before)
            case "lag":
                return F.lag(column).over(slices)
        raise ValueError(self.kind)

    def join_up(self, local: Column, carried: Column) -> Column:
        match self.kind:
            case "count" | "sum":
                return F.when(carried.isNull(), local).otherwise(
                    carried + F.coalesce(local, F.lit(0))
                )
            case "max" | "max_before":
                return F.greatest(local, carried)
            case "last":
                return F.coalesce(local, carried)
            case "lag":
                # Only a slice's first row lacks a predecessor in it.
                return F.when(F.col("_first"), carried).otherwise(local)
        raise ValueError(self.kind)


def running(
    df: DataFrame, keys: list[str], order: list, values: dict[str, Running], slices: Column | None = None
) -> DataFrame:
    """Append running values per key in the given order. ``slices`` must not fall as the
    order goes on; without it, a key must be bounded by nature."""
    if slices is None:
        rows = Window.partitionBy(*keys).orderBy(*order)
        return df.select("*", *[v.over(rows).alias(n) for n, v in values.items()])
    # As fields of a struct, absent keys equal each other and need no test of their own.
    placed = df.withColumn("_at", F.struct(*keys, slices.alias("_slice")))
    rows = Window.partitionBy("_at").orderBy(*order)
    local = placed.select(
        "*",
        (F.row_number().over(rows) == 1).alias("_first"),
        F.lead(F.lit(True)).over(rows).isNull().alias("_end"),
        *[v.over(rows).alias(f"_local_{n}") for n, v in values.items()],
        *[v.upto(rows).alias(f"_upto_{n}") for n, v in values.items()],
    )
    if all(v.kind in UNORDERED for v in values.values()):
        # Summed up before the shuffle, without the other columns and unsorted.
        ends = placed.groupBy("_at").agg(*[v.whole().alias(f"_upto_{n}") for n, v in values.items()])
    else:
        ends = local.where("_end")
    following = Window.partitionBy(*[F.col(f"_at.`{k}`") for k in keys]).orderBy("_at._slice")
    # One row per key and slice.
    carried = ends.select(
        F.col("_at").alias("_to"), *[v.carry(f"_upto_{n}", following).alias(f"_carry_{n}") for n, v in values.items()]
    )
    joined = local.join(carried, F.col("_at") == F.col("_to"), "left")
    return joined.select(
        *[F.col(f"`{c}`") for c in df.columns],
        *[v.join_up(F.col(f"_local_{n}"), F.col(f"_carry_{n}")).alias(n) for n, v in values.items()],
    )


def by_day(ts: str) -> Column:
    """Slices of a day, in the order of a timestamp."""
    return F.unix_date(F.to_date(ts))


def by_span(number: str, width: int | None = None) -> Column:
    """Slices of so many consecutive numbers."""
    return F.floor(F.col(number) / F.lit(width or SLICE)).cast("bigint")


def row_number(
    df: DataFrame, keys: list[str], order: list, name: str = "rn", slices: Column | None = None
) -> DataFrame:
    return running(df, keys, order, {name: Running("count")}, slices)


def lag(
    df: DataFrame, keys: list[str], order: list, values: dict[str, str], slices: Column | None = None
) -> DataFrame:
    """Append the previous row's values: ``{new column: source column}``."""
    return running(df, keys, order, {n: Running("lag", c) for n, c in values.items()}, slices)


def first_n(df: DataFrame, keys: list[str], order: list, n: int) -> DataFrame:
    """The first ``n`` rows of each key. Spark keeps only ``n`` rows per key and task
    before the shuffle, so a hot key does not matter."""
    rows = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(rows)).where(F.col("_rn") <= n).drop("_rn")


def latest(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The row with the highest ``order`` of each key."""
    return first_n(df, keys, [F.col(order).desc()], 1)
