"""The most frequent keys, counted exactly without shuffling all keys.

A first pass counts rows per cell of a count-min table, whose size is fixed and whose counts
add up, so that tables of parts can be kept and merged. No key has more rows than any of its
cells. The keys of the fullest cells give a count that the wanted keys reach, and only keys
whose cells all reach it are grouped. The result is exact however the keys are spread: where
none stands out every key is grouped, as without the table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chainlake.session import durable

# Rows and cells in a row of the table. Cells bound what is broadcast: 65,536 numbers a row.
ROWS = 3
CELLS = 1 << 16


def cell(keys: list[str], row: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(row), *keys), F.lit(CELLS)).cast("int")


def counts(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The table (row, cell, n) of some rows, added up before the shuffle."""
    cells = F.posexplode(F.array(*[cell(keys, i) for i in range(ROWS)])).alias("row", "cell")
    return rows.select(cells).groupBy("row", "cell").agg(F.count(F.lit(1)).alias("n"))


def merged(tables: list[DataFrame]) -> DataFrame:
    """The table of all rows from the tables of parts that hold each row once."""
    return reduce(DataFrame.unionByName, tables).groupBy("row", "cell").agg(F.sum("n").alias("n"))


def most_frequent(rows: DataFrame, keys: list[str], k: int, table: DataFrame | None = None) -> DataFrame:
    """The ``k`` keys with most rows (keys, n); of equal counts the smaller keys, absent ones
    first. ``rows`` are read three times, or twice with a ``table`` of theirs."""
    table = durable(counts(rows, keys) if table is None else table)
    placed = rows.select(*keys, *[cell(keys, i).alias(f"_cell_{i}") for i in range(ROWS)])

    def top(some: DataFrame) -> DataFrame:
        found = some.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
        return found.orderBy(F.desc("n"), *keys).limit(k)

    fullest = table.where("row = 0").orderBy(F.desc("n"), "cell").limit(k).select(F.col("cell").alias("_cell_0"))
    some = top(placed.join(F.broadcast(fullest), "_cell_0", "left_semi"))
    # Fewer keys than wanted tell nothing about the last of them.
    reached = some.agg(F.when(F.count(F.lit(1)) >= k, F.min("n")).otherwise(0).alias("n"))
    full = table.where(F.col("n") >= reached.scalar())
    for i in range(ROWS):
        cells = full.where(F.col("row") == i).select(F.col("cell").alias(f"_cell_{i}"))
        placed = placed.join(F.broadcast(cells), f"_cell_{i}", "left_semi")
    return top(placed)
