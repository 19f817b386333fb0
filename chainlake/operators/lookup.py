"""Joins of the time axis: block at a time, date ranges, facts with their block."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chainlake.operators import ordered
from chainlake.operators.ordered import Running


def block_at_time(lookups: DataFrame, blocks: DataFrame) -> DataFrame:
    """For lookups (chain, lookup_id, at) the last block not after and the first not before.

    Blocks and lookups are merged in time order and each lookup takes the value running up
    to it, so no pairs are formed. Among blocks of one time the higher (before) or lower
    (after) number is taken.
    """
    none = F.lit(None).cast("bigint")
    axis = blocks.select(
        "chain", none.alias("lookup_id"), F.col("block_ts").alias("at"), F.lit(0).alias("is_lookup"),
        F.col("block_number").alias("n"), (-F.col("block_number")).alias("minus_n"),
    )
    asked = lookups.select(
        "chain", "lookup_id", "at", F.lit(1).alias("is_lookup"), none.alias("n"), none.alias("minus_n")
    )
    merged = axis.unionByName(asked)
    tie = [F.col("is_lookup"), F.coalesce("n", "lookup_id")]
    day = ordered.by_day("at")
    up = ordered.running(merged, ["chain"], [F.col("at"), *tie], {"before": Running("max", "n")}, day)
    both = ordered.running(up, ["chain"], [F.col("at").desc(), *tie], {"after": Running("max", "minus_n")}, -day)
    return both.where("is_lookup = 1").select(
        "chain", "lookup_id", "at",
        F.col("before").alias("block_before"), (-F.col("after")).alias("block_after"),
    )


def date_to_blocks(
    requests: DataFrame, blocks: DataFrame, midnight_belongs_to_both: bool = False
) -> DataFrame:
    """Block range of each requested span of days (start_date, end_date), end included.

    Blocks are reduced to one row per day before they are joined. With
    ``midnight_belongs_to_both`` a block exactly on the following midnight still counts.
    """
    day = F.to_date("block_ts")
    days = blocks.groupBy(day.alias("day")).agg(
        F.min("block_number").alias("lo"),
        F.max("block_number").alias("hi"),
        F.max(F.when(F.col("block_ts") == day.cast("timestamp"), F.col("block_number"))).alias("midnight"),
    )
    if midnight_belongs_to_both:
        last = F.date_add("end_date", 1)
        is_next = F.col("day") > F.col("end_date")
        high = F.max(F.when(is_next, F.col("midnight")).otherwise(F.col("hi")))
        low = F.min(F.when(~is_next, F.col("lo")))
    else:
        last, high, low = F.col("end_date"), F.max("hi"), F.min("lo")
    spans = requests.distinct().withColumn(
        "day", F.explode_outer(F.when(F.col("start_date") <= F.col("end_date"),
                                      F.sequence(F.col("start_date"), last)))
    )
    found = (
        spans.join(days, "day", "left")
        .groupBy("start_date", "end_date")
        .agg(low.alias("start_block"), high.alias("end_block"))
    )
    return found.withColumn(
        "valid", F.coalesce(F.col("start_block") <= F.col("end_block"), F.lit(False))
    )


def enrich(logs: DataFrame, txs: DataFrame, blocks: DataFrame) -> DataFrame:
    """Facts with their intent and time: logs (transaction_hash, log_index, …), transactions
    (tx_hash, block_number, …), blocks (block_number, block_ts). Transactions without logs
    stay, with NULL log columns. Adaptive execution broadcasts what it measures to be small
    and splits skewed blocks; the logs of one transaction are bounded by the chain."""
    timed = txs.join(blocks, "block_number", "left")
    return timed.join(logs.withColumnRenamed("transaction_hash", "tx_hash"), "tx_hash", "left")
