"""Checks and repairs: gaps, duplicates, reorganisations, missing or repeated rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chainlake.functions import columns as C
from chainlake.operators import ordered

LEAST_BUCKET = -(1 << 63)


def gaps(heights: DataFrame) -> DataFrame:
    """Missing spans per chain in rows (chain, height).

    Every height announces its successor, and one grouping leaves just the borders of the
    runs of present heights: the first missing height after a run, and the first height
    of the next. Only these few rows are ordered.
    """
    marks = heights.select(
        "chain",
        F.explode(
            F.array(
                F.struct(F.col("height").alias("h"), F.lit(1).alias("has")),
                F.struct((F.col("height") + 1).alias("h"), F.lit(0).alias("has")),
            )
        ).alias("m"),
    )
    borders = (
        marks.groupBy("chain", "m.h")
        .agg(F.max("m.has").alias("has"), F.min("m.has").alias("told"))
        # Present and announced heights lie inside a run.
        .where("has = told")
    )
    paired = ordered.lag(
        borders, ["chain"], ["h"], {"gap_start": "h", "before": "has"}, ordered.by_span("h", C.BLOCKS_PER_BUCKET)
    )
    return paired.where("has = 1 and before = 0").select(
        "chain", "gap_start", (F.col("h") - 1).alias("gap_end"),
        (F.col("h") - F.col("gap_start")).alias("missing"),
    )


def duplicates(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def reorgs(blocks: DataFrame) -> DataFrame:
    """Blocks (chain, number, hash, parent_hash, kafka_offset) whose parent hash is not
    the hash of the block below. Of several deliveries of a height the latest counts."""
    canonical = ordered.latest(blocks, ["chain", "number"], "kafka_offset")
    links = canonical.select(
        "chain",
        F.explode(
            F.array(
                F.struct(F.col("number").alias("n"), "hash", "parent_hash",
                         F.lit(None).cast("string").alias("below")),
                F.struct((F.col("number") + 1).alias("n"), F.lit(None).cast("string").alias("hash"),
                         F.lit(None).cast("string").alias("parent_hash"), F.col("hash").alias("below")),
            )
        ).alias("m"),
    )
    return (
        links.groupBy("chain", F.col("m.n").alias("number"))
        .agg(F.max("m.hash").alias("hash"), F.max("m.parent_hash").alias("parent_hash"),
             F.max("m.below").alias("expected_parent"))
        .where("parent_hash <> expected_parent")
        .withColumn("rollback_to", F.col("number") - 1)
    )


def dedup(rows: DataFrame, keys: list[str], order: str = "kafka_offset") -> DataFrame:
    """The first delivery of each key."""
    return ordered.first_n(rows, keys, [order], 1)


def missing_rows(wanted: DataFrame, present: DataFrame, keys: list[str]) -> DataFrame:
    """Keys of ``wanted`` without a row in ``present``, once each. One grouping of both sides needs no
    join of two deduplicated ones. As in a join, absent keys equal none."""
    marked = wanted.select(*keys, F.lit(True).alias("_wanted")).unionByName(present.select(*keys, F.lit(False).alias("_wanted")))
    told = marked.groupBy(*keys).agg(F.bool_and("_wanted").alias("_missing"), F.bool_or("_wanted").alias("_wanted"))
    absent = F.exists(F.array(*[F.col(f"`{k}`").isNull() for k in keys]), lambda a: a)
    return told.where(F.col("_wanted") & (F.col("_missing") | absent)).select(*keys)


def in_touched_buckets(stored: DataFrame, incoming: DataFrame, bucket: str) -> DataFrame:
    """Stored rows of the buckets that incoming rows lie in. The buckets are broadcast; a
    chain has as many as its height over a bucket's width. Spark prunes folders at run time
    only by a side that is filtered, hence a filter that any number passes."""
    touched = incoming.where(F.col(bucket) >= LEAST_BUCKET).select(bucket).distinct()
    return stored.join(F.broadcast(touched), bucket, "left_semi")


def not_yet_stored(incoming: DataFrame, stored: DataFrame, keys: list[str], bucket: str | None = None) -> DataFrame:
    """Rows of a replay that are not stored. Rows are told apart by their keys, so that a
    replayed range adds nothing twice. ``bucket`` is a column that follows from the keys and
    partitions the stored table: only the folders that the replay touches are read."""
    if bucket:
        stored = in_touched_buckets(stored, incoming, bucket)
    return dedup(incoming, keys).join(stored.select(*keys).distinct(), keys, "left_anti")


def empty_blocks(blocks: DataFrame, txs: DataFrame, logs: DataFrame) -> DataFrame:
    """Whether a block without logs may be one: it must have no transactions either.

    One grouping counts all three sides, as a join of counts would order each of them, and look for absent
    numbers by computing every number twice. A block given more than once has a row each time, as has one
    without a number, which nothing belongs to.
    """
    names = ["n_blocks", "n_tx", "n_logs"]

    def marked(rows: DataFrame, name: str) -> DataFrame:
        return rows.select("block_number", *[F.lit(int(n == name)).cast("bigint").alias(n) for n in names])

    numbered = marked(blocks.where("block_number is not null"), "n_blocks")
    counted = numbered.unionByName(marked(txs, "n_tx")).unionByName(marked(logs, "n_logs"))
    counted = counted.groupBy("block_number").agg(*[F.sum(n).alias(n) for n in names]).where("n_blocks > 0")
    copies = F.explode(F.array_repeat(F.lit(0), F.col("n_blocks").cast("int"))).alias("copy")
    unnumbered = blocks.where("block_number is null").select(
        "block_number", *[F.lit(0).cast("bigint").alias(n) for n in ("n_tx", "n_logs")])
    return counted.select("block_number", "n_tx", "n_logs", copies).drop("copy").unionByName(unnumbered).withColumn(
        "status",
        F.when(F.col("n_logs") > 0, "has_logs").when(F.col("n_tx") == 0, "empty_ok").otherwise("suspect"),
    )
