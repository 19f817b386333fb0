"""Competing branches of a chain: which one holds, where the others left it, what they orphan.

Only heights with several different blocks are in dispute, and the blocks right above them; blocks
of other heights are told apart from these by counting and never grouped or stored. Every disputed
block is known by its height and its place there (``k``) and keeps a pointer along ``parent_hash``;
in each round a pointer takes over the pointer of the block it points to, so it reaches twice as
far. The rounds grow with the logarithm of the longest dispute, not with the chain, and move
numbers only: hashes are joined once before and once after them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chainlake.session import scratch


def stored(df: DataFrame) -> DataFrame:
    """The rows written to the shared folder and read back. Rounds read their rows several times;
    a checkpoint would serialize each row as an object of its own."""
    path = scratch(df.sparkSession, "forks")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def near_dispute(blocks: DataFrame) -> DataFrame:
    """Deliveries at heights with several, and at the heights next to these. Others have no part in a
    fork: a disputed block lies at such a height or one above, its parent one below."""
    rows = blocks.select("chain", "number", "hash", "parent_hash", "kafka_offset").where("number is not null and hash is not null")
    several = rows.groupBy("chain", "number").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    below, above = F.try_subtract("number", F.lit(1)), F.try_add("number", F.lit(1))
    heights = several.select("chain", F.explode(F.array(below, "number", above)).alias("number")).distinct()
    return rows.join(heights, ["chain", "number"], "left_semi")


def known_blocks(blocks: DataFrame) -> DataFrame:
    """Different blocks, each with the parent of its latest delivery. Rows without a height or
    hash are no blocks."""
    return (
        blocks.where("number is not null and hash is not null").groupBy("chain", "number", "hash")
        .agg(F.max_by("parent_hash", "kafka_offset").alias("parent_hash"), F.max("kafka_offset").alias("seen"))
    )


def disputed(known: DataFrame) -> DataFrame:
    """Blocks at heights with several, and the blocks one above such a height: ``k`` numbers the blocks
    of a height by hash from 1, ``up`` is the ``k`` of the parent one height below. Parents that
    are not disputed have numbers below 0; ``parent_known`` tells whether they were delivered."""
    height = Window.partitionBy("chain", "number")
    placed = stored(known.withColumns({
        "k": F.row_number().over(height.orderBy("hash")), "n": F.count(F.lit(1)).over(height),
        "p": F.dense_rank().over(height.orderBy("parent_hash"))}))
    several = placed.where("n > 1 and k = 1").select("chain", F.explode(F.array("number", F.col("number") + 1)).alias("number")).distinct()
    nodes = placed.join(several.withColumn("_disputed", F.lit(True)), ["chain", "number"], "left")
    nodes = stored(nodes.withColumn("_disputed", F.coalesce("_disputed", F.lit(False))))
    parents = nodes.select(
        F.col("chain"), (F.col("number") + 1).alias("number"), F.col("hash").alias("parent_hash"),
        F.col("k").alias("_k"), F.col("_disputed").alias("_parent_disputed"))
    return nodes.where("_disputed").join(parents, ["chain", "number", "parent_hash"], "left").select(
        "chain", "number", "hash", "parent_hash", "seen", "k",
        F.when(F.col("_parent_disputed"), F.col("_k")).otherwise(-F.col("p")).alias("up"), F.col("_k").isNotNull().alias("parent_known"))


def doubled(nodes: DataFrame, carried: tuple[str, ...]) -> DataFrame:
    """One round of pointer jumping on ``chain, number, k, up, dist`` (``up`` is the ``k`` of the
    ancestor ``dist`` blocks below): pointers to a node become that node's pointers, which ``moved``
    tells. ``carried`` columns are taken over from the node pointed to."""
    there = nodes.select(
        F.col("chain").alias("_chain"), F.col("number").alias("_number"), F.col("k").alias("_k"), F.col("up").alias("_up"), F.col("dist").alias("_dist"),
        *[F.col(c).alias(f"_{c}") for c in carried],
    )
    on = (F.col("chain") == F.col("_chain")) & (F.col("number") - F.col("dist") == F.col("_number")) & (F.col("up") == F.col("_k"))
    moved = F.col("_k").isNotNull()
    return nodes.join(there, on, "left").select(
        *[c for c in nodes.columns if c not in ("up", "dist", *carried)],
        F.when(moved, F.col("_up")).otherwise(F.col("up")).alias("up"),
        (F.col("dist") + F.coalesce("_dist", F.lit(0))).alias("dist"),
        *[F.coalesce(f"_{c}", c).alias(c) for c in carried], moved.alias("moved"),
    )


def to_the_root(nodes: DataFrame, carried: tuple[str, ...] = (), gather: str | None = None) -> DataFrame:
    """Jump until every pointer leaves the given nodes. ``carried`` columns end as those of the
    last node on the way; ``gather`` becomes the largest among a node and all that lead to it."""
    now = stored(nodes)
    while True:
        ahead = doubled(now, carried)
        if gather:
            gained = now.where("up > 0").groupBy("chain", (F.col("number") - F.col("dist")).alias("number"), F.col("up").alias("k")).agg(
                F.max(gather).alias("_gained"))
            ahead = ahead.join(gained, ["chain", "number", "k"], "left").withColumn(
                gather, F.greatest(F.col(gather), F.coalesce("_gained", gather))).drop("_gained")
        ahead = stored(ahead)
        if ahead.where("moved").isEmpty():
            return ahead.drop("moved")
        now = ahead.drop("moved")


def forks(blocks: DataFrame) -> DataFrame:
    """Abandoned branches among ``blocks`` (chain, number, hash, parent_hash, kafka_offset).

    Of competing branches the one with the highest block holds, of equals the one whose tip
    was delivered last. Per branch that left the holding one: ``first_hash`` (its first block),
    ``ancestor_number`` and ``ancestor_hash`` (the last common block, to which to roll back),
    ``ancestor_known`` (false where that block was never delivered), ``depth`` (how far its
    highest block lies above the ancestor), ``orphans`` (number of its blocks, those of
    branches that left it in turn included) and ``orphaned`` (their hashes by height).
    """
    nodes = stored(disputed(known_blocks(near_dispute(blocks))))
    first_step = F.lit(1).cast("long").alias("dist")
    # Within a height ``k`` orders as the hash does.
    rooted = to_the_root(nodes.select("chain", "number", "k", "up", first_step, F.struct("number", "seen", "k").alias("best")), gather="best")
    rooted = rooted.withColumn("root_number", F.col("number") - F.col("dist"))
    tree = ["chain", "root_number", "up"]
    tops = rooted.groupBy(*tree).agg(F.max("best").alias("top"))
    lost = rooted.join(tops, tree).where("best <> top").select("chain", "number", "k")
    lost = lost.join(nodes.select("chain", "number", "k", "up"), ["chain", "number", "k"])
    ends = to_the_root(lost.select("chain", "number", "k", "up", first_step, F.col("k").alias("first")), carried=("first",))
    ends = ends.select("chain", "number", "k", "first", (F.col("number") - F.col("dist")).alias("ancestor_number"))
    made = ends.join(nodes.select("chain", "number", "k", "hash"), ["chain", "number", "k"]).groupBy("chain", "first", "ancestor_number").agg(
        (F.max("number") - F.col("ancestor_number")).alias("depth"), F.count(F.lit(1)).alias("orphans"),
        F.array_sort(F.collect_list(F.struct("number", "hash")))["hash"].alias("orphaned"))
    firsts = nodes.select(
        "chain", F.col("k").alias("first"), (F.col("number") - 1).alias("ancestor_number"), F.col("hash").alias("first_hash"),
        F.col("parent_hash").alias("ancestor_hash"), F.col("parent_known").alias("ancestor_known"))
    return made.join(firsts, ["chain", "first", "ancestor_number"]).select(
        "chain", "first_hash", "ancestor_number", "ancestor_hash", "ancestor_known", "depth", "orphans", "orphaned")
