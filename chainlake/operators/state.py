"""Progress state: latest records, upserts, high-water marks, resume decisions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chainlake.functions import columns as C
from chainlake.operators import ordered

STATE_KEYS = ["kafka_key", "run_id"]


def flatten_state(records: DataFrame) -> DataFrame:
    """Nested progress records to flat rows."""
    return records.select(
        F.col("checkpoint").alias("checkpoint_block"),
        F.col("producer.pod_name").alias("producer_pod_name"),
        F.col("producer.pod_uid").alias("producer_pod_uid"),
        F.col("run.run_id").alias("run_id"),
        F.col("run.mode").alias("run_mode"),
        F.col("run.start_block").alias("run_start_block"),
        C.iso_ts(F.col("run.started_at")).alias("run_started_at"),
        "kafka_key", "kafka_topic", "kafka_partition", "kafka_offset", "kafka_timestamp",
        F.to_date("kafka_timestamp").alias("kafka_date"),
        F.current_timestamp().alias("state_updated_at"),
    )


def progress_record(
    checkpoint: Column, pod_uid: Column, pod_name: Column, run_id: Column, mode: Column,
    started_at: Column, start_block: Column,
) -> Column:
    """The value of one progress record."""
    return F.struct(
        checkpoint.alias("checkpoint"),
        F.struct(pod_uid.alias("pod_uid"), pod_name.alias("pod_name")).alias("producer"),
        F.struct(
            run_id.alias("run_id"), mode.alias("mode"), started_at.alias("started_at"),
            start_block.alias("start_block"),
        ).alias("run"),
    )


def latest_value(changelog: DataFrame, key: str = "kafka_key", order: str = "kafka_offset") -> DataFrame:
    """The last value of each key of a compacted topic."""
    rest = [c for c in changelog.columns if c != key]
    return (
        changelog.groupBy(key)
        .agg(F.max_by(F.struct(*rest), order).alias("last"))
        .select(key, "last.*")
    )


def ranked_history(state: DataFrame) -> DataFrame:
    """All runs of each key, newest first, with their rank."""
    newest = [F.col("checkpoint_block").desc(), F.col("kafka_timestamp").desc(), F.col("run_id").desc()]
    # Highest block bucket first; runs without a checkpoint come last, as in the order.
    bucket = F.coalesce(-C.block_bucket(F.col("checkpoint_block")), F.lit(2**62))
    ranked = ordered.row_number(state, ["kafka_key"], newest, slices=bucket)
    key = C.split_state_key(F.col("kafka_key"))
    return ranked.select(
        key["chain"].alias("chain"),
        key["entity"].alias("ingestion_entity"),
        key["type"].alias("ingestion_type"),
        "run_mode",
        F.col("run_start_block").alias("run_start"),
        F.col("checkpoint_block").alias("run_end"),
        "producer_pod_name", "run_id", "kafka_timestamp", "kafka_key", "rn",
    )


def latest_run(state: DataFrame) -> DataFrame:
    newest = [F.col("checkpoint_block").desc(), F.col("kafka_timestamp").desc(), F.col("run_id").desc()]
    return ordered.first_n(state, ["kafka_key"], newest, 1)


# ---- upsert -------------------------------------------------------------------------


def merge_upsert(
    target: DataFrame, updates: DataFrame, keys: list[str] = STATE_KEYS, order: str = "kafka_offset"
) -> DataFrame:
    """The target after updating matched rows and inserting the others: the newest row of
    each key wins. Works on any table; the caller writes the result."""
    return ordered.latest(target.unionByName(updates), keys, order)


def merge_into(spark: SparkSession, table: str, updates: DataFrame, keys: list[str] = STATE_KEYS):
    """The same as a MERGE, for catalogs with row-level commands."""
    updates.createOrReplaceTempView("state_updates")
    same = " and ".join(f"t.{k} = s.{k}" for k in keys)
    sets = ", ".join(f"t.{c} = s.{c}" for c in updates.columns if c not in keys)
    return spark.sql(
        f"merge into {table} t using state_updates s on {same} "
        f"when matched then update set {sets} when not matched then insert *"
    )


def fenced_updates(owners: DataFrame, updates: DataFrame, key: str = "kafka_key") -> DataFrame:
    """Label updates by whether their producer owns the key. A key nobody owns is free."""
    held = owners.select(key, F.col("producer_pod_uid").alias("owner_uid"))
    mine = F.col("owner_uid").isNull() | (F.col("owner_uid") == F.col("producer_pod_uid"))
    return updates.join(held, key, "left").withColumn("accepted", mine)


# ---- increments ---------------------------------------------------------------------


def max_offset(table: DataFrame) -> DataFrame:
    return table.agg(F.coalesce(F.max("kafka_offset"), F.lit(-1).cast("bigint")).alias("max_offset"))


def history_below(table: DataFrame, live: DataFrame) -> DataFrame:
    """Rows below the first live block, for loading history once beside a running stream."""
    first = live.agg(F.min("block_height"))
    return table.where(F.col("block_height") < first.scalar())


def live_with_history(table: DataFrame, job: str) -> DataFrame:
    """Rows of the live job and all rows below its first block, in one scan: history is
    loaded once beside a running stream."""
    live = F.coalesce(F.col("job_name") == job, F.lit(False))
    first = table.where(live).agg(F.min("block_height"))
    return table.where(live | (F.col("block_height") < first.scalar()))


def marks(table: DataFrame) -> DataFrame:
    """High-water mark of each topic partition."""
    return table.groupBy("kafka_topic", "kafka_partition").agg(
        F.max("kafka_offset").alias("mark")
    )


def increment(bronze: DataFrame, silver: DataFrame) -> DataFrame:
    """Bronze rows above the silver mark of their own partition."""
    return (
        bronze.join(marks(silver), ["kafka_topic", "kafka_partition"], "left")
        .where("kafka_offset > coalesce(mark, -1)")
        .drop("mark")
        .select(*bronze.columns)
    )


# ---- resume decisions ---------------------------------------------------------------


def resume_plan(latest: DataFrame, heads: DataFrame, from_checkpoint: bool = True) -> DataFrame:
    """Start after the checkpoint when there is one, otherwise at the chain head.

    ``latest``: (job, checkpoint); ``heads``: (job, latest_block).
    """
    known = F.lit(from_checkpoint) & F.col("checkpoint").isNotNull()
    return heads.join(latest, "job", "left").select(
        "job",
        F.when(known, F.col("checkpoint") + 1).otherwise(F.col("latest_block")).alias("start_block"),
        F.when(known, "checkpoint").otherwise("chain_head").alias("resume_mode"),
        # The older rule re-reads the checkpoint block, or the block before the head.
        F.coalesce("checkpoint", F.col("latest_block") - 1).alias("overlap_start"),
    )


def backfill_status(jobs: DataFrame, latest: DataFrame) -> DataFrame:
    """What a restarted backfill should do.

    ``jobs``: (job_name, start_block); ``latest``: (job_name, status, checkpoint, range_end).
    """
    done = F.col("status") == "completed"
    past = F.col("checkpoint") >= F.col("range_end")
    return jobs.join(latest, "job_name", "left").select(
        "job_name",
        F.when(done, "completed")
        .when(past, "inconsistent")
        .when(F.col("checkpoint").isNotNull(), "resume")
        .otherwise("new")
        .alias("decision"),
        F.when(done | past, None)
        .when(F.col("checkpoint").isNotNull(), F.col("checkpoint") + 1)
        .otherwise(F.col("start_block"))
        .alias("next_block"),
    )


def backfill_bounds(state: DataFrame) -> DataFrame:
    """A backfill ends one block before the chain head its realtime job started at, and
    resumes after its own checkpoint."""
    key = C.split_state_key(F.col("kafka_key"))
    last = latest_value(state).select(
        key["chain"].alias("chain"), key["entity"].alias("entity"), key["type"].alias("type"),
        "run_start_block", "checkpoint_block",
    )
    live = last.where("type = 'realtime'").groupBy("chain", "entity").agg(
        F.max("run_start_block").alias("head_at_start")
    )
    back = last.where("type = 'backfill'").groupBy("chain", "entity").agg(
        F.max("checkpoint_block").alias("completed_until")
    )
    return live.join(back, ["chain", "entity"], "left").select(
        "chain", "entity",
        (F.coalesce("completed_until", F.lit(-1)) + 1).alias("backfill_start"),
        (F.col("head_at_start") - 1).alias("backfill_end"),
    )
