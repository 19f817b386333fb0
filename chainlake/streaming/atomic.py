"""Data and progress that become visible together.

Each micro-batch writes its rows under its batch id and then one progress record, last.
Readers take only batches that have a progress record. A repeated batch replaces its
folder, so replay changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chainlake.operators import state
from chainlake.streaming.jobs import for_each


def commit_batch(batch: DataFrame, batch_id: int, path: str, producer: dict[str, str]) -> None:
    """Write one batch, then its progress record with the highest block and row count."""
    batch.write.mode("overwrite").parquet(f"{path}/data/batch={batch_id}")
    written = batch.sparkSession.read.schema(batch.schema).parquet(f"{path}/data/batch={batch_id}")
    progress = written.agg(
        F.max("block_height").alias("top"), F.min("block_height").alias("low"),
        F.count(F.lit(1)).alias("rows"),
    )
    record = state.progress_record(
        F.col("top"), F.lit(producer["pod_uid"]), F.lit(producer["pod_name"]),
        F.lit(producer["run_id"]), F.lit(producer["mode"]), F.lit(producer["started_at"]), F.col("low"),
    )
    progress.select(
        F.lit(batch_id).cast("bigint").alias("batch_id"), "rows", F.to_json(record).alias("record"),
        F.current_timestamp().alias("committed_at"),
    ).coalesce(1).write.mode("overwrite").parquet(f"{path}/progress/commit={batch_id}")


def run(rows: DataFrame, path: str, checkpoint: str, producer: dict[str, str]) -> None:
    for_each(
        rows, lambda batch, batch_id: commit_batch(batch, batch_id, path, producer), checkpoint
    ).awaitTermination()


def commits(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/progress")


def committed_rows(spark: SparkSession, path: str) -> DataFrame:
    """Rows of committed batches. The batch column is a partition, so the join on the few
    committed ids prunes folders."""
    done = commits(spark, path).select(F.col("batch_id").alias("batch"))
    data = spark.read.parquet(f"{path}/data")
    return data.join(done, data["batch"] == done["batch"], "left_semi").drop("batch")
