"""The jobs end to end: topic to bronze, bronze to silver, progress to state table.

Sources are DataFrames with the Kafka source columns (``sources.topics``); tables are
folders of Parquet files. Where a catalog with row-level commands is at hand,
``operators.state.merge_into`` and ``operators.layout.delete_from`` take the place of the
portable forms used here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from chainlake.functions import schemas
from chainlake.operators import bronze, layout, quality, silver, state
from chainlake.sources import topics
from chainlake.streaming import jobs


# ---- topic to bronze ----------------------------------------------------------------


def bronze_transactions(source: DataFrame, path: str, checkpoint: str, realtime: bool = False,
                        schema: str = schemas.RAW_RECORD, fmt: str = "json") -> StreamingQuery:
    """Backfill takes what there is and stops; realtime goes on from the same checkpoint."""
    rows = bronze.bronze_tx(topics.decode_records(source, schema, fmt))
    every = jobs.REALTIME_TRIGGER if realtime else None
    return jobs.start(rows, path, checkpoint, every=every, partition_by=["kafka_date"])


def bronze_logs(source: DataFrame, path: str, checkpoint: str, realtime: bool = False,
                schema: str = schemas.RAW_RECORD_DATED, fmt: str = "json") -> StreamingQuery:
    rows = bronze.bronze_logs(topics.decode_records(source, schema, fmt))
    every = jobs.REALTIME_TRIGGER if realtime else None
    return jobs.start(rows, path, checkpoint, every=every, partition_by=["inserted_date"])


# ---- bronze to silver ---------------------------------------------------------------


def silver_transactions(bronze_rows: DataFrame, path: str) -> int:
    """Append the transactions above the silver marks; returns how many. The count is
    observed during the write, so nothing is computed twice. It is taken above the
    rebalancing, as stages without rows are cut from the plan."""
    spark = bronze_rows.sparkSession
    stored = layout.read_table(spark, path, silver.enriched_tx(bronze_rows.limit(0)).schema)
    fresh = state.increment(bronze_rows, stored)
    seen = Observation("increment")
    rows = silver.enriched_tx(fresh).hint("rebalance", "kafka_date")
    counted = rows.observe(seen, F.count(F.lit(1)).alias("rows"))
    counted.write.mode("append").partitionBy("kafka_date").parquet(path)
    return seen.get["rows"]


LOG_KEY = ["block_hash", "transaction_hash", "log_index"]


def silver_logs(source: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Logs as a stream, each stored once: a batch leaves out what is stored already, and
    reading the table needs no further step."""
    rows = silver.silver_logs(topics.decode_records(source, schemas.RAW_RECORD_DATED))
    return jobs.append_new(rows, path, checkpoint, LOG_KEY, "inserted_at", "block_number")


# ---- progress to state --------------------------------------------------------------


def progress_state(source: DataFrame, current: str | None, new: str) -> DataFrame:
    """Merge the latest record of each key into the state table at ``current`` and write the
    result to the folder ``new``; the caller names it the table from then on. Catalogs with
    row-level commands use ``state.merge_into``."""
    spark = source.sparkSession
    updates = state.latest_value(state.flatten_state(topics.decode_records(source, schemas.PROGRESS_RECORD)))
    merged = state.merge_upsert(layout.read_table(spark, current, updates.schema), updates) if current else updates
    merged.write.parquet(new)
    return spark.read.schema(updates.schema).parquet(new)
