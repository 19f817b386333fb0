"""Bronze tables: decoded records with their Kafka coordinates, raw payload kept."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chainlake.functions import columns as C
from chainlake.functions import schemas
from chainlake.operators import ordered, silver

TX_COLUMNS = [
    "block_height", "job_name", "run_id", "raw",
    "kafka_topic", "kafka_partition", "kafka_offset", "kafka_timestamp", "kafka_date",
]


def record_key(block: Column, index: Column) -> Column:
    return F.concat_ws("-", block.cast("string"), index.cast("string"))


def bronze_tx(records: DataFrame) -> DataFrame:
    return records.withColumn("kafka_date", F.to_date("kafka_timestamp")).select(*TX_COLUMNS)


def bronze_logs(records: DataFrame) -> DataFrame:
    at = C.iso_ts(F.col("inserted_at"))
    return records.select(
        "block_height", "job_name", "run_id",
        at.alias("inserted_at"), F.to_date(at).alias("inserted_date"),
        "raw", "kafka_topic", "kafka_partition", "kafka_offset", "kafka_timestamp",
    )


def raw_topic_copy(records: DataFrame) -> DataFrame:
    return records.select(
        "block_height", "job_name", "run_id", "raw", "kafka_topic", "kafka_partition",
        "kafka_offset", "kafka_timestamp", F.to_date("kafka_timestamp").alias("kafka_date"),
    )


def split_header(payloads: DataFrame) -> DataFrame:
    """The block without its transactions. ``None`` members are dropped by ``to_json``."""
    header = F.from_json("payload", schemas.struct(schemas.BLOCK_JSON))
    return payloads.select(
        "block_height",
        F.col("block_height").cast("string").alias("key"),
        F.to_json(header).alias("raw"),
    )


def split_transactions(payloads: DataFrame) -> DataFrame:
    """One record per transaction of a block, in order, with the block's hash set. Each
    transaction keeps its own JSON text, so number and list members stay as they are."""
    block = F.from_json("payload", "hash string, transactions array<string>")
    items = payloads.select("block_height", block.alias("b")).select(
        "block_height", F.col("b.hash").alias("h"), F.posexplode("b.transactions")
    )
    others = F.regexp_replace("col", r'"blockHash"\s*:\s*(?:"[^"]*"|null)\s*,?\s*', "")
    members = F.regexp_extract(others, r"(?s)^\s*\{\s*(.*?),?\s*\}\s*$", 1)
    tail = F.when(members == "", "").otherwise(F.concat(F.lit(","), members))
    return items.select(
        "block_height",
        F.col("pos").cast("bigint").alias("tx_index"),
        record_key(F.col("block_height"), F.col("pos")).alias("key"),
        F.concat(F.lit('{"blockHash":"'), "h", F.lit('"'), tail, F.lit("}")).alias("raw"),
    )


def usable_logs(bronze: DataFrame, *keep: str) -> DataFrame:
    """Log items with a block number, given as a number or as hex text, beside the kept
    columns."""
    keep = keep or tuple(bronze.columns)
    items = silver.parse(
        bronze, list(keep), schemas.only(schemas.LOG_JSON, "blockNumber", "logIndex"), "blockNumber"
    )
    return items.select(
        *keep, C.block_number(F.col("blockNumber")).alias("block_number"),
        F.col("logIndex").alias("log_index"),
    ).where("block_number is not null")


def block_ordinal(items: DataFrame) -> DataFrame:
    """0-based position of every item in its block, in log order, then arrival order. The
    chain bounds how many items a block has."""
    numbered = ordered.row_number(items, ["block_number"], ["log_index", "kafka_partition", "kafka_offset"])
    return numbered.withColumn("ordinal", F.col("rn") - 1).drop("rn")


def emit_records(items: DataFrame) -> DataFrame:
    """Outgoing key/value records of the items, keyed by block and ordinal."""
    return block_ordinal(items).select(
        record_key(F.col("block_number"), F.col("ordinal")).alias("key"),
        F.to_json(
            F.struct(F.col("block_number").alias("block_height"), "job_name", "run_id", "raw")
        ).alias("value"),
    )
