"""Inputs several queries start from."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chainlake.functions import columns as C
from chainlake.functions import schemas
from chainlake.operators import silver, state
from chainlake.plans.registry import Source
from chainlake.sources import topics

TX_RECORD = ["block_height", "job_name", "run_id", "raw"]
LOG_RECORD = ["block_height", "job_name", "run_id", "inserted_at", "raw"]


def tx_wire(rows: DataFrame) -> DataFrame:
    key = F.concat_ws("-", F.col("block_height").cast("string"), F.col("kafka_offset").cast("string"))
    return topics.to_wire(rows, key, TX_RECORD)


def log_wire(rows: DataFrame) -> DataFrame:
    key = F.concat_ws("-", F.col("block_height").cast("string"), F.col("kafka_offset").cast("string"))
    return topics.to_wire(rows, key, LOG_RECORD)


def state_records(src: Source) -> DataFrame:
    """Decoded progress records with their Kafka coordinates."""
    rows = src.view("state")
    record = F.from_json("payload", schemas.struct(schemas.PROGRESS_RECORD))
    return rows.select(record.alias("r"), *[c for c in rows.columns if c != "payload"]).select(
        "r.*", *[c for c in rows.columns if c != "payload"]
    )


def state_table(src: Source) -> DataFrame:
    return state.flatten_state(state_records(src))


# Columns queries ask for: the payload fields each is made from, and how.
LOG_COLUMNS = {
    "transaction_hash": (("transactionHash",), lambda: F.col("transactionHash")),
    "block_number": (("blockNumber",), lambda: C.block_number(F.col("blockNumber"))),
    "log_index": (("logIndex",), lambda: F.col("logIndex")),
    "log_address": (("address",), lambda: F.col("address")),
}
TX_COLUMNS = {
    "tx_hash": (("hash",), lambda: F.col("hash")),
    "block_number": ((), lambda: F.col("block_height")),
    "block_hash": (("blockHash",), lambda: F.col("blockHash")),
    "from_address": (("from",), lambda: C.address(F.col("from"))),
    "to_address": (("to",), lambda: C.address(F.col("to"))),
    "method_id": (("input",), lambda: C.method_id(F.col("input"))),
    "is_proxy_like": (("input",), lambda: C.is_proxy_like(F.col("input"))),
    "tx_kind": (("to", "input"), lambda: C.tx_kind(F.col("to"), F.col("input"))),
}


def parsed_logs(src: Source, *columns: str) -> DataFrame:
    """The named columns of the logs, parsing no other field."""
    fields = {"transactionHash", *[f for c in columns for f in LOG_COLUMNS[c][0]]}
    rows = silver.parse(src.view("logs"), [], schemas.only(schemas.LOG_JSON, *sorted(fields)), "transactionHash")
    return rows.select(*[LOG_COLUMNS[c][1]().alias(c) for c in columns])


def parsed_tx(src: Source, *columns: str) -> DataFrame:
    """The named columns of the transactions, parsing no other field."""
    fields = {"hash", *[f for c in columns for f in TX_COLUMNS[c][0]]}
    rows = silver.parse_tx(src.view("tx"), ["block_height"], *sorted(fields))
    return rows.select(*[TX_COLUMNS[c][1]().alias(c) for c in columns])
