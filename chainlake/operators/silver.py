"""Silver tables: payloads parsed to typed columns. Projections only, no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from chainlake.functions import columns as C
from chainlake.functions import hexnum as H
from chainlake.functions import schemas

KAFKA_COLUMNS = ["kafka_topic", "kafka_partition", "kafka_offset", "kafka_timestamp", "kafka_date"]


def parse(bronze: DataFrame, keep: list[str], schema: StructType, required: str) -> DataFrame:
    """Parse ``raw`` and drop rows without the required field.

    A filter on a parsed struct would be pushed below the projection and parse every row
    twice; emitting the struct from a one- or zero-element array parses it once.
    """
    item = F.array(F.from_json("raw", schema))
    found = F.filter(item, lambda t: F.coalesce(t[required] != "", F.lit(False)))
    return bronze.select(*keep, F.inline(found))


def parse_tx(bronze: DataFrame, keep: list[str], *fields: str) -> DataFrame:
    schema = schemas.only(schemas.TX_JSON, *fields) if fields else schemas.struct(schemas.TX_JSON)
    return parse(bronze, keep, schema, "hash")


def parsed_once(bronze: DataFrame, raw: str = "raw", out: str = "payload") -> DataFrame:
    """Replace payload text by a VARIANT column: it is parsed when it is stored, and later
    reads take members from the binary form. Text that is no JSON gives NULL."""
    return bronze.withColumn(out, F.try_parse_json(raw)).drop(raw)


def members(stored: DataFrame, keep: list[str], names: dict[str, str], payload: str = "payload") -> DataFrame:
    """Members of stored payloads as text, ``names`` giving each its column."""
    found = [F.try_variant_get(payload, f"$.{member}", "string").alias(column) for member, column in names.items()]
    return stored.select(*keep, *found)


def enriched_tx(bronze: DataFrame) -> DataFrame:
    """Typed, classified transactions."""
    tx = parse_tx(bronze, ["block_height", "job_name", "run_id", *KAFKA_COLUMNS])
    data, kind, to = F.col("input"), F.col("type"), C.address(F.col("to"))
    return tx.select(
        "block_height", "job_name", "run_id", *KAFKA_COLUMNS,
        F.col("hash").alias("tx_hash"),
        F.col("blockHash").alias("block_hash"),
        H.hex_to_long(F.col("blockNumber")).alias("block_number"),
        H.hex_to_int(F.col("transactionIndex")).alias("tx_index"),
        H.hex_to_long(F.col("nonce")).alias("nonce"),
        C.address(F.col("from")).alias("from_address"),
        to.alias("to_address"),
        H.hex_to_decimal(F.col("value")).alias("value_wei"),
        H.hex64(F.col("value")).alias("value_hex64"),
        H.hex_to_long(F.col("gas")).alias("gas_limit"),
        H.hex_to_long(F.col("gasPrice")).alias("gas_price"),
        H.hex_to_long(F.col("maxFeePerGas")).alias("max_fee_per_gas"),
        H.hex_to_long(F.col("maxPriorityFeePerGas")).alias("max_priority_fee_per_gas"),
        kind.alias("tx_type"),
        C.strip_type(kind).alias("tx_type_code"),
        H.hex_to_int(F.col("chainId")).alias("chain_id"),
        F.col("v").alias("sig_v"),
        F.col("r").alias("sig_r"),
        F.col("s").alias("sig_s"),
        F.col("yParity").alias("y_parity"),
        data.alias("input_data"),
        C.has_input(data).alias("has_input"),
        C.method_id(data).alias("method_id"),
        C.input_length(data).alias("input_length"),
        C.input_words(data).alias("input_words"),
        C.arg_words(data).alias("arg_words"),
        C.input_hash(data).alias("input_hash"),
        C.is_proxy_like(data).alias("is_proxy_like"),
        C.tx_kind(to, data).alias("tx_kind"),
        C.has_input(data).alias("is_contract_call"),
        C.fee_model(kind).alias("fee_model"),
    )


def _amounts() -> list[Column]:
    return [
        H.hex_to_decimal(F.col("value")).alias("value_wei"),
        H.hex64(F.col("value")).alias("value_hex64"),
        H.hex_to_uint64(F.col("gas")).alias("gas_limit"),
        H.hex_to_uint64(F.col("gasPrice")).alias("gas_price"),
        H.hex_to_uint64(F.col("maxFeePerGas")).alias("max_fee_per_gas"),
        H.hex_to_uint64(F.col("maxPriorityFeePerGas")).alias("max_priority_fee_per_gas"),
    ]


NORMALIZED_FIELDS = (
    "hash", "transactionIndex", "from", "to", "value", "gas", "gasPrice", "maxFeePerGas",
    "maxPriorityFeePerGas", "type", "input", "chainId",
)


def normalized_tx(bronze: DataFrame, prefix: str = "normalized_transaction") -> DataFrame:
    """The narrow form: identity, addresses, amounts, input, chain, kinds."""
    tx = parse_tx(bronze, ["block_height"], *NORMALIZED_FIELDS)
    index = H.hex_to_uint64(F.col("transactionIndex"))
    data, kind, to = F.col("input"), F.col("type"), C.address(F.col("to"))
    return tx.select(
        C.composite_id(prefix, F.col("hash"), index).alias("id"),
        F.col("hash").alias("tx_hash"),
        F.col("block_height").alias("block_number"),
        index.alias("tx_index"),
        C.address(F.col("from")).alias("from_address"),
        to.alias("to_address"),
        *_amounts(),
        C.strip_type(kind).alias("tx_type"),
        data.alias("input_data"),
        H.hex_to_uint32(F.col("chainId")).alias("chain_id"),
        C.tx_kind(to, data).alias("tx_kind"),
        C.fee_model(kind).alias("fee_model"),
    )


def fact_tx(bronze: DataFrame) -> DataFrame:
    """The enriched form keyed by the envelope's height beside the parsed block number."""
    tx = parse_tx(
        bronze, ["block_height", *KAFKA_COLUMNS], "blockHash", "blockNumber", *NORMALIZED_FIELDS
    )
    data, kind, to = F.col("input"), F.col("type"), C.address(F.col("to"))
    return tx.select(
        "block_height",
        H.hex_to_uint64(F.col("blockNumber")).alias("block_number"),
        F.col("blockHash").alias("block_hash"),
        F.col("hash").alias("tx_hash"),
        H.hex_to_uint64(F.col("transactionIndex")).alias("tx_index"),
        C.address(F.col("from")).alias("from_address"),
        to.alias("to_address"),
        *_amounts(),
        kind.alias("tx_type"),
        C.tx_kind(to, data).alias("tx_kind"),
        C.fee_model(kind).alias("fee_model"),
        C.method_id(data).alias("method_id"),
        C.input_length(data).alias("input_length"),
        C.input_words(data).alias("input_words"),
        C.input_hash(data).alias("input_hash"),
        C.has_input(data).alias("has_input"),
        C.is_proxy_like(data).alias("is_proxy_like"),
        H.hex_to_uint32(F.col("chainId")).alias("chain_id"),
        *KAFKA_COLUMNS,
    )


def silver_logs(bronze: DataFrame) -> DataFrame:
    schema = schemas.struct(schemas.LOG_JSON)
    log = parse(bronze, ["job_name", "run_id", "inserted_at"], schema, "transactionHash")
    return log.select(
        C.block_number(F.col("blockNumber")).alias("block_number"),
        F.col("transactionHash").alias("transaction_hash"),
        F.col("logIndex").alias("log_index"),
        "removed",
        F.col("transactionIndex").alias("transaction_index"),
        F.col("blockHash").alias("block_hash"),
        "address", "data", "topics",
        H.hex_to_timestamp(F.col("blockTimestamp")).alias("block_timestamp"),
        "job_name", "run_id", C.iso_ts(F.col("inserted_at")).alias("inserted_at"),
    )


def silver_blocks(bronze: DataFrame) -> DataFrame:
    fields = ("hash", "parentHash", "number", "timestamp", "miner", "gasUsed", "gasLimit",
              "baseFeePerGas", "withdrawals", "withdrawalsRoot")
    schema = schemas.only(schemas.BLOCK_JSON, *fields)
    b = parse(bronze, ["block_height", "job_name", "run_id", "inserted_at"], schema, "hash")
    return b.select(
        "block_height", "job_name", "run_id", C.iso_ts(F.col("inserted_at")).alias("inserted_at"),
        F.col("number").alias("block_number"),
        F.col("timestamp").alias("block_timestamp"),
        "miner",
        F.col("gasUsed").alias("gas_used"),
        F.col("gasLimit").alias("gas_limit"),
        F.col("baseFeePerGas").alias("base_fee_per_gas"),
        "withdrawals",
        F.col("withdrawalsRoot").alias("withdrawals_root"),
        C.unix_ts(F.col("timestamp")).alias("block_ts"),
    )
