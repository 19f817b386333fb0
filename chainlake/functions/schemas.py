"""Fixed schemas of topic records and JSON payloads, as DDL."""

from pyspark.sql.types import StructType

# Field names and types of the payloads on the wire.
KAFKA_ROW = (
    "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp"
)

RAW_RECORD = "block_height bigint, job_name string, run_id string, raw string"

RAW_RECORD_DATED = (
    "block_height bigint, job_name string, run_id string, inserted_at string, raw string"
)

PROGRESS_RECORD = (
    "checkpoint bigint, "
    "producer struct<pod_uid: string, pod_name: string>, "
    "run struct<run_id: string, mode: string, started_at: string, start_block: bigint>"
)

BACKFILL_STATE_RECORD = (
    "job_name string, run_id string, range struct<start: bigint, end: bigint>, "
    "checkpoint bigint, status string, inserted_at string"
)

STATE_STATUSES = ("running", "stopped", "completed", "failed")

TX_JSON = (
    "blockHash string, blockNumber string, `from` string, `to` string, nonce string, "
    "hash string, transactionIndex string, value string, gas string, gasPrice string, "
    "maxFeePerGas string, maxPriorityFeePerGas string, input string, type string, "
    "accessList array<struct<address: string, storageKeys: array<string>>>, "
    "chainId string, v string, r string, s string, yParity string"
)

# blockNumber arrives as a number or as hex text, so it is read as text.
LOG_JSON = (
    "removed boolean, logIndex bigint, transactionIndex bigint, transactionHash string, "
    "blockHash string, blockNumber string, blockTimestamp string, address string, "
    "data string, topics array<string>"
)

WITHDRAWAL = "index: bigint, validatorIndex: bigint, address: string, amount: bigint"

BLOCK_JSON = (
    "baseFeePerGas bigint, blobGasUsed bigint, difficulty bigint, excessBlobGas bigint, "
    "gasLimit bigint, gasUsed bigint, number bigint, size bigint, timestamp bigint, "
    "extraData string, hash string, logsBloom string, miner string, mixHash string, "
    "nonce string, parentBeaconBlockRoot string, parentHash string, receiptsRoot string, "
    "requestsHash string, sha3Uncles string, stateRoot string, transactionsRoot string, "
    "withdrawalsRoot string, uncles array<string>, "
    f"withdrawals array<struct<{WITHDRAWAL}>>"
)


def struct(ddl: str) -> StructType:
    return StructType.fromDDL(ddl)


def only(ddl: str, *names: str) -> StructType:
    """The named fields of a schema, so that a query parses no more JSON than it uses."""
    full = struct(ddl)
    return StructType([full[n] for n in names])
