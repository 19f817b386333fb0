"""Pieces of SQL text shared by the statements queries are checked against."""

from __future__ import annotations


def field(name: str, raw: str = "raw") -> str:
    return f"json_extract_string({raw}, '$.{name}')"


def long(x: str) -> str:
    return f"try_cast(nullif({x}, '0x') as bigint)"


def huge(x: str) -> str:
    """Exact decimal text; NULL above 10^38-1."""
    n = f"try_cast(nullif({x}, '0x') as hugeint)"
    return f"case when {n} <= 99999999999999999999999999999999999999 then cast({n} as varchar) end"


def sum_hex(word: str) -> str:
    """Sum of 64-digit hex quantities as 80 digits, limb by limb."""
    base = "18446744073709551616::hugeint"
    total, digits = "0::hugeint", []
    for start in (49, 33, 17, 1):
        limb = f"sum(cast('0x' || substr({word}, {start}, 16) as ubigint)::hugeint)"
        whole = f"({limb} + {total})"
        digits.append(f"lower(lpad(hex(({whole} % {base})::ubigint), 16, '0'))")
        total = f"({whole} // {base})"
    digits.append(f"lower(lpad(hex(({total})::ubigint), 16, '0'))")
    return " || ".join(reversed(digits))


def word(x: str) -> str:
    return f"case when length({x}) > 2 then lower(lpad(substr({x}, 3), 64, '0')) end"


def u64(x: str) -> str:
    return f"cast(try_cast('0x' || right({word(x)}, 16) as ubigint) as varchar)"


def u32(x: str) -> str:
    return f"cast(try_cast('0x' || right({word(x)}, 8) as bigint) as bigint)"


def addr(x: str) -> str:
    return f"nullif(lower({x}), '')"


def kind(to: str, data: str) -> str:
    return (
        f"case when coalesce({to}, '') = '' then 'contract_creation' "
        f"when {data} = '0x' then 'transfer' else 'contract_call' end"
    )


def fee(kind: str) -> str:
    return f"case when {kind} = '0x2' then 'eip1559' when {kind} = '0x1' then 'access_list' else 'legacy' end"


def window_start(ts: str, seconds: int) -> str:
    return f"(TIMESTAMP '1970-01-01' + to_seconds(cast(floor(epoch({ts}) / {seconds}) * {seconds} as bigint)))"


# Transactions whose payload parses, with the payload fields as columns.
TXJ = (
    "txj as (select * from tx where json_valid(raw)), "
    "p as (select *, " + ", ".join(
        f"{field(f)} as j_{f.lower()}"
        for f in (
            "hash", "blockHash", "blockNumber", "from", "to", "nonce", "transactionIndex", "value",
            "gas", "gasPrice", "maxFeePerGas", "maxPriorityFeePerGas", "input", "type", "chainId",
            "v", "r", "s", "yParity",
        )
    ) + " from txj)"
)

STATEJ = (
    "st as (select cast(json_extract_string(payload, '$.checkpoint') as bigint) as checkpoint_block, "
    "json_extract_string(payload, '$.producer.pod_name') as producer_pod_name, "
    "json_extract_string(payload, '$.producer.pod_uid') as producer_pod_uid, "
    "json_extract_string(payload, '$.run.run_id') as run_id, "
    "json_extract_string(payload, '$.run.mode') as run_mode, "
    "cast(json_extract_string(payload, '$.run.start_block') as bigint) as run_start_block, "
    "date_trunc('millisecond', kafka_timestamp) as run_started_at, "
    "kafka_key, kafka_topic, kafka_partition, kafka_offset, kafka_timestamp, "
    "cast(kafka_timestamp as date) as kafka_date from state)"
)

LOGJ = (
    "lj as (select *, " + ", ".join(
        f"{field(f)} as j_{f.lower()}"
        for f in ("removed", "logIndex", "transactionIndex", "transactionHash", "blockHash",
                  "blockNumber", "blockTimestamp", "address", "data")
    ) + ", array_to_string(cast(json_extract(raw, '$.topics') as varchar[]), '|') as j_topics from logs), "
    "lg as (select *, try_cast(j_blocknumber as bigint) as block_number, "
    "try_cast(j_logindex as bigint) as log_index from lj)"
)
