"""I: scalar functions and the projections built from them."""

from __future__ import annotations

from pyspark.sql import functions as F

from chainlake.functions import columns as C
from chainlake.functions import hexnum as H
from chainlake.functions import schemas
from chainlake.operators import bronze, silver, state
from chainlake.plans import sqltext as S
from chainlake.plans.common import state_records
from chainlake.plans.registry import query
from chainlake.session import scratch

K = "kafka_partition, kafka_offset"
KEYS = ["kafka_partition", "kafka_offset"]


def over_tx(name, sql_cols, fields, *, pre=()):
    """Register a query of scalar columns over parsed transactions."""

    def wrap(fn):
        @query(name, f"with {S.TXJ} select {K}, {sql_cols} from p", "tx")
        def run(src):
            tx = silver.parse_tx(src.view("tx"), KEYS, "hash", *fields)
            return tx.select(*KEYS, *fn())

        run.__doc__ = fn.__doc__
        return fn

    return wrap


@over_tx("i1_hex_to_long",
         f"{S.long('j_value')} as value_long, {S.long('j_gasprice')} as gas_price, "
         f"cast({S.long('j_transactionindex')} as integer) as tx_index",
         ["value", "gasPrice", "transactionIndex"])
def hex_to_long():
    return [H.hex_to_long(F.col("value")).alias("value_long"),
            H.hex_to_long(F.col("gasPrice")).alias("gas_price"),
            H.hex_to_int(F.col("transactionIndex")).alias("tx_index")]


@over_tx("i2_hex_to_uint256", f"{S.huge('j_value')} as value_wei, {S.word('j_value')} as value_hex64", ["value"])
def hex_to_uint256():
    return [H.hex_to_decimal(F.col("value")).alias("value_wei"), H.hex64(F.col("value")).alias("value_hex64")]


@over_tx("i3_hex_to_uint64",
         f"{S.u64('j_gas')} as gas_limit, {S.u64('j_value')} as value_low64, {S.u32('j_chainid')} as chain_id",
         ["gas", "value", "chainId"])
def hex_to_uint64():
    return [H.hex_to_uint64(F.col("gas")).alias("gas_limit"),
            H.hex_to_uint64(F.col("value")).alias("value_low64"),
            H.hex_to_uint32(F.col("chainId")).alias("chain_id")]


@over_tx("i4_hex_substr_conv",
         ", ".join(f"{S.huge(f'''substr(j_value, 1, {w + 2})''')} as value_{w}" for w in (10, 20, 64)),
         ["value"])
def hex_substr_conv():
    return [H.hex_substr(F.col("value"), w).alias(f"value_{w}") for w in (10, 20, 64)]


@query("i5_hex_ts", f"""with {S.LOGJ} select {K},
    (TIMESTAMP '1970-01-01' + to_seconds({S.long('j_blocktimestamp')})) as block_timestamp from lg""", "logs")
def hex_ts(src):
    logs = silver.parse(src.view("logs"), KEYS, schemas.only(schemas.LOG_JSON, "transactionHash", "blockTimestamp"),
                        "transactionHash")
    return logs.select(*KEYS, H.hex_to_timestamp(F.col("blockTimestamp")).alias("block_timestamp"))


@query("i6_unix_ts", """select block_height,
    (TIMESTAMP '1970-01-01' + to_seconds(cast(json_extract_string(raw, '$.timestamp') as bigint))) as block_ts
    from blocks""", "blocks")
def unix_ts(src):
    b = silver.parse(src.view("blocks"), ["block_height"], schemas.only(schemas.BLOCK_JSON, "hash", "timestamp"), "hash")
    return b.select("block_height", C.unix_ts(F.col("timestamp")).alias("block_ts"))


@query("i7_iso_ts", f"""select {K}, strptime(inserted_at, '%Y-%m-%dT%H:%M:%S.%gZ') as inserted_at,
    cast(null as timestamp) as unparsed from logs""", "logs")
def iso_ts(src):
    return src.view("logs").select(
        *KEYS, C.iso_ts(F.col("inserted_at")).alias("inserted_at"), C.iso_ts(F.col("job_name")).alias("unparsed"))


@query("i8_to_date", f"select {K}, cast(cast(kafka_timestamp as date) as varchar) as kafka_date from tx", "tx")
def to_date(src):
    return src.view("tx").select(*KEYS, F.to_date("kafka_timestamp").alias("kafka_date"))


@query("i9_day_bounds", """select event_id, cast(epoch(date_trunc('day', ts)) as bigint) as day_start,
    cast(epoch(date_trunc('day', ts) + interval 1 day) as bigint) as next_day_start from events""")
def day_bounds(src):
    day = F.date_format("ts", "yyyy-MM-dd")
    return src.table("events").select(
        "event_id", C.day_start(day).alias("day_start"), C.next_day_start(day).alias("next_day_start"))


@query("i10_now_iso", """select event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ') as ts_iso, 24 as now_length
    from events""")
def now_iso(src):
    return src.table("events").select(
        "event_id", C.to_iso(F.col("ts")).alias("ts_iso"), F.length(C.now_iso()).alias("now_length"))


@query("i11_parse_tx_json", f"""with {S.TXJ} select {K}, j_hash as hash, j_from as sender, j_to as receiver,
    j_input as input, j_maxfeepergas as max_fee, j_yparity as y_parity,
    json_extract_string(raw, '$.accessList[0].address') as access_address,
    array_to_string(cast(json_extract(raw, '$.accessList[0].storageKeys') as varchar[]), '|') as storage_keys
    from p""", "tx")
def parse_tx_json(src):
    tx = silver.parse_tx(src.view("tx"), KEYS)
    first = F.get("accessList", F.lit(0))
    return tx.select(
        *KEYS, "hash", F.col("from").alias("sender"), F.col("to").alias("receiver"), "input",
        F.col("maxFeePerGas").alias("max_fee"), F.col("yParity").alias("y_parity"),
        first["address"].alias("access_address"), first["storageKeys"].alias("storage_keys"))


@query("i12_parse_log_json", f"""with {S.LOGJ} select {K}, j_removed = 'true' as removed, log_index,
    cast(j_transactionindex as bigint) as transaction_index, j_transactionhash as transaction_hash,
    j_blocknumber as block_number_text, j_topics as topics from lg""", "logs")
def parse_log_json(src):
    logs = silver.parse(src.view("logs"), KEYS, schemas.struct(schemas.LOG_JSON), "transactionHash")
    return logs.select(
        *KEYS, "removed", F.col("logIndex").alias("log_index"), F.col("transactionIndex").alias("transaction_index"),
        F.col("transactionHash").alias("transaction_hash"), F.col("blockNumber").alias("block_number_text"), "topics")


@query("i13_parse_block_json", """select block_height, cast(json_extract_string(raw, '$.number') as bigint) as number,
    json_extract_string(raw, '$.parentHash') as parent_hash, json_extract_string(raw, '$.miner') as miner,
    cast(json_extract_string(raw, '$.gasUsed') as bigint) as gas_used,
    cast(json_extract_string(raw, '$.size') as bigint) as size,
    cast(json_array_length(raw, '$.withdrawals') as integer) as n_withdrawals,
    cast(json_array_length(raw, '$.uncles') as integer) as n_uncles from blocks""", "blocks")
def parse_block_json(src):
    b = silver.parse(src.view("blocks"), ["block_height"], schemas.struct(schemas.BLOCK_JSON), "hash")
    return b.select(
        "block_height", "number", F.col("parentHash").alias("parent_hash"), "miner",
        F.col("gasUsed").alias("gas_used"), "size", F.size("withdrawals").alias("n_withdrawals"),
        F.size("uncles").alias("n_uncles"))


@query("i14_json_field", f"""with {S.TXJ} select {K}, j_hash as hash, j_to as receiver, j_chainid as chain from p
    union all select {K}, null, null, null from tx where not json_valid(raw)""", "tx")
def json_field(src):
    found = src.view("tx").select(*KEYS, F.json_tuple("raw", "yParity", "hash", "to", "chainId").alias("_last", "hash", "receiver", "chain"))
    # A cut-off payload may still yield the members before the cut, which is not a parsed row.
    whole = F.col("_last").isNotNull()
    return found.select(*KEYS, *[F.when(whole, F.col(n)).alias(n) for n in ("hash", "receiver", "chain")])


@query("i14_variant_member", f"""with {S.TXJ} select {K}, j_hash as hash, j_to as receiver, j_chainid as chain, j_blockhash as block_hash from p
    union all select {K}, null, null, null, null from tx where not json_valid(raw)""", "tx")
def variant_member(src):
    """Members of payloads that were parsed once, when they were stored."""
    path = scratch(src.spark, "i14-bronze")
    silver.parsed_once(src.view("tx").select(*KEYS, "raw")).write.parquet(path)
    stored = src.spark.read.parquet(path)
    return silver.members(stored, KEYS, {"hash": "hash", "to": "receiver", "chainId": "chain", "blockHash": "block_hash"})


@over_tx("i15_lower_addr", f"{S.addr('j_from')} as from_address, {S.addr('j_to')} as to_address, "
         "regexp_replace(j_type, '^0x', '') as tx_type", ["from", "to", "type"])
def lower_addr():
    return [C.address(F.col("from")).alias("from_address"), C.address(F.col("to")).alias("to_address"),
            C.strip_type(F.col("type")).alias("tx_type")]


@over_tx("i16_composite_id", "'normalized_transaction_' || j_hash || '_' || " + S.u64("j_transactionindex")
         + " as normalized_id, 'enriched_transaction_' || j_hash || '_' || " + S.u64("j_transactionindex")
         + " as enriched_id", ["transactionIndex"])
def composite_id():
    index = H.hex_to_uint64(F.col("transactionIndex"))
    return [C.composite_id(f"{p}_transaction", F.col("hash"), index).alias(f"{p}_id") for p in ("normalized", "enriched")]


@over_tx("i17_has_input", "coalesce(j_input <> '0x', false) as has_input, "
         "coalesce(j_input <> '0x', false) as is_contract_call", ["input"])
def has_input():
    return [C.has_input(F.col("input")).alias(n) for n in ("has_input", "is_contract_call")]


@over_tx("i18_method_id", "case when j_input <> '0x' then substr(j_input, 1, 10) end as method_id", ["input"])
def method_id():
    return [C.method_id(F.col("input")).alias("method_id")]


@over_tx("i19_input_length", """cast(length(j_input) as integer) as input_length,
    (length(j_input) - 2) / 64 as input_words,
    case when j_input <> '0x' then cast(floor((length(j_input) - 10) / 64) as bigint) end as arg_words""", ["input"])
def input_length():
    c = F.col("input")
    return [C.input_length(c).alias("input_length"), C.input_words(c).alias("input_words"),
            C.arg_words(c).alias("arg_words")]


@over_tx("i20_input_hash", "sha256(j_input) as input_hash", ["input"])
def input_hash():
    return [C.input_hash(F.col("input")).alias("input_hash")]


@over_tx("i21_is_proxy_like", """coalesce(j_input <> '0x' and substr(j_input, 1, 10) in ('0x5c60da1b', '0x3659cfe6'),
    false) as is_proxy_like, coalesce(j_input <> '0x' and substr(j_input, 1, 10) in ('0x5ae401dc', '0x1cff79cd',
    '0x3593564c') and floor((length(j_input) - 10) / 64) >= 4, false) as is_router_like""", ["input"])
def is_proxy_like():
    return [C.is_proxy_like(F.col("input")).alias("is_proxy_like"),
            C.is_proxy_like(F.col("input"), C.PROXY_ROUTER, 4).alias("is_router_like")]


@over_tx("i22_tx_kind", S.kind("j_to", "j_input") + " as tx_kind", ["to", "input"])
def tx_kind():
    return [C.tx_kind(F.col("to"), F.col("input")).alias("tx_kind")]


@over_tx("i23_fee_model", S.fee("j_type") + " as fee_model", ["type"])
def fee_model():
    return [C.fee_model(F.col("type")).alias("fee_model")]


@query("i24_split_state_key", """select kafka_offset, nullif(split_part(replace(kafka_key, '_', ':'), ':', 1), '') as chain,
    nullif(split_part(replace(kafka_key, '_', ':'), ':', 2), '') as entity,
    nullif(split_part(replace(kafka_key, '_', ':'), ':', 3), '') as type from state""", "state")
def split_state_key(src):
    key = C.split_state_key(F.col("kafka_key"))
    return src.view("state").select("kafka_offset", *[key[n].alias(n) for n in ("chain", "entity", "type")])


@query("i25_json_safe", """select event_id, '{"id":' || event_id || ',"bytes":"0x' || lower(hex(encode(props))) || '"}' as safe
    from events""")
def json_safe(src):
    rows = src.table("events")
    return rows.select("event_id", F.to_json(F.struct(
        F.col("event_id").alias("id"), C.bytes_text(F.encode("props", "UTF-8")).alias("bytes"))).alias("safe"))


@query("i27_safe_name", r"""select conv_id, turn, substr(trim(regexp_replace(title, '[\\/:*?"<>|]', '_', 'g')), 1, 120) as title_name,
    substr(trim(regexp_replace(replace(text, chr(10), ' '), '[\\/:*?"<>|]', '_', 'g')), 1, 120) as text_name from chats""", "chats")
def safe_name(src):
    line = F.replace(F.col("text"), F.lit("\n"), F.lit(" "))
    return src.view("chats").select(
        "conv_id", "turn", C.safe_name(F.col("title")).alias("title_name"), C.safe_name(line).alias("text_name"))


@over_tx("i28_if_null", """coalesce(nullif(j_to, ''), 'none') as receiver,
    case when j_type = '0x2' then 2 when j_type = '0x1' then 1 else 0 end as type_code""", ["to", "type"])
def if_null():
    kind = F.col("type")
    return [F.coalesce(F.nullif(F.col("to"), F.lit("")), F.lit("none")).alias("receiver"),
            F.when(kind == "0x2", 2).when(kind == "0x1", 1).otherwise(0).alias("type_code")]


AMOUNTS = ", ".join(
    [f"{S.huge('j_value')} as value_wei", f"{S.word('j_value')} as value_hex64"]
    + [f"{S.u64('j_' + f.lower())} as {n}" for f, n in (
        ("gas", "gas_limit"), ("gasPrice", "gas_price"), ("maxFeePerGas", "max_fee_per_gas"),
        ("maxPriorityFeePerGas", "max_priority_fee_per_gas"))]
)
INPUTS = """j_input as input_data, coalesce(j_input <> '0x', false) as has_input,
    case when j_input <> '0x' then substr(j_input, 1, 10) end as method_id,
    cast(length(j_input) as integer) as input_length, (length(j_input) - 2) / 64 as input_words,
    sha256(j_input) as input_hash,
    coalesce(j_input <> '0x' and substr(j_input, 1, 10) in ('0x5c60da1b', '0x3659cfe6'), false) as is_proxy_like"""
KAFKA = "kafka_topic, kafka_partition, kafka_offset, kafka_timestamp, cast(kafka_date as varchar) as kafka_date"
LONGS = ", ".join(f"{S.long('j_' + f.lower())} as {n}" for f, n in (
    ("blockNumber", "block_number"), ("nonce", "nonce"), ("gas", "gas_limit"), ("gasPrice", "gas_price"),
    ("maxFeePerGas", "max_fee_per_gas"), ("maxPriorityFeePerGas", "max_priority_fee_per_gas")))

ENRICHED_SQL = f"""select block_height, job_name, run_id, {KAFKA}, j_hash as tx_hash, j_blockhash as block_hash,
    {LONGS}, cast({S.long('j_transactionindex')} as integer) as tx_index, {S.addr('j_from')} as from_address,
    {S.addr('j_to')} as to_address, {S.huge('j_value')} as value_wei, {S.word('j_value')} as value_hex64,
    j_type as tx_type, regexp_replace(j_type, '^0x', '') as tx_type_code,
    cast({S.long('j_chainid')} as integer) as chain_id, j_v as sig_v, j_r as sig_r, j_s as sig_s,
    j_yparity as y_parity, {INPUTS},
    case when j_input <> '0x' then cast(floor((length(j_input) - 10) / 64) as bigint) end as arg_words,
    {S.kind('j_to', 'j_input')} as tx_kind, coalesce(j_input <> '0x', false) as is_contract_call,
    {S.fee('j_type')} as fee_model from p"""


@query("i29_enriched_tx", f"with {S.TXJ} {ENRICHED_SQL}", "tx")
def enriched_tx(src):
    return silver.enriched_tx(src.view("tx"))


@query("i29_enriched_tx_summary", f"""with {S.TXJ}, e as ({ENRICHED_SQL}) select tx_kind, fee_model, count(*) as n_tx,
    {S.sum_hex('value_hex64')} as value_hex80, count(distinct method_id) as methods,
    cast(sum(gas_limit) as bigint) as gas_limit from e group by tx_kind, fee_model""", "tx")
def enriched_summary(src):
    """The flagship: silver transactions summed up by kind and fee model."""
    return silver.enriched_tx(src.view("tx")).groupBy("tx_kind", "fee_model").agg(
        F.count(F.lit(1)).alias("n_tx"), H.sum_hex64(F.col("value_hex64")).alias("value_hex80"),
        F.countDistinct("method_id").alias("methods"), F.sum("gas_limit").alias("gas_limit"))


@query("i30_normalized_tx", f"""with {S.TXJ} select 'normalized_transaction_' || j_hash || '_' || {S.u64('j_transactionindex')} as id,
    j_hash as tx_hash, block_height as block_number, {S.u64('j_transactionindex')} as tx_index,
    {S.addr('j_from')} as from_address, {S.addr('j_to')} as to_address, {AMOUNTS},
    regexp_replace(j_type, '^0x', '') as tx_type, j_input as input_data, {S.u32('j_chainid')} as chain_id,
    {S.kind('j_to', 'j_input')} as tx_kind, {S.fee('j_type')} as fee_model from p""", "tx")
def normalized_tx(src):
    return silver.normalized_tx(src.view("tx"))


@query("i31_fact_tx", f"""with {S.TXJ}, f as (select *, {INPUTS} from p) select block_height, {S.u64('j_blocknumber')} as block_number,
    j_blockhash as block_hash, j_hash as tx_hash, {S.u64('j_transactionindex')} as tx_index,
    {S.addr('j_from')} as from_address, {S.addr('j_to')} as to_address, {AMOUNTS}, j_type as tx_type,
    {S.kind('j_to', 'j_input')} as tx_kind, {S.fee('j_type')} as fee_model, method_id, input_length, input_words,
    input_hash, has_input, is_proxy_like, {S.u32('j_chainid')} as chain_id, {KAFKA} from f""", "tx")
def fact_tx(src):
    return silver.fact_tx(src.view("tx"))


@query("i32_silver_logs", f"""with {S.LOGJ} select block_number, j_transactionhash as transaction_hash, log_index,
    j_removed = 'true' as removed, cast(j_transactionindex as bigint) as transaction_index, j_blockhash as block_hash,
    j_address as address, j_data as data, j_topics as topics,
    (TIMESTAMP '1970-01-01' + to_seconds({S.long('j_blocktimestamp')})) as block_timestamp, job_name, run_id,
    strptime(inserted_at, '%Y-%m-%dT%H:%M:%S.%gZ') as inserted_at from lg""", "logs")
def silver_logs(src):
    return silver.silver_logs(src.view("logs"))


@query("i33_silver_blocks", """select block_height, job_name, run_id, strptime(inserted_at, '%Y-%m-%dT%H:%M:%S.%gZ') as inserted_at,
    cast(json_extract_string(raw, '$.number') as bigint) as block_number,
    cast(json_extract_string(raw, '$.timestamp') as bigint) as block_timestamp,
    json_extract_string(raw, '$.miner') as miner, cast(json_extract_string(raw, '$.gasUsed') as bigint) as gas_used,
    cast(json_extract_string(raw, '$.gasLimit') as bigint) as gas_limit,
    cast(json_extract_string(raw, '$.baseFeePerGas') as bigint) as base_fee_per_gas,
    cast(json_extract(raw, '$.withdrawals') as varchar) as withdrawals,
    json_extract_string(raw, '$.withdrawalsRoot') as withdrawals_root,
    (TIMESTAMP '1970-01-01' + to_seconds(cast(json_extract_string(raw, '$.timestamp') as bigint))) as block_ts
    from blocks""", "blocks")
def silver_blocks(src):
    return silver.silver_blocks(src.view("blocks"))


RAW_SQL = " union all ".join(
    f"select block_height, job_name, run_id, raw, kafka_topic, kafka_partition, kafka_offset, kafka_timestamp, "
    f"cast(cast(kafka_timestamp as date) as varchar) as kafka_date from {v}" for v in ("blocks", "logs", "tx"))


@query("i34_raw_topic_copy", RAW_SQL, ("blocks", "logs", "tx"))
def raw_topic_copy(src):
    a, b, c = (bronze.raw_topic_copy(src.view(v)) for v in ("blocks", "logs", "tx"))
    return a.unionByName(b).unionByName(c)


@query("i35_state_flatten", f"""with {S.STATEJ} select * replace (cast(kafka_date as varchar) as kafka_date), true as updated
    from st""", "state")
def state_flatten(src):
    rows = state.flatten_state(state_records(src))
    return rows.withColumn("updated", F.col("state_updated_at").isNotNull()).drop("state_updated_at")
