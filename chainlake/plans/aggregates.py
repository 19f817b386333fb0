"""E: aggregations."""

from __future__ import annotations

from pyspark.sql import functions as F

from chainlake.operators import heavy, layout, metrics, quality, ranges, silver, state
from chainlake.plans import sqltext as S
from chainlake.plans.common import parsed_logs, parsed_tx, state_table
from chainlake.plans.registry import query
from chainlake.session import scratch


@query("e1_max_offset", """select kafka_partition, max(kafka_offset) as mark from tx group by kafka_partition
    union all select null, coalesce(max(kafka_offset), -1) from tx
    union all select -1, coalesce(max(kafka_offset), -1) from tx where false""", "tx")
def max_offset(src):
    """Marks per partition; then the mark of the whole table and that of an empty one."""
    rows = src.view("tx")
    each = state.marks(rows).select("kafka_partition", "mark")
    whole = state.max_offset(rows).select(F.lit(None).cast("int").alias("kafka_partition"), F.col("max_offset").alias("mark"))
    none = state.max_offset(rows.where("false")).select(F.lit(-1).alias("kafka_partition"), F.col("max_offset").alias("mark"))
    return each.unionByName(whole).unionByName(none)


@query("e2_table_frontier", "select max(block_height) as last_block, max(kafka_offset) as last_offset, count(*) as n from tx", "tx")
def table_frontier(src):
    return src.view("tx").agg(F.max("block_height").alias("last_block"), F.max("kafka_offset").alias("last_offset"),
                              F.count(F.lit(1)).alias("n"))


@query("e3_row_count", "select count(*) as n from logs", "logs")
def row_count(src):
    return src.view("logs").agg(F.count(F.lit(1)).alias("n"))


def stored_coordinates(src):
    """Stored heights and offsets, read so that footers answer."""
    path = scratch(src.spark, "e-bronze")
    rows = src.view("tx").select("block_height", "kafka_offset", "kafka_partition")
    rows.write.partitionBy("kafka_partition").parquet(path)
    return layout.read_with_statistics(src.spark, path, rows.schema)


@query("e2_frontier_from_footers", """select max(block_height) as last_block, min(block_height) as first_block, max(kafka_offset) as last_offset,
    count(*) as n from tx""", "tx")
def frontier_from_footers(src):
    return stored_coordinates(src).agg(
        F.max("block_height").alias("last_block"), F.min("block_height").alias("first_block"),
        F.max("kafka_offset").alias("last_offset"), F.count("*").alias("n"))


@query("e1_marks_from_footers", "select kafka_partition, max(kafka_offset) as mark, count(*) as n from tx group by kafka_partition", "tx")
def marks_from_footers(src):
    """Partitions are folders, so a mark per partition needs no rows either."""
    return stored_coordinates(src).groupBy("kafka_partition").agg(F.max("kafka_offset").alias("mark"), F.count("*").alias("n"))


@query("e4_count_by_flag", f"""with {S.TXJ} select coalesce(j_input <> '0x' and substr(j_input, 1, 10) in ('0x5c60da1b', '0x3659cfe6'), false)
    as is_proxy_like, count(*) as n from p group by 1""", "tx")
def count_by_flag(src):
    return parsed_tx(src, "is_proxy_like").groupBy("is_proxy_like").agg(F.count(F.lit(1)).alias("n"))


@query("e5_duplicate_blocks", "select kafka_topic, block_height, count(*) as copies from tx group by all having count(*) > 1", "tx")
def duplicate_blocks(src):
    return quality.duplicates(src.view("tx"), ["kafka_topic", "block_height"])


ITEMS_SQL = f"{S.LOGJ}, b as (select block_number, count(*) as items from lg where block_number is not null group by 1)"


def items_per_block(src):
    return parsed_logs(src, "block_number").where("block_number is not null").groupBy("block_number").agg(F.count(F.lit(1)).alias("items"))


@query("e6_group_by_block", f"with {ITEMS_SQL} select block_number, items from b", "logs")
def group_by_block(src):
    return items_per_block(src)


@query("e6_batch_totals", f"with {ITEMS_SQL} select count(*) as block_count, cast(sum(items) as bigint) as item_total from b", "logs")
def batch_totals(src):
    return items_per_block(src).agg(F.count(F.lit(1)).alias("block_count"), F.sum("items").alias("item_total"))


@query("e7_block_header_stats", """with b as (select (TIMESTAMP '1970-01-01' + to_seconds(cast(json_extract_string(raw, '$.timestamp') as bigint))) as ts,
    cast(json_extract_string(raw, '$.gasUsed') as bigint) as gas_used, cast(json_extract_string(raw, '$.gasLimit') as bigint) as gas_limit,
    cast(json_extract_string(raw, '$.baseFeePerGas') as bigint) as fee, json_array_length(raw, '$.withdrawals') as w from blocks)
    select date_trunc('hour', ts) as window_start, count(*) as n_blocks, cast(sum(gas_used) as bigint) as gas_used,
    cast(sum(gas_limit) as bigint) as gas_limit, max(fee) as max_base_fee, cast(sum(w) as bigint) as n_withdrawals,
    count(*) / 3600 as blocks_per_second from b group by 1""", "blocks")
def block_header_stats(src):
    b = silver.silver_blocks(src.view("blocks"))
    return b.groupBy(F.window("block_ts", "1 hour").alias("w")).agg(
        F.count(F.lit(1)).alias("n_blocks"), F.sum("gas_used").alias("gas_used"), F.sum("gas_limit").alias("gas_limit"),
        F.max("base_fee_per_gas").alias("max_base_fee"),
        F.sum(F.size("withdrawals").cast("bigint")).alias("n_withdrawals"),
    ).select(F.col("w.start").alias("window_start"), "n_blocks", "gas_used", "gas_limit", "max_base_fee", "n_withdrawals",
             (F.col("n_blocks") / 3600).alias("blocks_per_second"))


@query("e7_withdrawals_by_address", """with w as (select unnest(cast(json_extract(raw, '$.withdrawals') as json[])) as w from blocks)
    select json_extract_string(w, '$.address') as address, count(*) as n,
    cast(sum(cast(json_extract_string(w, '$.amount') as bigint)) as bigint) as amount from w group by 1""", "blocks")
def withdrawals_by_address(src):
    b = silver.silver_blocks(src.view("blocks")).select(F.inline("withdrawals"))
    return b.groupBy("address").agg(F.count(F.lit(1)).alias("n"), F.sum("amount").alias("amount"))


@query("e8_method_stats", f"""with {S.TXJ} select case when j_input <> '0x' then substr(j_input, 1, 10) end as method_id, count(*) as n,
    count(distinct j_from) as callers from p group by 1""", "tx")
def method_stats(src):
    return parsed_tx(src, "method_id", "from_address").groupBy("method_id").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("from_address").alias("callers"))


@query("e8_call_graph", f"""with {S.TXJ} select {S.addr('j_from')} as from_address, {S.addr('j_to')} as to_address, count(*) as n
    from p group by all""", "tx")
def call_graph(src):
    return parsed_tx(src, "from_address", "to_address").groupBy("from_address", "to_address").agg(F.count(F.lit(1)).alias("n"))


# Pairs reported as the heaviest.
HEAVIEST = 50


@query("e8_heaviest_pairs", f"""with {S.TXJ} select {S.addr('j_from')} as from_address, {S.addr('j_to')} as to_address, count(*) as n
    from p group by all order by n desc, from_address nulls first, to_address nulls first limit {HEAVIEST}""", "tx")
def heaviest_pairs(src):
    """Callers and callees with most transactions, from stored addresses."""
    path = scratch(src.spark, "e8-pairs")
    pairs = parsed_tx(src, "from_address", "to_address")
    layout.append(pairs, path)
    return heavy.most_frequent(layout.read_table(src.spark, path, pairs.schema), ["from_address", "to_address"], HEAVIEST)


@query("e8_heaviest_methods", f"""with {S.TXJ} select case when j_input <> '0x' then substr(j_input, 1, 10) end as method_id, count(*) as n
    from p group by all order by n desc, method_id nulls first limit {HEAVIEST}""", "tx")
def heaviest_methods(src):
    """Selectors with most transactions; the tables of odd and even blocks are merged."""
    path = scratch(src.spark, "e8-methods")
    calls = parsed_tx(src, "method_id", "block_number")
    layout.append(calls, path)
    stored = layout.read_table(src.spark, path, calls.schema)
    odd = F.col("block_number") % 2 == 1
    parts = [heavy.counts(stored.where(side), ["method_id"]) for side in (odd, ~odd)]
    return heavy.most_frequent(stored, ["method_id"], HEAVIEST, heavy.merged(parts))


@query("e9_balance_by_address", """with d as (select from_address as address, case when removed then amount else -amount end as delta from transfers
    union all select to_address, case when removed then -amount else amount end from transfers)
    select address, cast(sum(delta) as varchar) as balance, count(*) as n from d group by address""", "transfers")
def balance_by_address(src):
    return balances(src.view("transfers"))


# Decimal digits of the lower part of an amount.
LOW_DIGITS = 19


def balances(transfers):
    """Balance per address; a removed log takes its change back. Both sides of a transfer
    come from one pass and are added up before the shuffle. Amounts are summed in two parts
    of which neither can overflow, so a balance is exact whatever its size."""
    amount = F.col("amount").cast("decimal(38,0)")
    change = F.when(F.col("removed"), -amount).otherwise(amount)
    sides = transfers.select(F.explode(F.array(
        F.struct(F.col("from_address").alias("address"), (-change).alias("delta")),
        F.struct(F.col("to_address").alias("address"), change.alias("delta")))).alias("s"))
    unit = F.lit("1" + "0" * LOW_DIGITS).cast("decimal(38,0)")
    low = F.pmod("s.delta", unit).cast(f"decimal({LOW_DIGITS},0)")
    high = ((F.col("s.delta") - low) / unit).cast("decimal(20,0)")
    summed = sides.groupBy("s.address").agg(
        F.sum(high).alias("high"), F.sum(low).alias("low"), F.count("s.delta").alias("known"), F.count(F.lit(1)).alias("n"))
    return summed.select("address", F.when(F.col("known") > 0, joined_up(F.col("high"), F.col("low"), unit)).alias("balance"), "n")


def joined_up(high, low, unit):
    """``high`` times ``unit`` plus ``low`` as text."""
    rest = F.pmod(low, unit).cast("decimal(38,0)")
    whole = (high + ((low - rest) / unit).cast("decimal(38,0)")).cast("decimal(38,0)")
    borrow = (whole < 0) & (rest > 0)
    size = F.abs(F.when(borrow, whole + 1).otherwise(whole)).cast("decimal(38,0)")
    part = F.when(borrow, unit - rest).otherwise(rest).cast("decimal(38,0)")
    digits = F.when(size == 0, part.cast("string")).otherwise(
        F.concat(size.cast("string"), F.lpad(part.cast("string"), LOW_DIGITS, "0")))
    return F.concat(F.when(whole < 0, "-").otherwise(""), digits)


def histogram_sql(rows: str, bounds, by: str = "") -> str:
    each = " union all ".join(
        [f"select {by} cast({b} as double) as le, count(*) filter (where v <= {b}) as cumulative, count(v) as count, "
         f"cast(sum(v) as varchar) as sum from r {'group by ' + by.strip(', ') if by else ''}" for b in bounds]
        + [f"select {by} null, count(v), count(v), cast(sum(v) as varchar) from r {'group by ' + by.strip(', ') if by else ''}"])
    return f"{rows} {each}"


@query("e10_histogram_buckets", histogram_sql(
    "with r as (select kafka_topic, block_height, count(*) as v from tx group by all)", metrics.TX_PER_BLOCK), "tx")
def histogram_buckets(src):
    per_block = src.view("tx").groupBy("kafka_topic", "block_height").agg(F.count(F.lit(1)).alias("v"))
    return metrics.histogram(per_block, "v", metrics.TX_PER_BLOCK).withColumn("sum", F.col("sum").cast("string"))


@query("e10_rpc_latency", histogram_sql(
    "with r as (select event_type as provider, cast(value as decimal(18,2)) as v from events)", metrics.RPC_LATENCY_MS, "provider, "))
def rpc_latency(src):
    calls = src.table("events").select(F.col("event_type").alias("provider"), F.col("value").cast("decimal(18,2)").alias("v"))
    return metrics.histogram(calls, "v", metrics.RPC_LATENCY_MS, ["provider"])


@query("e10_queue_wait", histogram_sql(
    "with r as (select cast(value as decimal(18,2)) as v from events)", metrics.QUEUE_WAIT_MS))
def queue_wait(src):
    return metrics.histogram(src.table("events").select(F.col("value").cast("decimal(18,2)").alias("v")), "v", metrics.QUEUE_WAIT_MS)


MICROS = "(epoch_us(kafka_timestamp) - epoch_us(lag(kafka_timestamp) over (partition by kafka_key order by kafka_timestamp)))"
INTERVAL_SQL = f"""i as (select kafka_key, kafka_timestamp as ts, kafka_offset,
    floor(({MICROS} + 5000) / 10000) / 100 as interval_sec from state)"""


def commit_times(src):
    return src.view("state").select("kafka_key", F.col("kafka_timestamp").alias("ts"), "kafka_offset")


@query("e10_commit_interval", histogram_sql(
    f"with {INTERVAL_SQL}, r as (select cast(interval_sec as decimal(18,2)) as v from i)", metrics.COMMIT_INTERVAL), "state")
def commit_interval_histogram(src):
    rows = metrics.intervals(commit_times(src), ["kafka_key"])
    return metrics.histogram(rows.select(F.col("interval_sec").cast("decimal(18,2)").alias("v")), "v", metrics.COMMIT_INTERVAL)


@query("e11_cost_by_provider", """with c as (select event_type as provider, cast(sum(cast(value as decimal(18,6))) as double) as total, count(*) as n
    from events group by 1) select provider, round(total, 2) as rpc_cost_sec, n as rpc_calls, round(total / n, 4) as avg_rpc_cost from c""")
def cost_by_provider(src):
    return metrics.cost_by_provider(src.table("events").select(
        F.col("event_type").alias("provider"), F.col("value").alias("cost")))


@query("e12_latest_state_by_key", f"""with {S.STATEJ} select kafka_key, arg_max(checkpoint_block, kafka_offset) as checkpoint_block,
    arg_max(run_id, kafka_offset) as run_id, arg_max(producer_pod_uid, kafka_offset) as producer_pod_uid from st group by 1""", "state")
def latest_state_by_key(src):
    return state.latest_value(state_table(src)).select("kafka_key", "checkpoint_block", "run_id", "producer_pod_uid")


LIFECYCLE_SQL = """f as (select *, row_number() over (partition by job, range_id order by seq) as k from range_events where kind in ('error', 'empty')),
    d as (select job, range_id, min(seq) filter (where kind = 'done') as done_at, arg_max(kind, seq) filter (where kind <> 'done') as last_kind from range_events group by all),
    o as (select job, range_id, seq as out_at from f where k = 4),
    c as (select f.job, f.range_id, count(*) as retry, arg_max(f.detail, f.seq) as last_error from f join d using (job, range_id)
        where k <= 4 and (done_at is null or seq < done_at) group by all),
    life as (select d.job, d.range_id, case when done_at is not null and (out_at is null or done_at < out_at) then 'DONE'
        when out_at is not null then 'FAILED' when last_kind in ('error', 'empty') then 'RETRYING'
        when last_kind = 'submitted' then 'INFLIGHT' else 'PLANNED' end as status, coalesce(retry, 0) as retry, last_error
        from d left join o using (job, range_id) left join c using (job, range_id))"""


@query("e15_range_status_counts", f"""with {LIFECYCLE_SQL} select job, count(*) filter (where status = 'INFLIGHT') as inflight,
    count(*) filter (where status = 'RETRYING') as retrying, count(*) filter (where status not in ('DONE', 'FAILED')) as active
    from life group by job""", "range_events")
def range_status_counts(src):
    return ranges.status_counts(ranges.lifecycle(src.view("range_events")))


@query("e16_shard_counts", "select kafka_partition % 2 as shard, count(*) as n, min(kafka_offset) as first_offset from logs group by 1", "logs")
def shard_counts(src):
    """Rows per shard when the Kafka partition is the sharding key."""
    return src.view("logs").groupBy((F.col("kafka_partition") % 2).alias("shard")).agg(
        F.count(F.lit(1)).alias("n"), F.min("kafka_offset").alias("first_offset"))
