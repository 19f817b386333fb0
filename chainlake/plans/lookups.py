"""D: joins and merges."""

from __future__ import annotations

from pyspark.sql import functions as F

from chainlake.functions import hexnum as H
from chainlake.operators import heads, layout, lookup, metrics, quality, silver, state
from chainlake.plans import sqltext as S
from chainlake.plans.common import parsed_logs, parsed_tx, state_table
from chainlake.plans.registry import query
from chainlake.session import scratch


@query("d1_merge_upsert", f"""with {S.STATEJ}, target as (select * from st where run_mode = 'checkpoint'
    qualify row_number() over (partition by kafka_key, run_id order by kafka_offset) = 1),
    updates as (select * from st qualify row_number() over (partition by kafka_key order by kafka_offset desc) = 1)
    select kafka_key, run_id, checkpoint_block, producer_pod_uid, kafka_offset
    from (select * from target union all select * from updates)
    qualify row_number() over (partition by kafka_key, run_id order by kafka_offset desc) = 1""", "state")
def merge_upsert(src):
    """The target holds old rows; the newest row of each key updates or extends it."""
    rows = state_table(src)
    target = quality.dedup(rows.where("run_mode = 'checkpoint'"), state.STATE_KEYS)
    updates = state.latest_value(rows)
    merged = state.merge_upsert(target, updates)
    return merged.select("kafka_key", "run_id", "checkpoint_block", "producer_pod_uid", "kafka_offset")


@query("d2_block_by_time", """with lo as (select block_ts, max(block_number) as n from headers group by block_ts),
    hi as (select block_ts, min(block_number) as n from headers group by block_ts)
    select e.event_id as lookup_id, lo.n as block_before, hi.n as block_after from events e
    asof left join lo on e.ts >= lo.block_ts asof left join hi on e.ts <= hi.block_ts""", "headers")
def block_by_time(src):
    asked = src.table("events").select(
        F.lit("bsc").alias("chain"), F.col("event_id").alias("lookup_id"), F.col("ts").cast("timestamp").alias("at"))
    return lookup.block_at_time(asked, src.view("headers")).select("lookup_id", "block_before", "block_after")


def date_sql(end: str) -> str:
    return f"""with r as (select distinct cast(ts as date) as start_date, cast(cast(ts as date) + interval 1 day as date) as end_date from events),
    f as (select r.*, (select min(block_number) from headers where block_ts >= start_date and block_ts < end_date + interval 1 day) as start_block,
    (select max(block_number) from headers where block_ts >= start_date and block_ts {end} end_date + interval 1 day) as end_block from r)
    select cast(start_date as varchar) as start_date, cast(end_date as varchar) as end_date, start_block, end_block,
    coalesce(start_block <= end_block, false) as valid from f"""


def requested(src):
    day = F.to_date("ts")
    return src.table("events").select(day.alias("start_date"), F.date_add(day, 1).alias("end_date"))


@query("d3_date_to_block_range", date_sql("<"), "headers")
def date_to_block_range(src):
    return lookup.date_to_blocks(requested(src), src.view("headers"))


@query("d3_date_to_block_range_inclusive", date_sql("<="), "headers")
def date_to_block_range_inclusive(src):
    return lookup.date_to_blocks(requested(src), src.view("headers"), midnight_belongs_to_both=True)


@query("d4_entity_enrich", f"""with {S.TXJ}, {S.LOGJ} select p.j_hash as tx_hash, p.block_height as block_number,
    {S.kind('p.j_to', 'p.j_input')} as tx_kind, lg.log_index, lg.j_address as log_address, headers.block_ts
    from p left join lg on lg.j_transactionhash = p.j_hash left join headers on headers.block_number = p.block_height""",
       ("tx", "logs", "headers"))
def entity_enrich(src):
    logs = parsed_logs(src, "transaction_hash", "log_index", "log_address")
    txs = parsed_tx(src, "tx_hash", "block_number", "tx_kind")
    blocks = src.view("headers").select("block_number", "block_ts")
    return lookup.enrich(logs, txs, blocks)


@query("d5_empty_range_check", f"""with {S.TXJ}, {S.LOGJ}, t as (select block_height as block_number, count(*) as n_tx from p group by 1),
    l as (select block_number, count(*) as n_logs from lg group by 1),
    c as (select h.block_number, coalesce(n_tx, 0) as n_tx, coalesce(n_logs, 0) as n_logs from headers h
    left join t using (block_number) left join l using (block_number))
    select *, case when n_logs > 0 then 'has_logs' when n_tx = 0 then 'empty_ok' else 'suspect' end as status from c""",
       ("tx", "logs", "headers"))
def empty_range_check(src):
    return quality.empty_blocks(src.view("headers"), parsed_tx(src, "block_number"), parsed_logs(src, "block_number"))


# Blocks in a bucket of the stored table of the replay.
REPLAY_BUCKET = 1_000


@query("d6_incremental_antijoin", f"""with {S.TXJ}, k as (select block_height, j_blockhash as block_hash,
    cast({S.long('j_transactionindex')} as integer) as tx_index, job_name, kafka_offset from p),
    fresh as (select * from k qualify row_number() over (partition by block_height, block_hash, tx_index order by kafka_offset) = 1)
    select * exclude job_name from fresh where not exists (select 1 from k where k.job_name = 'bsc_backfill_transactions'
    and k.block_height = fresh.block_height and k.block_hash = fresh.block_hash and k.tx_index = fresh.tx_index)""", "tx")
def incremental_antijoin(src):
    """A replay of everything adds only what the backfill has not stored in its block buckets."""
    tx = silver.parse_tx(src.view("tx"), ["block_height", "job_name", "kafka_offset"], "hash", "blockHash", "transactionIndex")
    rows = tx.select("block_height", F.col("blockHash").alias("block_hash"),
                     H.hex_to_int(F.col("transactionIndex")).alias("tx_index"), "job_name", "kafka_offset")
    replay = layout.with_block_bucket(rows.drop("job_name"), "block_height", REPLAY_BUCKET)
    backfill = layout.with_block_bucket(rows.where("job_name = 'bsc_backfill_transactions'"), "block_height", REPLAY_BUCKET)
    path = scratch(src.spark, "d6")
    layout.write_partitioned(backfill, path, ["block_bucket"])
    stored = layout.read_table(src.spark, path, backfill.schema)
    fresh = quality.not_yet_stored(replay, stored, ["block_height", "block_hash", "tx_index"], "block_bucket")
    return fresh.drop("block_bucket")


# One step per observation; ranks replace sequence numbers so that steps can be followed.
def safe_sql(tolerance: int, jump: int) -> str:
    return (
        "ranked as (select chain, seq, raw_block, row_number() over (partition by chain order by seq) as r from heads), "
        "safe as (select chain, seq, raw_block, r, raw_block as safe_block from ranked where r = 1 union all "
        "select n.chain, n.seq, n.raw_block, n.r, case "
        f"when n.raw_block < s.safe_block - {tolerance} then s.safe_block "
        f"when n.raw_block > s.safe_block + {jump} then s.safe_block + {jump} else n.raw_block end "
        "from safe s join ranked n on n.chain = s.chain and n.r = s.r + 1)"
    )


@query("d7_lag_vs_head", f"""with recursive {safe_sql(5, 100)}, h as (select chain, arg_max(safe_block, r) as safe_block,
    arg_max(raw_block, r) as raw_block from safe group by chain),
    c as (select event_type as chain, max(event_id - user_id) as checkpoint from events group by 1)
    select chain, checkpoint, greatest(0, safe_block - checkpoint) as lag, greatest(0, raw_block - checkpoint) as lag_raw
    from c left join h using (chain)""", "heads")
def lag_vs_head(src):
    seen = heads.safe_head(src.view("heads").select("chain", "seq", "raw_block"))
    last = seen.groupBy("chain").agg(
        F.max_by("safe_block", "seq").alias("safe_block"), F.max_by("raw_block", "seq").alias("raw_block"))
    done = src.table("events").groupBy(F.col("event_type").alias("chain")).agg(
        F.max(F.col("event_id") - F.col("user_id")).alias("checkpoint"))
    return metrics.lag_vs_head(done, last, ["chain"])
