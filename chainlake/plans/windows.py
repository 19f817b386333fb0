"""F, G, H: window functions, sorts, set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from chainlake.functions import schemas
from chainlake.operators import bronze, forks, metrics, ordered, quality, ranges, silver, state
from chainlake.plans import sqltext as S
from chainlake.plans.aggregates import INTERVAL_SQL, commit_times
from chainlake.plans.common import state_table
from chainlake.plans.registry import query
from chainlake.session import scratch
from chainlake.streaming import jobs, timed


@query("f1_latest_per_key", f"""with {S.STATEJ} select kafka_key, run_id, checkpoint_block, kafka_offset, kafka_timestamp from st
    qualify row_number() over (partition by kafka_key order by kafka_offset desc) = 1""", "state")
def latest_per_key(src):
    return ordered.latest(state_table(src), ["kafka_key"], "kafka_offset").select(
        "kafka_key", "run_id", "checkpoint_block", "kafka_offset", "kafka_timestamp")


RANKED_SQL = f"""{S.STATEJ}, k as (select *, string_split(replace(kafka_key, '_', ':'), ':') as parts,
    row_number() over (partition by kafka_key order by checkpoint_block desc, kafka_timestamp desc, run_id desc) as rn from st),
    v as (select parts[1] as chain, parts[2] as ingestion_entity, parts[3] as ingestion_type, run_mode, run_start_block as run_start,
    checkpoint_block as run_end, producer_pod_name, run_id, kafka_timestamp, kafka_key, rn from k)"""


@query("f2_ranked_history", f"with {RANKED_SQL} select * from v", "state")
def ranked_history(src):
    return state.ranked_history(state_table(src)).orderBy("kafka_key", "rn")


@query("f2_latest_run", f"with {RANKED_SQL} select kafka_key, run_id, run_end from v where rn = 1", "state")
def latest_run(src):
    return state.latest_run(state_table(src)).select("kafka_key", "run_id", F.col("checkpoint_block").alias("run_end"))


@query("f3_commit_frontier", """with ids as (select job, range_id, max(end_block) as end_block from finished group by all),
    n as (select *, row_number() over (partition by job order by range_id) - 1 as k from ids)
    select job, count(*) filter (where range_id = k) as blocked_by, max(end_block) filter (where range_id = k) as frontier_block,
    count(*) filter (where range_id = k) as committed, count(*) filter (where range_id <> k) as held_back from n group by job""", "finished")
def commit_frontier(src):
    return ranges.commit_frontier(src.view("finished"))


@query("f4_block_ordinal", f"""with {S.LOGJ} select kafka_offset, block_number, row_number() over (partition by block_number
    order by log_index, kafka_partition, kafka_offset) - 1 as ordinal from lg where block_number is not null""", "logs")
def block_ordinal(src):
    items = bronze.usable_logs(src.view("logs"), "kafka_partition", "kafka_offset")
    return bronze.block_ordinal(items).select("kafka_offset", "block_number", "ordinal")


@query("f5_gap_detect", """with h as (select distinct l_orderkey as height from lineitem),
    n as (select height, lead(height) over (order by height) as next from h)
    select 'bsc' as chain, height + 1 as gap_start, next - 1 as gap_end, next - height - 1 as missing from n where next > height + 1""")
def gap_detect(src):
    return quality.gaps(src.table("lineitem").select(F.lit("bsc").alias("chain"), F.col("l_orderkey").alias("height")))


@query("f6_commit_interval", f"with {INTERVAL_SQL} select kafka_key, ts, interval_sec from i", "state")
def commit_interval(src):
    return metrics.intervals(commit_times(src), ["kafka_key"]).select("kafka_key", "ts", "interval_sec")


def delivered(src):
    """All deliveries of block headers, repeated heights included."""
    fields = schemas.only(schemas.BLOCK_JSON, "hash", "parentHash", "number")
    rows = src.view("blocks").unionByName(src.view("redelivered"))
    b = silver.parse(rows, ["kafka_offset"], fields, "hash")
    return b.select(F.lit("bsc").alias("chain"), "number", "hash", F.col("parentHash").alias("parent_hash"), "kafka_offset")


DELIVERED_SQL = """b as (select 'bsc' as chain, cast(json_extract_string(raw, '$.number') as bigint) as number,
    json_extract_string(raw, '$.hash') as hash, json_extract_string(raw, '$.parentHash') as parent_hash, kafka_offset
    from (select * from blocks union all select * from redelivered)),
    c as (select * from b qualify row_number() over (partition by chain, number order by kafka_offset desc) = 1)"""


@query("f7_reorg_detect", f"""with {DELIVERED_SQL} select c.chain, c.number, c.hash, c.parent_hash, p.hash as expected_parent,
    c.number - 1 as rollback_to from c join c p on p.number = c.number - 1 where c.parent_hash <> p.hash""", ("blocks", "redelivered"))
def reorg_detect(src):
    return quality.reorgs(delivered(src))


FORKS_SQL = """with recursive b as (select number, hash, arg_max(parent_hash, kafka_offset) as parent, max(kafka_offset) as seen
    from (select * from trunk union all select * from branches union all select * from twigs) group by number, hash),
    h as (select number from b group by number having count(*) > 1),
    c as (select * from b where number in (select number from h) or number - 1 in (select number from h)),
    up as (select hash, number, seen, hash as node, number as node_number, parent as next from c
    union all select u.hash, u.number, u.seen, c.hash, c.number, c.parent from up u join c on c.hash = u.next and c.number = u.node_number - 1),
    best as (select node as hash, node_number as number, max(number::hugeint * 1000000000000000 + seen) as best from up group by all),
    roots as (select u.hash, u.number, u.next as root, u.node_number - 1 as root_number from up u left join c on c.hash = u.next and c.number = u.node_number - 1
    where c.hash is null),
    tops as (select root, root_number, max(best) as top from roots join best using (hash, number) group by all),
    o as (select c.hash, c.number, c.parent from c join roots using (hash, number) join best using (hash, number) join tops using (root, root_number)
    where best <> top),
    path as (select hash, number, hash as node, number as node_number, parent as next from o
    union all select p.hash, p.number, o.hash, o.number, o.parent from path p join o on o.hash = p.next and o.number = p.node_number - 1),
    ends as (select p.hash, p.number, p.node as first_hash, p.node_number - 1 as ancestor_number, p.next as ancestor_hash
    from path p left join o on o.hash = p.next and o.number = p.node_number - 1 where o.hash is null)
    select 'bsc' as chain, first_hash, ancestor_number, ancestor_hash, (ancestor_hash, ancestor_number) in (select (hash, number) from b) as ancestor_known,
    max(number) - ancestor_number as depth, count(*) as orphans, string_agg(hash, '|' order by number, hash) as orphaned from ends
    group by first_hash, ancestor_number, ancestor_hash"""


@query("f7_fork_resolution", FORKS_SQL, ("trunk", "branches", "twigs"))
def fork_resolution(src):
    return forks.forks(src.view("trunk").unionByName(src.view("branches")).unionByName(src.view("twigs")))


@query("f8_dedup_events", f"""with {DELIVERED_SQL} select 'by_hash' as policy, chain, number, hash, min(kafka_offset) as kafka_offset
    from b group by all union all select 'by_height', chain, number, arg_min(hash, kafka_offset), min(kafka_offset) from b group by chain, number""",
       ("blocks", "redelivered"))
def dedup_events(src):
    rows = delivered(src).drop("parent_hash")
    by_hash = quality.dedup(rows, ["chain", "number", "hash"]).withColumn("policy", F.lit("by_hash"))
    by_height = quality.dedup(rows, ["chain", "number"]).withColumn("policy", F.lit("by_height"))
    return by_hash.unionByName(by_height)


@query("f8_dedup_duplicates", f"""with {S.TXJ} select block_height, j_blockhash as block_hash, min(kafka_offset) as kafka_offset
    from p group by all""", "tx")
def dedup_duplicates(src):
    tx = silver.parse_tx(src.view("tx"), ["block_height", "kafka_offset"], "hash", "blockHash")
    rows = tx.select("block_height", F.col("blockHash").alias("block_hash"), "kafka_offset")
    return quality.dedup(rows, ["block_height", "block_hash"])


@query("f8_dedup_stream", "select distinct block_height from tx", "tx")
def dedup_stream(src):
    rows = src.stream("tx").select("block_height", "kafka_offset")
    path, checkpoint = scratch(src.spark, "f8"), scratch(src.spark, "f8-checkpoint")
    return jobs.append_new(rows, path, checkpoint, ["block_height"], "kafka_offset").select("block_height")


@query("f8_dedup_stream_state", "select block_height, min(kafka_offset) as kafka_offset from tx group by 1", "tx")
def dedup_stream_state(src):
    """Keys of the last hour are known to the state store; only others are sought in the table."""
    rows = src.stream("tx").select("block_height", "kafka_offset")
    path, checkpoint = scratch(src.spark, "f8s"), scratch(src.spark, "f8s-checkpoint")
    return timed.append_new_with_state(rows, path, checkpoint, ["block_height"], "kafka_offset", 3600).select("block_height", "kafka_offset")


@query("g1_order_state", f"with {RANKED_SQL} select kafka_key, rn, run_id from v order by kafka_key, rn", "state")
def order_state(src):
    return state.ranked_history(state_table(src)).select("kafka_key", "rn", "run_id").orderBy("kafka_key", "rn")


@query("g2_top_snapshots", "select kafka_offset, kafka_key, kafka_timestamp from state order by kafka_timestamp desc, kafka_offset limit 10", "state")
def top_snapshots(src):
    return src.view("state").select("kafka_offset", "kafka_key", "kafka_timestamp").orderBy(
        F.col("kafka_timestamp").desc(), "kafka_offset").limit(10)


@query("g3_deterministic_batch_order", "select distinct job, range_id, start_block, end_block from finished", "finished")
def deterministic_batch_order(src):
    return ranges.emit_order(src.view("finished").distinct())


@query("h1_union_live_history", f"""with {S.TXJ}, f as (select min(block_height) as first_live from tx where job_name = 'bsc_realtime_transactions'),
    u as (select * from p where job_name = 'bsc_realtime_transactions' union all select p.* from p, f where block_height < first_live)
    select j_hash as tx_hash, job_name, kafka_offset from u
    qualify row_number() over (partition by j_hash order by kafka_offset) = 1""", "tx")
def union_live_history(src):
    both = state.live_with_history(src.view("tx"), "bsc_realtime_transactions")
    tx = silver.parse_tx(both, ["job_name", "kafka_offset"], "hash").withColumnRenamed("hash", "tx_hash")
    return quality.dedup(tx, ["tx_hash"]).select("tx_hash", "job_name", "kafka_offset")


@query("h2_missing_rows", "select kafka_partition, kafka_offset from tx where not json_valid(raw)", "tx")
def missing_rows(src):
    """Bronze rows that did not reach silver."""
    rows = src.view("tx")
    return quality.missing_rows(rows, silver.parse_tx(rows, ["kafka_partition", "kafka_offset"], "hash"),
                                ["kafka_partition", "kafka_offset"])
