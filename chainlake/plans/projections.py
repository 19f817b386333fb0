"""C: projections, filters, predicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from chainlake.functions import schemas
from chainlake.operators import bronze, silver, state
from chainlake.plans import sqltext as S
from chainlake.plans.common import log_wire, tx_wire
from chainlake.plans.registry import query
from chainlake.sources import topics

COORD = "kafka_topic, kafka_partition, kafka_offset, kafka_timestamp"


@query("c1_flatten_struct", f"""select block_height, job_name, run_id, inserted_at, raw, {COORD},
    cast(cast(kafka_timestamp as date) as varchar) as kafka_date,
    block_height || '-' || kafka_offset as kafka_key from logs""", "logs")
def flatten_struct(src):
    return topics.decode_records(log_wire(src.view("logs")), schemas.RAW_RECORD_DATED)


@query("c2_bronze_logs_project", f"""select block_height, job_name, run_id,
    strptime(inserted_at, '%Y-%m-%dT%H:%M:%S.%gZ') as inserted_at, substr(inserted_at, 1, 10) as inserted_date, raw, {COORD}
    from logs""", "logs")
def bronze_logs_project(src):
    return bronze.bronze_logs(topics.decode_records(log_wire(src.view("logs")), schemas.RAW_RECORD_DATED))


@query("c3_bronze_tx_project", f"""select block_height, job_name, run_id, raw, {COORD},
    cast(cast(kafka_timestamp as date) as varchar) as kafka_date from tx""", "tx")
def bronze_tx_project(src):
    return bronze.bronze_tx(topics.decode_records(tx_wire(src.view("tx")), schemas.RAW_RECORD))


@query("c4_drop_unparsed", f"with {S.TXJ} select block_height, kafka_offset, j_hash as tx_hash from p", "tx")
def drop_unparsed(src):
    tx = silver.parse_tx(src.view("tx"), ["block_height", "kafka_offset"], "hash")
    return tx.withColumnRenamed("hash", "tx_hash")


# What the silver table holds: partition 2 lags behind the others.
STORED = "job_name = 'bsc_backfill_transactions' and (kafka_partition <> 2 or block_height < 500)"


@query("c5_incremental_filter", f"""with m as (select kafka_topic, kafka_partition, max(kafka_offset) as mark from tx
    where {STORED} group by all) select tx.block_height, tx.kafka_partition, tx.kafka_offset, tx.run_id
    from tx left join m using (kafka_topic, kafka_partition) where kafka_offset > coalesce(mark, -1)""", "tx")
def incremental_filter(src):
    rows = src.view("tx")
    fresh = state.increment(rows, rows.where(STORED))
    return fresh.select("block_height", "kafka_partition", "kafka_offset", "run_id")


@query("c6_block_range_scan", "select block_height, kafka_offset, job_name from tx where block_height between 100 and 1000000000", "tx")
def block_range_scan(src):
    return src.view("tx").where(F.col("block_height").between(100, 1_000_000_000)).select(
        "block_height", "kafka_offset", "job_name")


@query("c7_trace_run", "select block_height, kafka_partition, kafka_offset, job_name from tx where run_id = 'run-3' order by block_height", "tx")
def trace_run(src):
    return src.view("tx").where("run_id = 'run-3'").select(
        "block_height", "kafka_partition", "kafka_offset", "job_name").orderBy("block_height", "kafka_offset")


@query("c8_block_lookup", f"""with {S.TXJ} select block_height as block_number, cast({S.long('j_transactionindex')} as integer) as tx_index,
    j_hash as tx_hash, {S.kind('j_to', 'j_input')} as tx_kind from p where block_height = 77""", "tx")
def block_lookup(src):
    tx = silver.enriched_tx(src.view("tx").where("block_height = 77"))
    return tx.select("block_number", "tx_index", "tx_hash", "tx_kind").orderBy("tx_index", "tx_hash")


@query("c9_sample_rows", """select block_height, kafka_partition, kafka_offset, raw from tx
    order by kafka_partition, kafka_offset limit 10""", "tx")
def sample_rows(src):
    return src.view("tx").select("block_height", "kafka_partition", "kafka_offset", "raw").orderBy(
        "kafka_partition", "kafka_offset").limit(10)


@query("c10_backfill_complement", """select block_height, kafka_offset, job_name from tx where block_height <
    (select min(block_height) from tx where job_name = 'bsc_realtime_transactions')""", "tx")
def backfill_complement(src):
    rows = src.view("tx")
    older = state.history_below(rows, rows.where("job_name = 'bsc_realtime_transactions'"))
    return older.select("block_height", "kafka_offset", "job_name")


@query("c11_drop_null_block", f"with {S.LOGJ} select kafka_offset, block_number, log_index from lg where block_number is not null", "logs")
def drop_null_block(src):
    return bronze.usable_logs(src.view("logs"), "kafka_offset")
