"""L: metric queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from chainlake.operators import metrics
from chainlake.plans.aggregates import INTERVAL_SQL, commit_times
from chainlake.plans.registry import query

COUNTERS = ("ingestion_tx_total", "rpc_submitted_total", "kafka_transaction_failed_total")
IN_COUNTERS = "metric in ('" + "', '".join(COUNTERS) + "')"


def samples(src):
    """Samples in long form, their labels as a map, read back as columns."""
    rows = src.view("metrics")
    labels = F.create_map(*[x for n in ("chain", "job", "provider") for x in (F.lit(n), F.col(n))])
    return metrics.series(rows.select("ts", "metric", labels.alias("labels"), "value"))


def delta(where: str) -> str:
    return f"""p as (select *, lag(value) over (partition by metric, chain, job, provider order by ts) as prev from metrics where {where}),
    d as (select *, coalesce(case when value < prev then value else value - prev end, 0) as delta from p)"""


@query("l1_counter_rate", f"""with {delta(IN_COUNTERS)} select date_trunc('hour', ts) as window_start, metric, chain,
    sum(delta) as increase, sum(delta) / 3600 as rate from d group by all""", "metrics")
def counter_rate(src):
    rows = samples(src).where(F.col("metric").isin(*COUNTERS))
    return metrics.rate(rows, "1 hour", 3600, ["metric", "chain"])


@query("l2_sum_rate_by", f"""with {delta("metric = 'rpc_submitted_total'")} select date_trunc('hour', ts) as window_start, provider,
    sum(delta) as increase, sum(delta) / 3600 as rate from d group by all""", "metrics")
def sum_rate_by(src):
    rows = samples(src).where("metric = 'rpc_submitted_total'")
    return metrics.rate(rows, "1 hour", 3600, ["provider"])


@query("l3_counter_increase", f"""with {delta("metric = 'kafka_transaction_failed_total'")} select
    TIMESTAMP '1970-01-01' + to_seconds(cast(floor(epoch(ts) / 900) * 900 as bigint)) as window_start, chain, sum(delta) as increase
    from d group by all""", "metrics")
def counter_increase(src):
    return metrics.increase(samples(src).where("metric = 'kafka_transaction_failed_total'"), "15 minutes", ["chain"])


@query("l4_last_over_time", """select TIMESTAMP '1970-01-01' + to_seconds(cast(floor(epoch(ts) / 30) * 30 as bigint)) as window_start,
    metric, chain, job, provider, arg_max(value, ts) as value from metrics where metric = 'ingestion_tx_total' group by all""", "metrics")
def last_over_time(src):
    return metrics.last_over_time(samples(src).where("metric = 'ingestion_tx_total'"), "30 seconds")


@query("l5_max_lag", """select job, max(value) as max_lag from metrics where metric = 'ingestion_checkpoint_lag'
    and regexp_matches(chain, '^b.c$') group by job""", "metrics")
def max_lag(src):
    rows = samples(src).where((F.col("metric") == "ingestion_checkpoint_lag") & F.col("chain").rlike("^b.c$"))
    return rows.groupBy("job").agg(F.max("value").alias("max_lag"))


@query("l6_threshold_status", """select ts, provider, value, case when value >= 100 then 'red' when value >= 20 then 'orange'
    when value >= 5 then 'yellow' else 'green' end as lag_level, case when value >= 34 then '#BA43A9' when value >= 21 then '#1F78C1'
    when value >= 13 then '#E24D42' when value >= 8 then '#EF843C' when value >= 5 then '#EAB839' when value >= 3 then '#6ED0E0'
    else 'green' end as interval_level from metrics where metric = 'ingestion_checkpoint_lag'""", "metrics")
def threshold_status(src):
    rows = samples(src).where("metric = 'ingestion_checkpoint_lag'")
    return rows.select("ts", "provider", "value", metrics.level(F.col("value")).alias("lag_level"),
                       metrics.level(F.col("value"), metrics.INTERVAL_LEVELS).alias("interval_level"))


@query("l7_commit_interval_max", f"""with {INTERVAL_SQL}, l as (select kafka_key, arg_max(interval_sec, ts) as latest from i group by 1)
    select max(latest) as commit_interval_max, count(*) as keys from l""", "state")
def commit_interval_max(src):
    rows = metrics.intervals(commit_times(src), ["kafka_key"])
    last = rows.groupBy("kafka_key").agg(F.max_by("interval_sec", "ts").alias("latest"))
    return last.agg(F.max("latest").alias("commit_interval_max"), F.count(F.lit(1)).alias("keys"))


@query("l8_backlog", """with l as (select metric, chain, job, provider, arg_max(value, ts) as value from metrics
    where metric in ('rpc_submitted_total', 'rpc_finished_total') group by all)
    select chain, job, sum(value) filter (where metric = 'rpc_submitted_total') as submitted,
    sum(value) filter (where metric = 'rpc_finished_total') as finished,
    coalesce(sum(value) filter (where metric = 'rpc_submitted_total'), 0) - coalesce(sum(value) filter (where metric = 'rpc_finished_total'), 0) as backlog
    from l group by chain, job""", "metrics")
def backlog(src):
    return metrics.backlog(samples(src), "rpc_submitted_total", "rpc_finished_total", ["chain", "job"])


@query("l9_commit_overhead_ratio", """with i as (select event_id, event_type as job, value / 1000 as cost,
    floor((epoch_us(ts) - epoch_us(lag(ts) over (partition by event_type order by ts)) + 5000) / 10000) / 100 as interval_sec from events)
    select event_id, job, interval_sec, case when interval_sec <> 0 then cost / interval_sec end as overhead from i""")
def commit_overhead_ratio(src):
    commits = src.table("events").select(
        "event_id", F.col("event_type").alias("job"), F.col("ts").cast("timestamp").alias("ts"), (F.col("value") / 1000).alias("cost"))
    rows = metrics.intervals(commits, ["job"])
    return rows.select("event_id", "job", "interval_sec",
                       F.try_divide("cost", "interval_sec").alias("overhead"))


@query("l10_gauge_latest", """select metric, chain, job, provider, arg_max(value, ts) as value from metrics
    where metric = 'ingestion_checkpoint_lag' group by all""", "metrics")
def gauge_latest(src):
    return metrics.latest_value(samples(src).where("metric = 'ingestion_checkpoint_lag'"))


@query("l11_ingest_vs_commit", """with l as (select metric, chain, job, provider, arg_max(value, ts) as value from metrics group by all)
    select chain, job, sum(value) filter (where metric = 'ingestion_tx_total') as processed,
    sum(value) filter (where metric = 'committed_tx_total') as committed from l group by chain, job""", "metrics")
def ingest_vs_commit(src):
    last = metrics.latest_value(samples(src))
    return last.groupBy("chain", "job").agg(
        F.sum(F.when(F.col("metric") == "ingestion_tx_total", F.col("value"))).alias("processed"),
        F.sum(F.when(F.col("metric") == "committed_tx_total", F.col("value"))).alias("committed"))
