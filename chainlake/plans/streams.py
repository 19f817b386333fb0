"""J: streaming, ranges, heads and resume decisions."""

from __future__ import annotations

from pyspark.sql import functions as F

from chainlake.functions import schemas
from chainlake.operators import heads, ordered, ranges, silver, state
from chainlake.plans import sqltext as S
from chainlake.plans.aggregates import LIFECYCLE_SQL
from chainlake.plans.common import state_table
from chainlake.plans.layouts import PRODUCER
from chainlake.plans.lookups import safe_sql
from chainlake.plans.registry import query
from chainlake.session import scratch
from chainlake.sources import segments, topics
from chainlake.streaming import atomic, jobs, stateful, timed

# Offsets in one file of a rate-limited source.
SPAN = 100_000

KEYED = "select kafka_key, kafka_offset, kafka_timestamp from state"


@query("j1_available_now", KEYED, "state")
def available_now(src):
    return jobs.appended(src.spark, src.stream("state").select("kafka_key", "kafka_offset", "kafka_timestamp"), "j1")


@query("j2_processing_trigger", KEYED, "state")
def processing_trigger(src):
    """A fixed trigger (a short one here, so that nobody waits), stopped once everything
    there is has been processed."""
    path = scratch(src.spark, "j2")
    rows = src.stream("state").select("kafka_key", "kafka_offset", "kafka_timestamp")
    running = jobs.start(rows, path, scratch(src.spark, "j2-checkpoint"), every="1 second")
    running.processAllAvailable()
    running.stop()
    return src.spark.read.schema(rows.schema).parquet(path)


def in_files(src, name, *columns):
    """A view written as a folder for each span of offsets, a file in each, with the schema
    to stream it."""
    path = scratch(src.spark, name)
    rows = src.view("state").select(*columns)
    spans = rows.withColumn("span", ordered.by_span("kafka_offset", SPAN))
    spans.repartition("span").write.partitionBy("span").parquet(path)
    return f"{path}/*", rows.schema.simpleString()[7:-1].replace(":", " ").replace(",", ", ")


@query("j3_rate_limit", f"""select count(distinct kafka_offset // {SPAN}) as batches, count(*) as n,
    count(distinct kafka_offset // {SPAN}) > 1 as all_within_one_file from state""", "state")
def rate_limit(src):
    """One file per trigger makes as many batches as there are files."""
    path, schema = in_files(src, "j3", "kafka_key", "kafka_offset")
    rows = topics.stream_source(src.spark, path=path, schema=schema, max_per_trigger=1)
    out = scratch(src.spark, "j3-out")
    atomic_rows = rows.withColumnRenamed("kafka_offset", "block_height")
    atomic.run(atomic_rows, out, scratch(src.spark, "j3-checkpoint"), PRODUCER)
    return atomic.commits(src.spark, out).agg(
        F.count(F.lit(1)).alias("batches"), F.sum("rows").alias("n"),
        (F.max("rows") < F.sum("rows")).alias("all_within_one_file"))


@query("j4_checkpoint_resume", "select kafka_key, kafka_offset from state", "state")
def checkpoint_resume(src):
    """A second run with the same checkpoint takes only what came after the first."""
    path, schema = scratch(src.spark, "j4"), "kafka_key string, kafka_offset bigint"
    out, checkpoint = scratch(src.spark, "j4-out"), scratch(src.spark, "j4-checkpoint")
    rows = src.view("state").select("kafka_key", "kafka_offset")
    for part in ("kafka_key like '%realtime'", "kafka_key not like '%realtime'"):
        rows.where(part).write.mode("append").parquet(path)
        stream = topics.stream_source(src.spark, path=path, schema=schema)
        stored = jobs.append(stream, out, checkpoint)
    return stored


COUNT_SQL = f"""c as (select block_height, {S.window_start('kafka_timestamp', 10)} as window_start, count(*) as cnt from tx group by all),
    w as (select block_height, window_start, window_start + interval 10 second as window_end, cnt from c)"""


@query("j5_tumbling_count", f"with {COUNT_SQL} select * from w", "tx")
def tumbling_count(src):
    return jobs.tumbling_count(src.view("tx"))


@query("j5_tumbling_processing_time", "select block_height, count(*) as cnt from tx group by 1", "tx")
def tumbling_processing_time(src):
    """Windows by arrival differ from run to run; their sums per block do not."""
    rows = src.stream("tx").select("block_height")
    stored = jobs.upsert_counts(rows, scratch(src.spark, "j5p"), scratch(src.spark, "j5p-checkpoint"), ts=None)
    return stored.groupBy("block_height").agg(F.sum("cnt").alias("cnt"))


@query("j5_event_time_append", f"""select kafka_key, {S.window_start('kafka_timestamp', 86400)} as window_start, count(*) as cnt
    from state group by all""", "state")
def event_time_append(src):
    """Files that each cover the whole time, one a batch: most rows of the later ones come
    behind the watermark. Windows appended, windows still open and late rows add up."""
    path = scratch(src.spark, "j5-files")
    rows = src.view("state").select("kafka_key", "kafka_offset", "kafka_timestamp")
    rows.withColumn("part", F.col("kafka_offset") % 5).repartition("part").write.partitionBy("part").parquet(path)
    stream = topics.stream_source(
        src.spark, path=f"{path}/*", schema="kafka_key string, kafka_offset bigint, kafka_timestamp timestamp", max_per_trigger=1)
    made = timed.append_windows(stream, ["kafka_key"], "kafka_timestamp", 86400, "2 days", scratch(src.spark, "j5"), scratch(src.spark, "j5-checkpoint"))
    day = F.window("kafka_timestamp", "1 day")["start"]
    late = made.late().groupBy("kafka_key", day.alias("window_start")).agg(F.count(F.lit(1)).alias("cnt"))
    counts = made.closed().unionByName(made.open()).drop("window_end").unionByName(late)
    return counts.groupBy("kafka_key", "window_start").agg(F.sum("cnt").alias("cnt"))


@query("j6_atomic_data_plus_state", "select block_height, kafka_offset, run_id from tx", "tx")
def atomic_data_plus_state(src):
    path = scratch(src.spark, "j6")
    rows = src.stream("tx").select("block_height", "kafka_offset", "run_id")
    atomic.run(rows, path, scratch(src.spark, "j6-checkpoint"), PRODUCER)
    return atomic.committed_rows(src.spark, path)


@query("j6_two_phase_sink", "select block_height, kafka_offset, run_id from tx", "tx")
def two_phase_sink(src):
    """Tasks write files, the driver makes those of a batch visible at once."""
    path = scratch(src.spark, "j6-two")
    rows = src.stream("tx").select("block_height", "kafka_offset", "run_id")
    writer = segments.registered(src.spark) and rows.writeStream.format("two_phase").option("path", path)
    writer.option("checkpointLocation", scratch(src.spark, "j6-two-checkpoint")).trigger(availableNow=True).start().awaitTermination()
    return segments.committed(src.spark, path, rows.schema)


@query("j7_progress_record", """select max(block_height) as checkpoint, min(block_height) as start_block, count(*) as rows,
    'uid-1' as pod_uid, 'checkpoint' as mode from tx""", "tx")
def progress_record(src):
    path = scratch(src.spark, "j7")
    atomic.run(src.stream("tx").select("block_height"), path, scratch(src.spark, "j7-checkpoint"), PRODUCER)
    record = F.from_json("record", schemas.struct(schemas.PROGRESS_RECORD))
    return atomic.commits(src.spark, path).select(record.alias("r"), "rows").agg(
        F.max("r.checkpoint").alias("checkpoint"), F.min("r.run.start_block").alias("start_block"),
        F.sum("rows").alias("rows"), F.max("r.producer.pod_uid").alias("pod_uid"), F.max("r.run.mode").alias("mode"))


SIZE = 7


@query("j8_plan_ranges_bounded", f"""with b as (select o_orderstatus as job, min(o_orderkey) as s, max(o_orderkey) as e, max(o_orderkey) - 10 as head
    from orders group by 1), r as (select job, e, least(e, head) as u, s, unnest(generate_series(s, least(e, head), {SIZE})) as x from b)
    select job, cast((x - s) // {SIZE} as bigint) as range_id, x as start_block, least(x + {SIZE} - 1, u) as end_block,
    least(x + {SIZE} - 1, u) >= e as exhausted from r""")
def plan_ranges_bounded(src):
    bounds = src.table("orders").groupBy(F.col("o_orderstatus").alias("job")).agg(
        F.min("o_orderkey").alias("start_block"), F.max("o_orderkey").alias("end_block"),
        (F.max("o_orderkey") - 10).alias("head"))
    return ranges.plan_bounded(bounds, SIZE, head="head")


TAILING_SQL = f"""with m as (select chain, seq, raw_block, max(raw_block) over (partition by chain order by seq rows between unbounded preceding and 1 preceding) as top from heads),
    f as (select *, coalesce(top, raw_block - 1) + 1 as first from m), g as (select * from f where raw_block >= first),
    n as (select *, cast(ceil((raw_block - first + 1) / {SIZE}) as bigint) as n from g),
    u as (select *, sum(n) over (partition by chain order by seq) as upto from n),
    x as (select *, unnest(generate_series(0, n - 1)) as i from u)
    select chain, seq, cast(upto - n + i as bigint) as range_id, first + i * {SIZE} as start_block,
    least(first + i * {SIZE} + {SIZE} - 1, raw_block) as end_block from x"""


@query("j9_plan_ranges_tailing", TAILING_SQL, "heads")
def plan_ranges_tailing(src):
    return ranges.plan_tailing(src.view("heads"), SIZE)


@query("j9_tailing_stream", TAILING_SQL, "heads")
def tailing_stream(src):
    rows = src.stream("heads").select("chain", "seq", "raw_block")
    return stateful.plan_tailing(rows, SIZE, scratch(src.spark, "j9"), scratch(src.spark, "j9-checkpoint"))


def safe_query(tolerance: int, jump: int) -> str:
    return f"with recursive {safe_sql(tolerance, jump)} select chain, seq, raw_block, safe_block from safe"


@query("j10_safe_head", safe_query(heads.TOLERANCE, heads.JUMP), "heads")
def safe_head(src):
    return heads.safe_head(src.view("heads").select("chain", "seq", "raw_block"))


@query("j10_safe_head_batch_provider", safe_query(heads.TOLERANCE, heads.BATCH_JUMP), "heads")
def safe_head_batch(src):
    return heads.safe_head(src.view("heads").select("chain", "seq", "raw_block"), jump=heads.BATCH_JUMP)


@query("j10_safe_head_stream", safe_query(heads.TOLERANCE, heads.JUMP), "heads")
def safe_head_stream(src):
    rows = src.stream("heads").select("chain", "seq", "raw_block")
    return stateful.safe_head(rows, scratch(src.spark, "j10"), scratch(src.spark, "j10-checkpoint"))


ARBITER_SQL = """with h as (select chain, seq, ts, case when source = 'ws' then raw_block end as w, case when source = 'ws' then ts end as wt,
    case when source = 'http' then raw_block end as p from heads),
    l as (select chain, seq, ts, last_value(w ignore nulls) over x as w, last_value(wt ignore nulls) over x as wt, last_value(p ignore nulls) over x as p
    from h window x as (partition by chain order by seq rows between unbounded preceding and current row)),
    c as (select *, coalesce(epoch_us(ts) - epoch_us(wt) <= 15000000, false) as fresh from l)
    select chain, seq, case when fresh then w else p end as candidate, case when fresh then 'ws' else 'http' end as used_source from c"""


@query("j11_head_source_arbiter", ARBITER_SQL, "heads")
def head_source_arbiter(src):
    return heads.arbitrate(src.view("heads"))


@query("j12_resume_plan", """with l as (select event_type as job, case when event_type = 'signup' then null else arg_max(event_id, ts) end as checkpoint
    from events group by event_type), h as (select chain as job, arg_max(raw_block, seq) as latest_block from heads group by chain)
    select h.job, coalesce(checkpoint + 1, latest_block) as start_block, case when checkpoint is null then 'chain_head' else 'checkpoint' end as resume_mode,
    coalesce(checkpoint, latest_block - 1) as overlap_start from h left join l using (job)""", "heads")
def resume_plan(src):
    last = src.table("events").groupBy(F.col("event_type").alias("job")).agg(F.max_by("event_id", "ts").alias("checkpoint"))
    known = last.withColumn("checkpoint", F.when(F.col("job") != "signup", F.col("checkpoint")))
    tops = src.view("heads").groupBy(F.col("chain").alias("job")).agg(F.max_by("raw_block", "seq").alias("latest_block"))
    return state.resume_plan(known, tops)


@query("j13_backfill_status", """with j as (select 'job-' || s_suppkey as job_name, s_suppkey * 10 as start_block from supplier),
    l as (select job_name, arg_max(status, kafka_offset) as status, arg_max(checkpoint, kafka_offset) as checkpoint,
    arg_max(range_end, kafka_offset) as range_end from backfills group by 1)
    select job_name, case when status = 'completed' then 'completed' when checkpoint >= range_end then 'inconsistent'
    when checkpoint is not null then 'resume' else 'new' end as decision,
    case when status = 'completed' or checkpoint >= range_end then null when checkpoint is not null then checkpoint + 1 else start_block end as next_block
    from j left join l using (job_name)""", "backfills")
def backfill_status(src):
    wanted = src.table("supplier").select(
        F.concat(F.lit("job-"), F.col("s_suppkey").cast("string")).alias("job_name"), (F.col("s_suppkey") * 10).alias("start_block"))
    return state.backfill_status(wanted, state.latest_value(src.view("backfills"), "job_name"))


@query("j14_backfill_bounds", f"""with {S.STATEJ}, l as (select *, string_split(replace(kafka_key, '_', ':'), ':') as k from st
    qualify row_number() over (partition by kafka_key order by kafka_offset desc) = 1),
    r as (select k[1] as chain, k[2] as entity, max(run_start_block) as head from l where k[3] = 'realtime' group by all),
    b as (select k[1] as chain, k[2] as entity, max(checkpoint_block) as done from l where k[3] = 'backfill' group by all)
    select chain, entity, coalesce(done, -1) + 1 as backfill_start, head - 1 as backfill_end from r left join b using (chain, entity)""", "state")
def backfill_bounds(src):
    return state.backfill_bounds(state_table(src))


@query("j15_range_lifecycle", f"with {LIFECYCLE_SQL} select * from life", "range_events")
def range_lifecycle(src):
    return ranges.lifecycle(src.view("range_events"))


@query("j15_lifecycle_stream", f"with {LIFECYCLE_SQL} select * from life", "range_events")
def lifecycle_stream(src):
    states = stateful.lifecycle(src.stream("range_events"))
    path = scratch(src.spark, "j15")

    def work(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    jobs.for_each(states, work, scratch(src.spark, "j15-checkpoint"), mode="update").awaitTermination()
    return ordered.latest(src.spark.read.parquet(path), ["job", "range_id"], "seq").drop("seq", "batch")


@query("j15_lifecycle_state", f"with {LIFECYCLE_SQL} select * from life", "range_events")
def lifecycle_state(src):
    """What the stream keeps per range, read from its state store."""
    path, checkpoint = scratch(src.spark, "j15"), scratch(src.spark, "j15-checkpoint")
    states = stateful.lifecycle(src.stream("range_events"))
    jobs.for_each(states, lambda batch, batch_id: batch.write.mode("overwrite").parquet(f"{path}/{batch_id}"), checkpoint, mode="update").awaitTermination()
    return timed.state_table(src.spark, checkpoint, "range")


# Seconds until a submitted range counts as failed, and how late events may come.
DEADLINE, LATENESS = 600, 3600

TIMED_SQL = f"""n as (select *, lead(ts) over (partition by job, range_id order by seq) as next_ts from timed_events),
    range_events as (select job, range_id, seq * 2 as seq, kind, detail from timed_events union all
    select job, range_id, seq * 2 + 1, 'timeout', 'timeout' from n where kind = 'submitted' and coalesce(next_ts >= ts + interval {DEADLINE} second,
    ts + interval {DEADLINE} second <= (select max(ts) from timed_events) - interval {LATENESS} second)),
    {LIFECYCLE_SQL.replace("('error', 'empty')", "('error', 'empty', 'timeout')")}"""


@query("j15_lifecycle_deadlines", f"with {TIMED_SQL} select * from life", "timed_events")
def lifecycle_deadlines(src):
    events = src.view("timed_events")
    until = events.select(F.max("ts") - F.make_dt_interval(secs=F.lit(LATENESS))).scalar()
    return ranges.lifecycle(ranges.with_timeouts(events, "ts", DEADLINE, until))


@query("j15_lifecycle_timers", f"with {TIMED_SQL} select * from life", "timed_events")
def lifecycle_timers(src):
    """The same from a stream: deadlines are timers, which go off as the watermark passes."""
    states = timed.timed_lifecycle(src.stream("timed_events"), "ts", DEADLINE, f"{LATENESS} seconds")
    path, checkpoint = scratch(src.spark, "j15t"), scratch(src.spark, "j15t-checkpoint")
    jobs.for_each(states, lambda batch, batch_id: batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}"), checkpoint, mode="update").awaitTermination()
    return ordered.latest(src.spark.read.parquet(path), ["job", "range_id"], "batch").drop("seq", "batch")


@query("j16_not_ready_retry", """select job, range_id, count(*) filter (where kind = 'empty') as empty_results from range_events
    group by all having arg_max(kind, seq) = 'empty' and not bool_or(kind = 'done')""", "range_events")
def not_ready_retry(src):
    return ranges.not_ready(src.view("range_events"))


@query("j17_fenced_writer", f"""with {S.STATEJ}, o as (select kafka_key, arg_max(producer_pod_uid, kafka_offset) as owner_uid from st
    where kafka_key like '%realtime' group by 1)
    select kafka_key, kafka_offset, coalesce(producer_pod_uid = owner_uid, true) as accepted from st left join o using (kafka_key)""", "state")
def fenced_writer(src):
    rows = state_table(src)
    owners = state.latest_value(rows.where("kafka_key like '%realtime'"))
    return state.fenced_updates(owners, rows).select("kafka_key", "kafka_offset", "accepted")


@query("j18_stream_progress", "select count(*) as n, 1::bigint as sources from state", "state")
def stream_progress(src):
    """The progress rows of a finished query add up to its input."""
    out, checkpoint = scratch(src.spark, "j18"), scratch(src.spark, "j18-checkpoint")
    run = lambda: jobs.start(src.stream("state"), out, checkpoint)
    rows = jobs.recorded(src.spark, run, scratch(src.spark, "j18-progress"))
    return rows.agg(F.sum("rows").alias("n"), F.countDistinct("source").alias("sources"))


@query("j19_continuous_view", f"""with {S.TXJ} select 'normalized_transaction_' || j_hash || '_' || {S.u64('j_transactionindex')} as id,
    block_height as block_number, {S.kind('j_to', 'j_input')} as tx_kind from p""", "tx")
def continuous_view(src):
    """Two hops: a raw copy of the topic, then the narrow form of what arrived there."""
    first, second = scratch(src.spark, "j19-raw"), scratch(src.spark, "j19")
    raw = jobs.append(src.stream("tx"), first, scratch(src.spark, "j19-raw-checkpoint"))
    arrived = src.spark.readStream.schema(raw.schema).parquet(first)
    slim = silver.normalized_tx(arrived).select("id", "block_number", "tx_kind")
    return jobs.append(slim, second, scratch(src.spark, "j19-checkpoint"))
