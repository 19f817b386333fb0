"""A: sources, wire format, sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from chainlake.functions import schemas
from chainlake.operators import bronze, conversations, layout, ordered, records
from chainlake.plans import sqltext as S
from chainlake.plans.common import log_wire, tx_wire
from chainlake.plans.registry import query
from chainlake.session import scratch
from chainlake.sources import segments, topics
from chainlake.streaming import jobs

KEY = "cast(block_height as varchar) || '-' || cast(kafka_offset as varchar) as kafka_key"
COORD = "kafka_topic, kafka_partition, kafka_offset, kafka_timestamp"
RECORD = (
    "json_object('block_height', block_height, 'job_name', job_name, 'run_id', run_id, 'raw', raw)"
)


@query("a1_stream_source", f"select {KEY}, {COORD}, strlen({RECORD}::varchar) + 5 as value_bytes from tx", "tx")
def stream_source(src):
    rows = tx_wire(src.stream("tx"))
    out = rows.select(*topics.kafka_metadata()[:-1], F.length("value").cast("bigint").alias("value_bytes"))
    return jobs.append(out, scratch(src.spark, "a1"), scratch(src.spark, "a1-checkpoint"))


@query("a2_bounded_source", """select kafka_topic as topic, kafka_partition as partition, count(*) as n,
    min(kafka_offset) as first_offset, max(kafka_offset) as last_offset from tx group by all""", "tx")
def bounded_source(src):
    path = scratch(src.spark, "a2")
    layout.append(tx_wire(src.view("tx")), path)
    rows = topics.bounded_source(src.spark, path=path)
    return rows.groupBy("topic", "partition").agg(
        F.count(F.lit(1)).alias("n"), F.min("offset").alias("first_offset"), F.max("offset").alias("last_offset"))


# Offsets in a stored segment, and offsets a batch takes.
SEGMENT, PER_TRIGGER = 5_000, 4_000


def stored_blocks(src, name):
    """Block headers as they travel, in stored segments, and a reader's options."""
    path = scratch(src.spark, name)
    segments.store_segments(log_wire(src.view("blocks")), path, SEGMENT)
    return segments.registered(src.spark), path


@query("a1_starting_offsets", """select kafka_partition as partition, kafka_offset as offset from blocks
    where kafka_partition = 1 or kafka_partition = 0 and kafka_offset >= 500""", "blocks")
def starting_offsets(src):
    """A stream that begins at an offset, at the earliest, and at the latest one."""
    spark, path = stored_blocks(src, "a1-segments")
    starting = '{"0": 500, "1": -2, "2": -1}'
    rows = spark.readStream.format("segments").option("startingOffsets", starting).option("path", path).load()
    return jobs.append(rows.select("partition", "offset"), scratch(spark, "a1-from"), scratch(spark, "a1-from-checkpoint"))


@query("a1_offsets_per_trigger", f"""select cast(sum(n) as bigint) as n, cast(sum(n) as bigint) as offsets, sum(span) > {PER_TRIGGER} as several_batches, true as capped
    from (select count(*) as n, max(kafka_offset) - min(kafka_offset) + 1 as span from blocks group by kafka_partition)""", "blocks")
def offsets_per_trigger(src):
    """No batch takes more offsets than it may, and together they take all."""
    spark, path = stored_blocks(src, "a1-segments")
    reader = spark.readStream.format("segments").option("startingOffsets", "earliest").option("maxOffsetsPerTrigger", PER_TRIGGER)
    rows = reader.option("path", path).load().select("partition", "offset")
    out = scratch(spark, "a1-capped")
    writer = rows.writeStream.format("two_phase").option("path", out)
    jobs.drain(spark, writer.option("checkpointLocation", scratch(spark, "a1-capped-checkpoint")))
    stored = segments.committed(spark, out, rows.schema, batch="batch")
    taken = stored.groupBy("batch", "partition").agg((F.max("offset") - F.min("offset") + 1).alias("offsets"), F.count(F.lit(1)).alias("n"))
    by_batch = taken.groupBy("batch").agg(F.sum("offsets").alias("offsets"), F.sum("n").alias("n"))
    whole = stored.agg(F.countDistinct("offset").alias("offsets")).scalar()
    return by_batch.agg(F.sum("n").alias("n"), whole.alias("offsets"), (F.count(F.lit(1)) > 1).alias("several_batches"),
                        (F.max("offsets") <= PER_TRIGGER).alias("capped"))


@query("a2_min_partitions", "select count(*) as n, count(distinct kafka_offset) as offsets, true as split from blocks", "blocks")
def min_partitions(src):
    """A bounded read of three partitions in twelve splits or more."""
    spark, path = stored_blocks(src, "a2-segments")
    rows = spark.read.format("segments").option("path", path).option("minPartitions", 12).load()
    split = rows.select("offset", F.spark_partition_id().alias("part"))
    return split.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("offset").alias("offsets"), (F.countDistinct("part") >= 12).alias("split"))


@query("a3_kafka_metadata", f"select {KEY}, {COORD}, cast(cast(kafka_timestamp as date) as varchar) as kafka_date from tx", "tx")
def kafka_metadata(src):
    return tx_wire(src.view("tx")).select(*topics.kafka_metadata())


@query("a4_strip_wire_header", f"select {KEY}, {RECORD}::varchar as payload, 7::bigint as schema_id from tx", "tx")
def strip_wire_header(src):
    return tx_wire(src.view("tx")).select(
        F.col("key").cast("string").alias("kafka_key"),
        F.decode(topics.strip_wire_header(F.col("value")), "UTF-8").alias("payload"),
        topics.schema_id(F.col("value")).alias("schema_id"))


@query("a5_decode_payload", f"""select {KEY}, block_height, job_name, run_id, raw, {COORD},
    cast(cast(kafka_timestamp as date) as varchar) as kafka_date from tx""", "tx")
def decode_payload(src):
    return topics.decode_records(tx_wire(src.view("tx")), schemas.RAW_RECORD)


@query("a6_bronze_append", f"""select block_height, job_name, run_id, raw, {COORD},
    cast(cast(kafka_timestamp as date) as varchar) as kafka_date from tx""", "tx")
def bronze_append(src):
    decoded = topics.decode_records(tx_wire(src.stream("tx")), schemas.RAW_RECORD)
    return jobs.append(bronze.bronze_tx(decoded), scratch(src.spark, "a6"), scratch(src.spark, "a6-checkpoint"))


@query("a7_batch_append", """select job_name, count(*) as n, max(kafka_offset) as last_offset from tx
    group by job_name""", "tx")
def batch_append(src):
    path = scratch(src.spark, "a7")
    rows = src.view("tx")
    for job in ("bsc_backfill_transactions", "bsc_realtime_transactions"):
        layout.append(rows.where(F.col("job_name") == job), path)
    return src.spark.read.schema(rows.schema).parquet(path).groupBy("job_name").agg(
        F.count(F.lit(1)).alias("n"), F.max("kafka_offset").alias("last_offset"))


@query("a8_table_scan", """select kafka_partition, count(*) as n, true as existed, false as other_existed from tx
    group by kafka_partition""", "tx")
def table_scan(src):
    path = scratch(src.spark, "a8")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    src.view("tx").write.option("path", path).saveAsTable(name)
    found, other = (layout.table_exists(src.spark, n) for n in (name, name + "_none"))
    return src.spark.table(name).groupBy("kafka_partition").agg(
        F.count(F.lit(1)).alias("n"), F.lit(found).alias("existed"), F.lit(other).alias("other_existed"))


@query("a9_partitioned_overwrite", """select event_id, user_id, event_type,
    case when event_type = 'error' then value * 2 else value end as value from events""")
def partitioned_overwrite(src):
    """All partitions are written, then one is replaced and the others stay."""
    path = scratch(src.spark, "a9")
    rows = src.table("events").select("event_id", "user_id", "value", "event_type")
    layout.write_partitioned(rows, path, ["event_type"])
    fixed = rows.where("event_type = 'error'").withColumn("value", F.col("value") * 2)
    layout.write_partitioned(fixed, path, ["event_type"])
    return src.spark.read.schema(rows.schema).parquet(path)


@query("a11_keyed_upsert_sink", f"""with c as (select block_height, {S.window_start('kafka_timestamp', 10)} as window_start,
    count(*) as cnt from tx group by all)
    select block_height, window_start, window_start + interval 10 second as window_end, cnt from c""", "tx")
def keyed_upsert_sink(src):
    return jobs.upsert_counts(src.stream("tx"), scratch(src.spark, "a11"), scratch(src.spark, "a11-checkpoint"))


@query("a11_keyed_records", f"""with c as (select block_height, {S.window_start('kafka_timestamp', 10)} as window_start,
    count(*) as cnt from tx group by all) select
    '{{"block_height":' || block_height || ',"window_start":"' || strftime(window_start, '%Y-%m-%dT%H:%M:%S.000Z') || '"}}' as key,
    '{{"block_height":' || block_height || ',"window_start":"' || strftime(window_start, '%Y-%m-%dT%H:%M:%S.000Z')
    || '","window_end":"' || strftime(window_start + interval 10 second, '%Y-%m-%dT%H:%M:%S.000Z') || '","cnt":' || cnt || '}}' as value
    from c""", "tx")
def keyed_records(src):
    return jobs.keyed_records(jobs.tumbling_count(src.view("tx")))


@query("a12_emit_records", f"""with {S.LOGJ}, n as (select *, row_number() over (partition by block_number
    order by log_index, kafka_partition, kafka_offset) - 1 as idx from lg where block_number is not null)
    select block_number || '-' || idx as key, json_object('block_height', block_number, 'job_name', job_name,
    'run_id', run_id, 'raw', raw)::varchar as value from n""", "logs")
def emit_records(src):
    keep = ("job_name", "run_id", "raw", "kafka_partition", "kafka_offset")
    return bronze.emit_records(bronze.usable_logs(src.view("logs"), *keep))


@query("a13_split_block_payload", """with t as (select block_height, json_extract_string(payload, '$.hash') as h,
    unnest(cast(json_extract(payload, '$.transactions') as json[])) as tx,
    generate_subscripts(cast(json_extract(payload, '$.transactions') as json[]), 1) - 1 as tx_index from payloads)
    select block_height, tx_index, block_height || '-' || tx_index as key,
    '{"blockHash":"' || h || '",' || substr(cast(tx as varchar), 2) as raw from t""", "payloads")
def split_transactions(src):
    return bronze.split_transactions(src.view("payloads"))


@query("a13_split_block_header", """select block_height, cast(block_height as varchar) as key,
    json_extract_string(payload, '$.hash') as hash, json_extract_string(payload, '$.parentHash') as parent_hash,
    json_extract_string(payload, '$.gasUsed') as gas_used, cast(null as varchar) as transactions from payloads""", "payloads")
def split_header(src):
    raw = bronze.split_header(src.view("payloads"))
    names = {"hash": "hash", "parentHash": "parent_hash", "gasUsed": "gas_used", "transactions": "transactions"}
    return raw.select(
        "block_height", "key", *[F.get_json_object("raw", f"$.{f}").alias(n) for f, n in names.items()])


@query("a15_flatten_record", """select c_name as city, c_acctbal as temperature, c_mktsegment as weather_description,
    cast(c_nationkey as double) as wind_speed, TIMESTAMP '2024-05-01 10:30:00' as time, n_name as utc_offset
    from customer join nation on c_nationkey = n_nationkey""")
def flatten_record(src):
    rows = src.table("customer").join(src.table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    payload = F.to_json(F.struct(
        F.struct(F.col("c_name").alias("name"), F.lit("2024-05-01 10:30").alias("localtime"),
                 F.col("n_name").alias("utc_offset")).alias("location"),
        F.struct(F.col("c_acctbal").alias("temperature"), F.array("c_mktsegment").alias("weather_descriptions"),
                 F.col("c_nationkey").alias("wind_speed")).alias("current")))
    return records.weather_rows(rows.select(payload.alias("payload")))


@query("a15_flatten_person", """select c_name as first_name, c_mktsegment as last_name, 'x' as gender,
    c_custkey || ' Main Street ' || n_name || ', ' || r_name || ', Earth' as address, cast(c_custkey as varchar) as postcode,
    c_name || '@example.org' as email, c_name as username, '1990-01-01' as dob, '2020-01-01' as registration_date,
    cast(null as varchar) as phone, 'p.png' as picture from customer join nation on c_nationkey = n_nationkey
    join region on n_regionkey = r_regionkey""")
def flatten_person(src):
    places = src.table("nation").join(src.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    rows = src.table("customer").join(places, F.col("c_nationkey") == F.col("n_nationkey"))
    payload = F.to_json(F.struct(
        F.lit("x").alias("gender"),
        F.struct(F.col("c_name").alias("first"), F.col("c_mktsegment").alias("last")).alias("name"),
        F.struct(F.struct(F.col("c_custkey").alias("number"), F.lit("Main Street").alias("name")).alias("street"),
                 F.col("n_name").alias("city"), F.col("r_name").alias("state"), F.lit("Earth").alias("country"),
                 F.col("c_custkey").cast("string").alias("postcode")).alias("location"),
        F.concat("c_name", F.lit("@example.org")).alias("email"),
        F.struct(F.col("c_name").alias("username")).alias("login"),
        F.struct(F.lit("1990-01-01").alias("date")).alias("dob"),
        F.struct(F.lit("2020-01-01").alias("date")).alias("registered"),
        F.struct(F.lit("p.png").alias("medium")).alias("picture")))
    return records.person_rows(rows.select(payload.alias("payload")))


@query("a18_fan_out_sinks", """select sink, count(*) as n, max(kafka_offset) as last_offset
    from (select unnest(['lake', 'serving']) as sink, kafka_offset from tx) group by sink""", "tx")
def fan_out_sinks(src):
    lake, serving = scratch(src.spark, "a18-lake"), scratch(src.spark, "a18-serving")
    for running in jobs.fan_out(src.stream("tx"), {lake: None, serving: None}, scratch(src.spark, "a18-checkpoint")):
        running.awaitTermination()
    both = [src.spark.read.parquet(p).select(F.lit(n).alias("sink"), "kafka_offset")
            for n, p in (("lake", lake), ("serving", serving))]
    return both[0].unionByName(both[1]).groupBy("sink").agg(
        F.count(F.lit(1)).alias("n"), F.max("kafka_offset").alias("last_offset"))


# ---- conversation export ------------------------------------------------------------


def count_of(text: str, word: str) -> str:
    w = word.replace("'", "''")
    return f"cast((length({text}) - length(replace({text}, '{w}', ''))) // {len(word)} as bigint)"


def score_sql(topic: str) -> str:
    words = conversations.TOPICS[topic]
    body = " + ".join(count_of("lower(text)", w) for w in words)
    head = " + ".join(count_of("lower(title)", w) for w in words)
    return f"cast(sum({body}) + max({head}) as bigint) as {conversations.score_column(topic)}"


SCORES = (
    "sc as (select conv_id, max(title) as title, max(create_time) as create_time, "
    + ", ".join(score_sql(t) for t in conversations.TOPICS) + " from chats group by conv_id)"
)
BEST = "greatest(" + ", ".join(conversations.score_column(t) for t in conversations.TOPICS) + ")"
MAIN = (
    f"case when {BEST} = 0 then 'uncategorized' "
    + " ".join(f"when {conversations.score_column(t)} = {BEST} then '{t}'" for t in conversations.TOPICS) + " end"
)
FOUND = "[x for x in [" + ", ".join(
    f"case when {conversations.score_column(t)} > 0 then '{t}' end" for t in conversations.TOPICS
) + "] if x is not null]"
LABELS = (
    f"{SCORES}, m as (select *, {MAIN} as main_topic, {FOUND} as found from sc), "
    "lab as (select *, [x for x in found if x <> main_topic] as others from m)"
)
HEADING = "case role when 'user' then '## 🧑 User' when 'assistant' then '## 🤖 Assistant' else '## ' || role end"
BODY = (
    "body as (select conv_id, row_number() over (partition by conv_id order by turn) as pos, "
    f"{HEADING} || chr(10) || text || chr(10) || chr(10) as text from chats)"
)
FILE = r"""regexp_replace(title, '[\\/:*?"<>|]', '_', 'g')"""
DOCS = (
    f"{LABELS}, {BODY}, named as (select conv_id, strftime(create_time, '%Y') as year, "
    f"strftime(create_time, '%m') as month, main_topic, {FILE} || '.md' as file_name, "
    "'---' || chr(10) || 'title: ' || title || chr(10) || 'date: ' || strftime(create_time, '%Y-%m-%d %H:%M:%S') || chr(10) "
    "|| 'main_topic: ' || main_topic || chr(10) || 'tags: [' || array_to_string(list_concat([main_topic], others), ', ') "
    "|| ']' || chr(10) || 'conversation_id: ' || conv_id || chr(10) || '---' || chr(10) || chr(10) as front from lab), "
    "docs as (select conv_id, year, month, main_topic, file_name, 0::bigint as pos, front as text from named "
    "union all select conv_id, year, month, main_topic, file_name, pos, text from named join body using (conv_id))"
)


@query("a18_fan_out_triggers", "select 'lake' as sink, kafka_key, kafka_offset from state union all select 'store', kafka_key, kafka_offset from state", "state")
def fan_out_triggers(src):
    """One source, two sinks on triggers of their own (short ones here), stopped when both have
    taken what there is."""
    paths = {"lake": scratch(src.spark, "a18-lake"), "store": scratch(src.spark, "a18-store")}
    rows = src.stream("state").select("kafka_key", "kafka_offset")
    running = jobs.fan_out(rows, {paths["lake"]: "2 seconds", paths["store"]: "1 second"}, scratch(src.spark, "a18-triggers"))
    for sink in running:
        sink.processAllAvailable()
        sink.stop()
    lake, store = [src.spark.read.schema(rows.schema).parquet(p).withColumn("sink", F.lit(n)) for n, p in paths.items()]
    return lake.unionByName(store)


@query("a17_partitioned_text_export", f"with {DOCS} select * from docs", "chats")
def partitioned_text_export(src):
    return conversations.documents(src.view("chats"))


@query("a17_exported_lines", f"""with {DOCS} select cast(year as integer) as year, cast(month as integer) as month, main_topic,
    count(*) as pieces, count(distinct conv_id) as documents, cast(sum(length(text)) as bigint) as chars
    from docs group by year, month, main_topic""", "chats")
def exported_lines(src):
    """What the written files hold."""
    path = scratch(src.spark, "a17")
    conversations.write_documents(conversations.documents(src.view("chats")), path)
    pieces = src.spark.read.schema("file_name string, conv_id bigint, pos bigint, text string, year string, month string, main_topic string")
    return pieces.json(path).groupBy(
        F.col("year").cast("int").alias("year"), F.col("month").cast("int").alias("month"), "main_topic"
    ).agg(F.count(F.lit(1)).alias("pieces"), F.countDistinct("conv_id").alias("documents"), F.sum(F.length("text")).alias("chars"))


@query("a17_index", f"""with {DOCS} select year, month, main_topic,
    row_number() over (partition by year, month, main_topic order by file_name, conv_id) as line,
    '# ' || upper(main_topic) || ' — ' || year || '-' || month as heading,
    '- [' || replace(file_name, '.md', '') || '](' || file_name || ')' as entry from docs where pos = 0""", "chats")
def export_index(src):
    return conversations.index(conversations.documents(src.view("chats")))


@query("e13_topic_score", f"with {LABELS} select * exclude (title, create_time, found, others), "
       "array_to_string(others, '|') as other_topics from lab", "chats")
def topic_score(src):
    return conversations.classify(conversations.topic_scores(src.view("chats"))).drop("title", "create_time", "best")


@query("e13_document_topics", """with chats as (select doc_id as conv_id, 0 as turn, 'user' as role, text,
    source as title, TIMESTAMP '2024-01-01' as create_time from documents), """ + LABELS
       + " select conv_id, main_topic, array_to_string(others, '|') as other_topics from lab")
def document_topics(src):
    docs = src.table("documents").select(
        F.col("doc_id").alias("conv_id"), "text", F.col("source").alias("title"),
        F.to_timestamp(F.lit("2024-01-01")).alias("create_time"))
    return conversations.classify(conversations.topic_scores(docs)).select("conv_id", "main_topic", "other_topics")


@query("e14_conversation_rollup", f"with {BODY} select conv_id, pos, text from body", "chats")
def conversation_rollup(src):
    return conversations.rollup(src.view("chats"))


@query("e14_message_parts", """select conv_id, turn, role, trim(text || chr(10) || role) as text from conversations
    where role is not null""")
def message_parts(src):
    """Plain and structured parts of a message are joined, other parts are left out."""
    def part(**kw):
        names = ("plain", "text", "content")
        return F.struct(*[kw.get(n, F.lit(None).cast("string")).alias(n) for n in names])

    nodes = src.table("conversations").select(
        "conv_id", "turn", "role",
        F.array(part(plain=F.col("text")), part(), part(content=F.col("role"))).alias("parts"))
    return conversations.messages(nodes).select("conv_id", "turn", "role", "text")
