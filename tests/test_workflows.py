"""The jobs end to end over files."""

from pyspark.sql import functions as F

from chainlake import workflows
from chainlake.functions import schemas
from chainlake.operators import silver, state
from chainlake.plans.common import log_wire, state_table, tx_wire
from chainlake.sources import topics

from conftest import rows


def topic(spark, scratch, wire):
    path = scratch("topic")
    wire.write.parquet(path)
    return path


def test_topic_to_silver(spark, src, scratch):
    path, table, checkpoint, out = (scratch(n) for n in ("topic", "bronze", "checkpoint", "silver"))
    # Few dates, as every date is a folder.
    view = src.view("tx").withColumn("kafka_timestamp", F.date_trunc("year", "kafka_timestamp"))
    appended = []
    for part in ("kafka_partition = 0", "kafka_partition > 0"):
        tx_wire(view.where(part)).write.mode("append").parquet(path)
        stream = topics.stream_source(spark, path=path)
        workflows.bronze_transactions(stream, table, checkpoint).awaitTermination()
        appended.append(workflows.silver_transactions(spark.read.parquet(table), out))
    appended.append(workflows.silver_transactions(spark.read.parquet(table), out))
    parsed = silver.enriched_tx(view)
    assert appended == [parsed.where("kafka_partition = 0").count(), parsed.where("kafka_partition > 0").count(), 0]
    columns = ["tx_hash", "kafka_partition", "kafka_offset", "value_hex64", "tx_kind"]
    assert rows(spark.read.parquet(out).select(*columns).na.fill("")) == rows(parsed.select(*columns).na.fill(""))


def test_log_jobs(spark, src, scratch):
    at = F.concat(F.substring("inserted_at", 1, 4), F.lit("-01-01T00:00:00.000Z"))
    path = topic(spark, scratch, log_wire(src.view("logs").withColumn("inserted_at", at)))
    table, out = scratch("logs"), scratch("silver-logs")
    workflows.bronze_logs(topics.stream_source(spark, path=path), table, scratch("c1")).awaitTermination()
    assert spark.read.parquet(table).count() == src.view("logs").count()
    checkpoint = scratch("c2")
    wire = log_wire(src.view("logs").withColumn("inserted_at", at))
    distinct = silver.silver_logs(src.view("logs")).select(*workflows.LOG_KEY).distinct().count()
    for _ in range(2):  # the second run finds the same logs delivered again
        got = workflows.silver_logs(topics.stream_source(spark, path=path), out, checkpoint)
        assert got.count() == distinct and got.select(*workflows.LOG_KEY).distinct().count() == distinct
        wire.write.mode("append").parquet(path)


def test_progress_state(spark, src, scratch):
    table = None
    view = src.view("state").withColumn("value", F.concat(F.unhex(F.lit("0000000007")), F.encode("payload", "UTF-8")))
    wire = view.select(
        F.encode("kafka_key", "UTF-8").alias("key"), "value", F.col("kafka_topic").alias("topic"),
        F.col("kafka_partition").alias("partition"), F.col("kafka_offset").alias("offset"),
        F.col("kafka_timestamp").alias("timestamp"))
    half = wire.agg(F.max("offset")).first()[0] // 2
    for upto in (half, 2 * half + 1, 2 * half + 1):  # the repeat changes nothing
        path = topic(spark, scratch, wire.where(F.col("offset") <= upto))
        new = scratch("state")
        got = workflows.progress_state(topics.bounded_source(spark, path=path), table, new)
        table = new
        columns = ["kafka_key", "run_id", "kafka_offset"]
        last = rows(got.select(*columns))
    full = state_table(src)
    runs = [state.latest_value(full.where(F.col("kafka_offset") <= n)) for n in (half, 2 * half + 1)]
    assert last == rows(state.merge_upsert(*runs).select(*columns))


def test_old_record_form(spark):
    df = spark.createDataFrame([('{"job_name":"j","range":{"start":1,"end":9},"status":"failed"}',)], "v string")
    r = df.select(F.from_json("v", schemas.struct(schemas.BACKFILL_STATE_RECORD)).alias("r")).first()["r"]
    assert (r["range"]["end"], r["status"]) == (9, "failed") and r["status"] in schemas.STATE_STATUSES
