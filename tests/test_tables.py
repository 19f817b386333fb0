"""Streams, writes and exports: replay, resume, pruning, files."""

import collections
import glob
import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from chainlake.functions import columns as C
from chainlake.operators import bronze, conversations, heads, layout, metrics, records
from chainlake.plans.layouts import PRODUCER
from chainlake.sources import topics
from chainlake.streaming import atomic, jobs, stateful

from conftest import rows


def test_short_wire_values(spark):
    df = spark.createDataFrame([(bytearray(b"\0\0"),), (bytearray(b"\0\0\0\0\x07{}"),), (bytearray(b""),)], "value binary")
    got = [bytes(r[0]) for r in df.select(topics.strip_wire_header(F.col("value"))).collect()]
    assert got == [b"", b"{}", b""]
    assert df.select(topics.schema_id(F.col("value"))).collect()[1][0] == 7


def test_malformed_payload_gives_nulls(spark):
    df = spark.createDataFrame([(bytearray(b"\0\0\0\0\x07oops"),)], "value binary")
    got = df.select(topics.decode(topics.strip_wire_header(F.col("value")), "a string, b bigint").alias("r")).first()[0]
    assert got is None or (got["a"], got["b"]) == (None, None)


def test_split_keeps_member_types(spark):
    payload = ('{"hash":"0xh","transactions":[{"blockHash":null,"n":1,"l":["x"],"t":"{q}"},{"hash":"0x2"},{}]}')
    df = spark.createDataFrame([(7, payload)], "block_height bigint, payload string")
    got = [r["raw"] for r in bronze.split_transactions(df).orderBy("tx_index").collect()]
    assert got == ['{"blockHash":"0xh","n":1,"l":["x"],"t":"{q}"}', '{"blockHash":"0xh","hash":"0x2"}', '{"blockHash":"0xh"}']


def test_repeated_batch_changes_nothing(spark, scratch):
    path = scratch("replay")
    batch = spark.createDataFrame([(5, "a"), (9, "b")], "block_height bigint, v string")
    for _ in range(2):
        atomic.commit_batch(batch, 0, path, PRODUCER)
    assert rows(atomic.committed_rows(spark, path)) == [(5, "a"), (9, "b")]
    assert atomic.commits(spark, path).count() == 1


def test_rows_without_progress_stay_hidden(spark, scratch):
    path = scratch("crash")
    batch = spark.createDataFrame([(5, "a")], "block_height bigint, v string")
    atomic.commit_batch(batch, 0, path, PRODUCER)
    batch.withColumn("block_height", F.lit(6).cast("bigint")).write.parquet(f"{path}/data/batch=1")
    assert rows(atomic.committed_rows(spark, path)) == [(5, "a")]


def streamed(spark, scratch, df, files, by, **kw):
    path = scratch("input")
    df.repartitionByRange(files, by).sortWithinPartitions(by).write.parquet(path)
    # Streams take files by their age.
    for i, file in enumerate(sorted(glob.glob(f"{path}/*.parquet"))):
        os.utime(file, (1_700_000_000 + i, 1_700_000_000 + i))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema)
    return topics.stream_source(spark, path=path, schema=schema, **kw)


def test_safe_head_over_batches_equals_one_pass(spark, src, scratch):
    df = src.view("heads").select("chain", "seq", "raw_block").where("chain = 'view'")
    stream = streamed(spark, scratch, df, 6, "seq", max_per_trigger=1)
    got = rows(stateful.safe_head(stream, scratch("safe"), scratch("safe-checkpoint")))
    assert got == rows(heads.safe_head(df))


def test_counts_add_up_over_batches(spark, src, scratch):
    df = src.view("tx").select("block_height", "kafka_timestamp", "kafka_offset")
    stream = streamed(spark, scratch, df, 3, "kafka_offset", max_per_trigger=1).drop("kafka_offset")
    got = jobs.upsert_counts(stream, scratch("up"), scratch("up-checkpoint"))
    columns = ["block_height", "window_start", "window_end", "cnt"]
    assert rows(got.select(*columns)) == rows(jobs.tumbling_count(df).select(*columns))


def test_a_table_that_cannot_be_read_is_not_empty(spark, scratch):
    schema = StructType([StructField("v", LongType())])
    assert layout.read_table(spark, scratch("none"), schema).count() == 0
    with pytest.raises(Exception, match="(?i)scheme|filesystem"):
        layout.read_table(spark, "nosuchstore://x/y", schema).count()


def test_progress_listener(spark, src, scratch):
    path = scratch("progress")
    listener = jobs.ProgressToTable(spark, path)
    spark.streams.addListener(listener)
    try:
        jobs.appended(spark, src.stream("state").select("kafka_offset"), "listened")
        import time

        for _ in range(60):
            if glob.glob(f"{path}/*.parquet"):
                break
            time.sleep(0.5)
    finally:
        spark.streams.removeListener(listener)
    assert spark.read.parquet(path).agg(F.sum("rows")).first()[0] == src.view("state").count()


def test_bucket_filter_prunes_partitions(spark, scratch):
    path = scratch("buckets")
    df = layout.with_block_bucket(spark.range(5000).withColumnRenamed("id", "block_number"), width=1000)
    layout.write_partitioned(df, path, ["block_bucket"])
    hit = spark.read.parquet(path).where(layout.block_filter(1500, 2500, width=1000))
    assert hit.count() == 1001
    assert len(hit.select(F.input_file_name()).distinct().collect()) <= 4
    assert "PartitionFilters: [isnotnull(block_bucket" in hit._jdf.queryExecution().executedPlan().toString()


def test_dynamic_overwrite_keeps_other_partitions(spark, scratch):
    path = scratch("dynamic")
    schema = "v int, p string"
    layout.write_partitioned(spark.createDataFrame([(1, "a"), (2, "b")], schema), path, ["p"])
    layout.write_partitioned(spark.createDataFrame([(9, "a")], schema), path, ["p"])
    assert rows(spark.read.parquet(path)) == [(2, "b"), (9, "a")]


def test_schema_breaks():
    old = StructType([StructField("a", LongType()), StructField("b", StringType())])
    new = StructType([StructField("a", StringType()), StructField("c", LongType())])
    assert layout.schema_breaks(old, new) == ["a: bigint became string", "b: removed", "c: added without default"]
    assert layout.schema_breaks(old, StructType([*old, StructField("c", LongType())]), {"c"}) == []


def test_delete_keeps_unknown_rows(spark):
    df = spark.createDataFrame([("a.b",), ("ab",), (None,)], "k string")
    assert [r["k"] for r in layout.delete_where(df, "k like '%.%'").collect()] == ["ab", None]


def test_counter_reset(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate([5.0, 9.0, 2.0])], "s int, value double").select(
        F.timestamp_seconds("s").alias("ts"), F.lit("m").alias("metric"), "value")
    assert metrics.increments(df, ["metric"]).agg(F.sum("delta")).first()[0] == 6.0


def test_levels(spark):
    df = spark.createDataFrame([(v,) for v in (0, 5, 19, 20, 100)], "v int")
    assert [r[0] for r in df.select(metrics.level(F.col("v"))).collect()] == ["green", "yellow", "yellow", "orange", "red"]


def test_long_conversation_stays_one_document(spark):
    n = 5_000
    df = spark.range(n).select(
        F.lit(1).cast("bigint").alias("conv_id"), F.col("id").alias("turn"), F.lit("user").alias("role"),
        F.concat(F.lit("m"), F.col("id").cast("string")).alias("text"), F.lit(None).cast("string").alias("title"),
        F.lit(None).cast("timestamp").alias("create_time"))
    got = conversations.documents(df).orderBy("pos").collect()
    assert [r["pos"] for r in got] == list(range(n + 1))
    assert {r["file_name"] for r in got} == {"Untitled.md"} and got[0]["text"].startswith("---\ntitle: Untitled\n")
    assert "".join(r["text"] for r in got[1:]) == "".join(f"## 🧑 User\nm{t}\n\n" for t in range(n))


def test_topics_break_ties_by_order(spark):
    chats = [(1, "T", "kafka spark"), (2, "T", "ethereum eth method"), (3, "T", "none"), (4, "Spark", "web3 blockchain")]
    df = spark.createDataFrame(chats, "conv_id bigint, title string, text string").withColumn("create_time", F.current_timestamp())
    got = {r["conv_id"]: (r["main_topic"], r["other_topics"]) for r in conversations.classify(conversations.topic_scores(df)).collect()}
    assert got[1] == ("kafka", ["spark"])
    assert got[2] == ("ethereum", [])
    assert got[3] == ("uncategorized", [])
    assert got[4] == ("web3", ["spark", "ethereum"])


def test_exported_files_hold_the_documents(spark, src, scratch):
    path, index = scratch("export"), scratch("index")
    docs = conversations.documents(src.view("chats"))
    conversations.write_documents(docs, path)
    conversations.write_index(conversations.index(docs), index)
    pieces = collections.defaultdict(list)
    for f in glob.glob(f"{path}/*/*/*/*.json"):
        for line in open(f, encoding="utf-8"):
            piece = json.loads(line)
            pieces[piece["conv_id"], piece["file_name"]].append(piece)
    assert all([p["pos"] for p in found] == list(range(len(found))) for found in pieces.values())
    want = docs.groupBy("conv_id", "file_name").agg(F.sort_array(F.collect_list(F.struct("pos", "text"))).alias("all"))
    assert {k: [p["text"] for p in v] for k, v in pieces.items()} == {
        (r["conv_id"], r["file_name"]): [p["text"] for p in r["all"]] for r in want.collect()}
    lines = [x for f in glob.glob(f"{index}/*/*/*/*.txt") for x in open(f, encoding="utf-8")]
    assert len(lines) == docs.where("pos = 0").count()


def test_records_with_missing_members(spark):
    df = spark.createDataFrame([('{"location":{"name":"X","localtime":"bad"},"current":{"weather_descriptions":[]}}',)], "payload string")
    r = records.weather_rows(df).first()
    assert (r["city"], r["weather_description"], r["time"], r["temperature"]) == ("X", None, None, None)


def test_proxy_presets_differ(spark):
    df = spark.createDataFrame([("0x3593564c" + "0" * 256,), ("0x3593564c" + "0" * 64,)], "d string")
    got = [tuple(r) for r in df.select(C.is_proxy_like(F.col("d")), C.is_proxy_like(F.col("d"), C.PROXY_ROUTER, 4)).collect()]
    assert got == [(False, True), (False, False)]
