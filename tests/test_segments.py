"""Segments as a source, and the two-phase sink with failing tasks and repeated batches."""

import os

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from chainlake.functions import schemas
from chainlake.sources import segments
from chainlake.streaming import jobs


def wire(spark, first, stop):
    return spark.range(first, stop).select(
        F.encode(F.col("id").cast("string"), "UTF-8").alias("key"), F.lit(None).cast("binary").alias("value"), F.lit("t").alias("topic"),
        (F.col("id") % 2).cast("int").alias("partition"), F.col("id").alias("offset"), F.timestamp_seconds(F.col("id")).alias("timestamp"))


def test_ranges_are_split():
    files = ["x/partition=0/segment-0-9.parquet", "x/partition=0/segment-10-19.parquet"]
    parts = segments.split([segments.Range(0, 0, 20, files), segments.Range(1, 0, 4, ["x/partition=1/segment-0-3.parquet"])], 6)
    assert [(p.partition, p.first, p.stop, len(p.files)) for p in parts] == [(0, 0, 4, 1), (0, 4, 8, 1), (0, 8, 12, 2), (0, 12, 16, 1), (0, 16, 20, 1), (1, 0, 4, 1)]


def test_segments_keep_all_rows_and_grow(spark, scratch):
    segments.registered(spark)
    path, out, checkpoint = scratch("seg"), scratch("seg-out"), scratch("seg-checkpoint")
    segments.store_segments(wire(spark, 0, 100), path, 16)
    read = lambda **o: spark.read.format("segments").options(path=path, **o).load()
    assert sorted(map(tuple, read().collect())) == sorted(map(tuple, wire(spark, 0, 100).collect()))
    assert read().schema.simpleString() == spark.createDataFrame([], schemas.KAFKA_ROW).schema.simpleString()
    some = read(startingOffsets='{"0": 90, "1": -1}', endingOffsets='{"0": 95, "1": -1}')
    assert sorted(r.offset for r in some.collect()) == [90, 92, 94]

    def run(most):
        rows = spark.readStream.format("segments").options(path=path, startingOffsets="earliest", maxOffsetsPerTrigger=most).load()
        work = lambda b, i: b.select("offset").write.mode("overwrite").parquet(f"{out}/batch={i}")
        query = rows.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint).trigger(processingTime="0 seconds").start()
        query.processAllAvailable()
        query.stop()
        return sorted(r.offset for r in spark.read.parquet(out).collect())

    assert run(60) == list(range(100))
    segments.store_segments(wire(spark, 100, 150), path, 16)
    assert run(60) == list(range(150))


def test_a_backlog_is_listed_once(tmp_path, monkeypatch):
    """Batches of a stream with much before it don't list the folder anew, take every segment they
    need and no other, and find what is added."""
    def add(first, stop, width):
        for p in (0, 1):
            (tmp_path / f"partition={p}").mkdir(exist_ok=True)
            for a in range(first, stop, width):
                (tmp_path / f"partition={p}" / f"segment-{a}-{a + width - 1}.parquet").touch()

    add(0, 1000, 10)
    # An overlapping segment that reaches far.
    (tmp_path / "partition=0" / "segment-5-400.parquet").touch()
    listings, plain = [], segments.segments_of
    monkeypatch.setattr(segments, "segments_of", lambda path: listings.append(1) or plain(path))
    stream = segments.SegmentStream({"path": str(tmp_path), "startingoffsets": "earliest", "maxoffsetspertrigger": "40"})
    at, batches = stream.initialOffset(), 0
    while (end := stream.latestOffset()) != at:
        for part in stream.partitions(at, end):
            held = [(a, b, f) for a, b, f in plain(str(tmp_path))[part.partition] if a < part.stop and b >= part.first]
            assert part.files == [f for _, _, f in held]
            assert part.stop - part.first <= 40
        at, batches = end, batches + 1
        if batches == 20:
            add(1000, 1100, 10)
    assert at == {"0": 1100, "1": 1100} and batches >= 55
    assert len(listings) <= 10


def test_empty_folder(spark, scratch):
    assert segments.registered(spark).read.format("segments").option("path", scratch("none")).load().count() == 0


def stream(spark, path):
    return spark.readStream.schema("id bigint").parquet(path)


def to_sink(rows, path, checkpoint):
    writer = rows.writeStream.format("two_phase").option("path", path).option("checkpointLocation", checkpoint)
    writer.trigger(availableNow=True).start().awaitTermination()


def test_failing_tasks_leave_nothing(spark, scratch):
    """One task writes its rows and another one fails: nothing is to be seen, and the next run
    writes the batch once."""
    segments.registered(spark)
    given, path, checkpoint = scratch("in"), scratch("out"), scratch("out-checkpoint")
    spark.range(0, 1000, 1, 4).write.parquet(given)
    rows = stream(spark, given)
    bad = rows.withColumn("id", F.when(F.col("id") == 777, F.raise_error(F.lit("broken row")).cast("bigint")).otherwise(F.col("id")))
    with pytest.raises(StreamingQueryException):
        to_sink(bad, path, checkpoint)
    assert segments.committed(spark, path, rows.schema).count() == 0
    to_sink(rows, path, checkpoint)
    assert sorted(r.id for r in segments.committed(spark, path, rows.schema).collect()) == list(range(1000))


def test_repeated_batches_add_nothing(spark, scratch):
    segments.registered(spark)
    given, path = scratch("in"), scratch("out")
    spark.range(100).write.parquet(given)
    to_sink(stream(spark, given), path, scratch("first"))
    files = sorted(os.listdir(f"{path}/pending"))
    # Another checkpoint makes the same batch again.
    to_sink(stream(spark, given), path, scratch("second"))
    assert sorted(os.listdir(f"{path}/pending")) == files
    assert segments.committed(spark, path, stream(spark, given).schema).count() == 100


def test_capped_batches_keep_their_numbers(spark, scratch):
    """A capped stream drained to the sink: batches under the cap, every row once, a task's file
    without a manifest left out, and the session's settings as they were."""
    segments.registered(spark)
    given, out = scratch("capped"), scratch("capped-out")
    segments.store_segments(wire(spark, 0, 100), given, 16)
    rows = spark.readStream.format("segments").options(path=given, startingOffsets="earliest", maxOffsetsPerTrigger=30).load().select("partition", "offset")
    none = segments.committed(spark, out, rows.schema, batch="batch")
    assert none.columns == ["partition", "offset", "batch"] and none.count() == 0
    for before in (None, "org.apache.spark.sql.execution.streaming.checkpointing.FileContextBasedCheckpointFileManager"):
        spark.conf.set(jobs.LOG_WRITER, before) if before else spark.conf.unset(jobs.LOG_WRITER)
        # Another checkpoint makes the same batches again, which adds nothing.
        jobs.drain(spark, rows.writeStream.format("two_phase").option("path", out).option("checkpointLocation", scratch("capped-checkpoint")))
        assert spark.conf.get(jobs.LOG_WRITER, None) == before
    spark.conf.unset(jobs.LOG_WRITER)
    spark.range(7, 8).selectExpr("cast(0 as int) as partition", "id as offset").write.mode("append").parquet(f"{out}/pending")
    stored = segments.committed(spark, out, rows.schema, batch="batch")
    assert dict(stored.dtypes) == {"partition": "int", "offset": "bigint", "batch": "bigint"}
    assert sorted(r.offset for r in stored.collect()) == list(range(100))
    spans = stored.groupBy("batch", "partition").agg((F.max("offset") - F.min("offset") + 1).alias("n")).groupBy("batch").agg(F.sum("n").alias("n")).collect()
    assert sorted(r.batch for r in spans) == list(range(len(spans))) and len(spans) >= 7
    assert max(r.n for r in spans) <= 30
    assert sorted(r.offset for r in segments.committed(spark, out, rows.schema).collect()) == list(range(100))


def test_the_capped_query_keeps_a_manifest_for_each_batch(spark, src, scratch, monkeypatch):
    """Its batches go to the sink, not each to a table of its own, and none is missing."""
    from chainlake.plans import transport

    made, plain = {}, transport.scratch
    monkeypatch.setattr(transport, "scratch", lambda spark, name: made.setdefault(name, plain(spark, name)))
    monkeypatch.setattr(transport, "PER_TRIGGER", 300)
    found = transport.offsets_per_trigger(src).collect()
    blocks = src.view("blocks").count()
    assert [tuple(r) for r in found] == [(blocks, blocks, True, True)]
    batches = sorted(int(f.removesuffix(".json")) for f in os.listdir(f"{made['a1-capped']}/commits") if f.endswith(".json"))
    assert batches == list(range(len(batches))) and len(batches) >= 15
