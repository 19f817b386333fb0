"""Streaming jobs: appends, continuous views, windowed counts, progress as data."""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery, StreamingQueryListener

from chainlake.functions import columns as C
from chainlake.operators import layout, quality
from chainlake.session import scratch

# Fixed value: trigger of the realtime jobs.
REALTIME_TRIGGER = "60 seconds"

# What writes a stream's offsets and commits, and Spark's writer that needs no process of its own for a rename.
LOG_WRITER = "spark.sql.streaming.checkpointFileManagerClass"
BY_FILE_SYSTEM = "org.apache.spark.sql.execution.streaming.checkpointing.FileSystemBasedCheckpointFileManager"


def start(
    rows: DataFrame, path: str, checkpoint: str, *, every: str | None = None,
    partition_by: list[str] | None = None,
) -> StreamingQuery:
    """Append a stream to a Parquet table: everything there is now, or (``every``) on a
    fixed trigger. Backfill and realtime runs share the checkpoint."""
    writer = rows.writeStream.format("parquet").outputMode("append")
    writer = writer.option("checkpointLocation", checkpoint).option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def append(rows: DataFrame, path: str, checkpoint: str, **kw) -> DataFrame:
    """Run an append to its end and read the table."""
    start(rows, path, checkpoint, **kw).awaitTermination()
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def appended(spark: SparkSession, rows: DataFrame, name: str) -> DataFrame:
    """An append to a fresh table in the shared folder."""
    return append(rows, scratch(spark, name), scratch(spark, f"{name}-checkpoint"))


def for_each(rows: DataFrame, work: Callable[[DataFrame, int], None], checkpoint: str,
             mode: str = "append") -> StreamingQuery:
    return (
        rows.writeStream.foreachBatch(work).outputMode(mode)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def drain(spark: SparkSession, writer: DataStreamWriter) -> None:
    """Run a stream in batches as its source caps them until nothing waits, for sources that an
    available-now trigger reads in one batch. The checkpoint must be this query's own: on a local
    folder its log is written through Hadoop's FileSystem, where a rename replaces. Spark's default
    starts processes there to look for links, which took a fifth of a small batch."""
    before = spark.conf.get(LOG_WRITER, None)
    spark.conf.set(LOG_WRITER, BY_FILE_SYSTEM)
    try:
        # The query keeps the settings it starts with.
        running = writer.trigger(processingTime="0 seconds").start()
    finally:
        spark.conf.set(LOG_WRITER, before) if before else spark.conf.unset(LOG_WRITER)
    try:
        running.processAllAvailable()
    finally:
        running.stop()


def fan_out(rows: DataFrame, sinks: dict[str, str | None], checkpoint: str) -> list[StreamingQuery]:
    """One source, several sinks (path: trigger, or all there is), each a query with its own
    checkpoint, so that none waits for another."""
    return [start(rows, path, f"{checkpoint}/{i}", every=every) for i, (path, every) in enumerate(sinks.items())]


def tumbling_count(rows: DataFrame, ts: str = "kafka_timestamp", seconds: int = 10) -> DataFrame:
    """Rows per block and window of time."""
    return (
        rows.groupBy("block_height", F.window(ts, f"{seconds} seconds").alias("w"))
        .agg(F.count(F.lit(1)).alias("cnt"))
        .select("block_height", F.col("w.start").alias("window_start"),
                F.col("w.end").alias("window_end"), "cnt")
    )


WINDOW_KEY = ["block_height", "window_start"]


def keyed_records(counts: DataFrame, keys: list[str] = WINDOW_KEY) -> DataFrame:
    """Key and value JSON of an upsert topic."""
    return counts.select(
        F.to_json(F.struct(*keys)).alias("key"), F.to_json(F.struct(*counts.columns)).alias("value")
    )


def upsert_counts(rows: DataFrame, path: str, checkpoint: str, ts: str | None = "kafka_timestamp") -> DataFrame:
    """Windowed counts of a stream as a table by key. Every batch adds its own counts under
    its batch id, and a key's value is their sum: rows may come in any order and however
    late, and no state is kept. Without ``ts`` windows are of processing time."""

    def work(batch: DataFrame, batch_id: int) -> None:
        timed = batch if ts else batch.withColumn("proc_time", F.current_timestamp())
        tumbling_count(timed, ts or "proc_time").write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    for_each(rows, work, checkpoint).awaitTermination()
    added = rows.sparkSession.read.parquet(path)
    return added.groupBy(*WINDOW_KEY, "window_end").agg(F.sum("cnt").alias("cnt"))


def append_new(rows: DataFrame, path: str, checkpoint: str, keys: list[str], order: str,
               block: str = "block_height", width: int = C.BLOCKS_PER_BUCKET) -> DataFrame:
    """Append the first delivery of each key. A batch drops what earlier batches stored,
    reading only the block buckets it touches; a repeated batch replaces its folder."""
    return stored_keys_left_out(rows, path, checkpoint, keys, order, block, width)


def stored_keys_left_out(
    rows: DataFrame, path: str, checkpoint: str, keys: list[str], order: str, block: str, width: int, aside: str | None = None
) -> DataFrame:
    """Append rows whose key no earlier batch has stored, the first of each key. A batch that
    can be computed only once, as state changes with it, is first written ``aside``."""
    schema = T.StructType([*rows.schema, T.StructField("block_bucket", T.LongType()), T.StructField("batch", T.LongType())])

    def work(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if aside:
            batch.write.mode("overwrite").parquet(f"{aside}/{batch_id}")
            batch = spark.read.schema(batch.schema).parquet(f"{aside}/{batch_id}")
        # Rows without a block form a bucket of their own.
        fresh = batch.withColumn("block_bucket", F.coalesce(C.block_bucket(F.col(block), width), F.lit(-1)))
        stored = layout.read_table(spark, path, schema).where(F.col("batch") < batch_id)
        touched = quality.in_touched_buckets(stored, fresh, "block_bucket")
        # As fields of a struct, absent keys equal each other.
        known = touched.select(F.struct(*keys).alias("_key")).distinct()
        new = quality.dedup(fresh, keys, order).withColumn("_key", F.struct(*keys)).join(known, "_key", "left_anti")
        new.select(*fresh.columns).write.mode("overwrite").partitionBy("block_bucket").parquet(f"{path}/batch={batch_id}")

    for_each(rows, work, checkpoint).awaitTermination()
    return layout.read_table(rows.sparkSession, path, schema).select(*rows.columns)


class ProgressToTable(StreamingQueryListener):
    """Collects the progress of running queries as rows of a metrics table."""

    # Columns of the metrics table.
    COLUMNS = (
        "query_id string, batch_id bigint, at string, rows bigint, source string, "
        "start_offset string, end_offset string, latest_offset string"
    )

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.ended = threading.Event()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended.set()

    def onQueryProgress(self, event) -> None:
        p = event.progress
        rows = [
            (str(p.id), p.batchId, p.timestamp, s.numInputRows, s.description,
             str(s.startOffset), str(s.endOffset), str(s.latestOffset))
            for s in p.sources
        ]
        self.spark.createDataFrame(rows, self.COLUMNS).coalesce(1).write.mode("append").parquet(self.path)


def recorded(spark: SparkSession, run: Callable[[], StreamingQuery], path: str, wait: float = 60.0) -> DataFrame:
    """Run a query to its end while its progress is recorded, and read the table: a row per
    batch and source, however many batches there are."""
    listener = ProgressToTable(spark, path)
    spark.streams.addListener(listener)
    try:
        running = run()
        running.awaitTermination()
        # Events arrive in order and after the query's end.
        if not listener.ended.wait(wait):
            raise TimeoutError("the query's last progress has not arrived")
    finally:
        spark.streams.removeListener(listener)
    return spark.read.schema(ProgressToTable.COLUMNS).parquet(path).where(F.col("query_id") == str(running.id))
