"""What the text operators share: session settings, tables, written intermediates."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from chainlake.session import prepare, scratch

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# Rows and bytes of one Arrow batch, whichever comes first: bound a Python worker's memory
# when texts are long.
BATCH_ROWS = 1000
BATCH_BYTES = 16 << 20


def ready(spark: SparkSession) -> SparkSession:
    """Session settings for the text operators; safe to call repeatedly."""
    prepare(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ready(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write rows to the shared folder and read them back: what is used twice is computed
    once, and later stages start from files that survive lost executors."""
    spark = df.sparkSession
    path = scratch(spark, name)
    # What is written is not shuffled again, so its shuffle files can go at once.
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    made = spark.read.schema(df.schema).parquet(path)
    made._stored = path
    return made


def dropped(*tables: DataFrame) -> None:
    """Remove tables made by :func:`written` that nothing reads any more: all that was derived
    from them has been written as well."""
    for made in tables:
        jvm = made.sparkSession._jvm
        path = jvm.org.apache.hadoop.fs.Path(made._stored)
        path.getFileSystem(made.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def by_batch(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """Apply ``fn`` to each Arrow batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                out = fn(batch)
                if out is not None and out.num_rows:
                    yield out

    return df.mapInArrow(run, schema)


def gathered(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.Table]:
    """Join small batches until ``column`` holds ``limit`` bytes."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += batch.column(batch.schema.get_field_index(column)).nbytes
            if size >= limit:
                yield pa.Table.from_batches(held)
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def in_slices(table: pa.Table, rows: int = BATCH_ROWS) -> Iterator[pa.RecordBatch]:
    yield from table.to_batches(max_chunksize=rows)
