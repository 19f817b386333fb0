"""Topics as DataFrames: reading, wire format, payload decoding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chainlake.functions import schemas

# The wire header: one magic byte and a four-byte schema id.
HEADER_BYTES = 5


def stream_source(
    spark: SparkSession,
    *,
    servers: str | None = None,
    topic: str | None = None,
    path: str | None = None,
    schema: str = schemas.KAFKA_ROW,
    starting: str = "latest",
    max_per_trigger: int | None = None,
    min_partitions: int | None = None,
) -> DataFrame:
    """Subscribe to a topic, or to a folder of Parquet files with the given columns.

    ``max_per_trigger`` caps offsets (topic) or files (folder) per micro-batch.
    """
    if servers:
        reader = (
            spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", servers)
            .option("subscribe", topic)
            .option("startingOffsets", starting)
            .option("failOnDataLoss", "true")
        )
        if max_per_trigger:
            reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
        if min_partitions:
            reader = reader.option("minPartitions", min_partitions)
        return reader.load()
    reader = spark.readStream.schema(schema)
    if max_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_per_trigger)
    return reader.parquet(path)


def bounded_source(
    spark: SparkSession,
    *,
    servers: str | None = None,
    topic: str | None = None,
    path: str | None = None,
) -> DataFrame:
    """Everything a topic (or folder) holds now, read once."""
    if servers:
        return (
            spark.read.format("kafka")
            .option("kafka.bootstrap.servers", servers)
            .option("subscribe", topic)
            .option("startingOffsets", "earliest")
            .option("endingOffsets", "latest")
            .load()
        )
    return spark.read.schema(schemas.KAFKA_ROW).parquet(path)


def to_wire(
    df: DataFrame, key: Column, record: list[str], schema_id: int = 7
) -> DataFrame:
    """Rows as they travel on a topic: header bytes, then the record."""
    header = F.unhex(F.lit(f"{0:02x}{schema_id:08x}"))
    body = F.encode(F.to_json(F.struct(*record)), "UTF-8")
    return df.select(
        F.encode(key, "UTF-8").alias("key"),
        F.concat(header, body).alias("value"),
        F.col("kafka_topic").alias("topic"),
        F.col("kafka_partition").alias("partition"),
        F.col("kafka_offset").alias("offset"),
        F.col("kafka_timestamp").alias("timestamp"),
    )


def strip_wire_header(value: Column) -> Column:
    """The payload behind the header; empty when the value is shorter than the header."""
    rest = F.greatest(F.length(value) - HEADER_BYTES, F.lit(0))
    return F.substring(value, F.lit(HEADER_BYTES + 1), rest)


def schema_id(value: Column) -> Column:
    return F.conv(F.hex(F.substring(value, 2, 4)), 16, 10).cast("bigint")


def decode(payload: Column, schema: str, fmt: str = "json") -> Column:
    """Decode a payload permissively. ``schema`` is DDL for JSON and a JSON schema document
    for Avro, which needs Spark's Avro module on the classpath."""
    if fmt == "json":
        return F.from_json(F.decode(payload, "UTF-8"), schemas.struct(schema))
    if fmt == "avro":
        from pyspark.sql.avro.functions import from_avro

        return from_avro(payload, schema, {"mode": "PERMISSIVE"})
    raise ValueError(f"unknown payload format {fmt!r}")


def kafka_metadata(key_as_text: bool = True) -> list[Column]:
    key = [F.col("key").cast("string").alias("kafka_key")] if key_as_text else []
    return key + [
        F.col("topic").alias("kafka_topic"),
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        F.col("timestamp").alias("kafka_timestamp"),
        F.to_date("timestamp").alias("kafka_date"),
    ]


def decode_records(rows: DataFrame, schema: str, fmt: str = "json") -> DataFrame:
    """Wire rows to record columns followed by the Kafka coordinates."""
    body = decode(strip_wire_header(F.col("value")), schema, fmt)
    return rows.select(body.alias("r"), *kafka_metadata()).select(
        "r.*", *[c for c in ("kafka_key", "kafka_topic", "kafka_partition", "kafka_offset",
                             "kafka_timestamp", "kafka_date")]
    )
