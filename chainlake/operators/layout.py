"""Writing tables: partitioning, sort order, file sizes, shards, commits."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from chainlake.functions import columns as C


def write_partitioned(df: DataFrame, path: str, by: list[str], mode: str = "overwrite",
                      max_records: int | None = None) -> None:
    """Partitioned Parquet. Dynamic overwrite replaces only the partitions present in
    ``df``. Rows are rebalanced: AQE splits a large partition over several tasks by its
    measured size, and joins small ones."""
    writer = df.hint("rebalance", *by).write.mode(mode).option("partitionOverwriteMode", "dynamic")
    if max_records:
        writer = writer.option("maxRecordsPerFile", max_records)
    writer.partitionBy(*by).parquet(path)


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def read_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A table's rows, or no rows when it does not exist yet. Any other failure to read it
    is raised, lest a table that can't be reached counts as empty."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as failure:
        if failure.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


V1 = "spark.sql.sources.useV1SourceList"


def read_with_statistics(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A table whose counts, smallest and largest values are taken from file footers, not from
    rows, where nothing but these is asked for (``explain`` shows ``PushedAggregation``)."""
    spark.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    before = spark.conf.get(V1)
    # Aggregates are pushed to readers of the second generation only.
    spark.conf.set(V1, ",".join(name for name in before.split(",") if name != "parquet"))
    try:
        return spark.read.schema(schema).parquet(path)
    finally:
        spark.conf.set(V1, before)


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def with_day(df: DataFrame, ts: str, name: str) -> DataFrame:
    """A date column to partition by, as file tables have no hidden partitioning."""
    return df.withColumn(name, F.to_date(ts))


def with_block_bucket(df: DataFrame, number: str = "block_number", width: int = C.BLOCKS_PER_BUCKET) -> DataFrame:
    return df.withColumn("block_bucket", C.block_bucket(F.col(number), width))


def block_filter(a: int, b: int, number: str = "block_number", width: int = C.BLOCKS_PER_BUCKET) -> Column:
    """Blocks a..b, with the matching condition on the bucket so that whole partitions
    are skipped."""
    return F.col(number).between(a, b) & F.col("block_bucket").between(a // width, b // width)


def write_sorted(df: DataFrame, path: str, order: list[str], max_records: int | None = None) -> None:
    """Parquet in global sort order: row groups hold narrow ranges and can be skipped."""
    writer = df.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite")
    if max_records:
        writer = writer.option("maxRecordsPerFile", max_records)
    writer.parquet(path)


# Bits of each of two interleaved values.
INTERLEAVED_BITS = 16


def spread_bits(c: Column) -> Column:
    """The lower 16 bits of a number with a zero between any two."""
    c = c.cast("bigint")
    for step, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
        c = c.bitwiseOR(F.shiftleft(c, step)).bitwiseAND(F.lit(mask).cast("bigint"))
    return c


def interleaved(first: Column, second: Column) -> Column:
    """Both numbers' bits in turn, so that neighbours in either stay near each other."""
    return F.shiftleft(spread_bits(first), 1).bitwiseOR(spread_bits(second))


def position(number: Column, low: int, high: int) -> Column:
    """Place between the lowest and highest value, in as many steps as are interleaved."""
    steps = (1 << INTERLEAVED_BITS) - 1
    return F.coalesce(F.floor((number - F.lit(low)) * F.lit(float(steps)) / F.lit(max(1, high - low))), F.lit(0)).cast("bigint")


def address_position(address: Column) -> Column:
    """Place of an address by its first digits behind ``0x``, which are spread evenly."""
    return F.coalesce(F.conv(F.substring(address, 3, INTERLEAVED_BITS // 4), 16, 10).cast("bigint"), F.lit(0))


def write_for_lookups(df: DataFrame, path: str, hash_column: str, number: str, address: str,
                      distinct_hashes: int = 1_000_000, row_group_bytes: int | None = None) -> None:
    """Parquet for lookups by hash, by number range or by address. Row groups have a Bloom
    filter of the hash, sized for so many hashes in each; number and address are interleaved,
    so that either's smallest and largest values in a row group are close together. The rows are
    computed once, as they are needed three times: for the borders, for the ranges, to be sorted."""
    aside = f"{path}-unordered"
    df.write.mode("overwrite").parquet(aside)
    rows = read_table(df.sparkSession, aside, df.schema)
    low, high = rows.agg(F.min(number), F.max(number)).first()
    place = interleaved(position(F.col(number), low or 0, high or 0), address_position(F.col(address)))
    placed = rows.withColumn("_place", place)
    writer = (
        placed.repartitionByRange("_place", address).sortWithinPartitions("_place", address).drop("_place").write.mode("overwrite")
        .option(f"parquet.bloom.filter.enabled#{hash_column}", "true")
        .option(f"parquet.bloom.filter.expected.ndv#{hash_column}", str(distinct_hashes))
    )
    if row_group_bytes:
        writer = writer.option("parquet.block.size", str(row_group_bytes))
    writer.parquet(path)
    left = df.sparkSession._jvm.org.apache.hadoop.fs.Path(aside)
    left.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(left, True)


def shard(key: Column, shards: int) -> Column:
    """Shard of a key, the same on every run."""
    return F.pmod(F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("bigint"), F.lit(shards))


def write_bucketed(df: DataFrame, table: str, key: str, shards: int, path: str) -> None:
    """A table bucketed by key: joins and groupings on the key need no shuffle."""
    df.write.mode("overwrite").option("path", path).bucketBy(shards, key).sortBy(key).saveAsTable(table)


def delete_where(df: DataFrame, condition: str) -> DataFrame:
    """The rows that stay. Rows for which the condition is unknown stay as well."""
    return df.where(f"not coalesce({condition}, false)")


def delete_from(spark: SparkSession, table: str, condition: str) -> DataFrame:
    """The same as a DELETE, for catalogs with row-level commands."""
    return spark.sql(f"delete from {table} where {condition}")


def schema_breaks(old: StructType, new: StructType, defaults: set[str] = frozenset()) -> list[str]:
    """Why ``new`` cannot read data written as ``old``: fields must stay as they are, and
    added ones need a default."""
    have = {f.name: f.dataType for f in new}
    problems = []
    for f in old:
        if f.name not in have:
            problems.append(f"{f.name}: removed")
        elif have[f.name] != f.dataType:
            problems.append(f"{f.name}: {f.dataType.simpleString()} became {have[f.name].simpleString()}")
    known = {f.name for f in old}
    problems += [f"{f.name}: added without default" for f in new if f.name not in known and f.name not in defaults]
    return problems


def read_as(spark: SparkSession, path: str, schema: StructType, defaults: dict[str, object]) -> DataFrame:
    """Read files of older schema versions; fields they lack take their default."""
    df = spark.read.schema(schema).parquet(path)
    return df.select(
        *[
            F.coalesce(F.col(f.name), F.lit(defaults[f.name]).cast(f.dataType)).alias(f.name)
            if f.name in defaults else F.col(f.name)
            for f in schema
        ]
    )
