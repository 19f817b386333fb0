"""B: table layout and maintenance."""

from __future__ import annotations

from pyspark.sql import functions as F

from chainlake.operators import layout, silver
from chainlake.plans import sqltext as S
from chainlake.plans.common import parsed_tx, state_table
from chainlake.plans.registry import query
from chainlake.session import scratch

# Blocks per partition in the registered query; tables use layout's default.
BUCKET = 1_000


@query("b1_partition_identity", f"""with {S.STATEJ} select cast(kafka_date as varchar) as kafka_date, count(*) as n,
    max(checkpoint_block) as last_block from st group by kafka_date""", "state")
def partition_identity(src):
    path = scratch(src.spark, "b1")
    layout.write_partitioned(state_table(src), path, ["kafka_date"])
    return src.spark.read.parquet(path).groupBy("kafka_date").agg(
        F.count(F.lit(1)).alias("n"), F.max("checkpoint_block").alias("last_block"))


@query("b2_partition_days", """select cast(cast(block_ts as date) as varchar) as block_day, count(*) as n,
    min(block_number) as first_block, max(block_number) as last_block from headers
    where block_ts >= TIMESTAMP '2024-01-02' group by 1""", "headers")
def partition_days(src):
    """A condition on the day skips whole partitions."""
    path = scratch(src.spark, "b2")
    layout.write_partitioned(layout.with_day(src.view("headers"), "block_ts", "block_day"), path, ["block_day"])
    rows = src.spark.read.parquet(path).where("block_day >= date '2024-01-02'")
    return rows.groupBy("block_day").agg(
        F.count(F.lit(1)).alias("n"), F.min("block_number").alias("first_block"),
        F.max("block_number").alias("last_block"))


@query("b3_partition_block_bucket", f"""select cast(floor(block_number / {BUCKET}) as bigint) as block_bucket, count(*) as n,
    min(block_number) as first_block from headers where block_number >= 500 group by 1""", "headers")
def partition_block_bucket(src):
    path = scratch(src.spark, "b3")
    layout.write_partitioned(layout.with_block_bucket(src.view("headers"), width=BUCKET), path, ["block_bucket"])
    rows = src.spark.read.parquet(path).where(layout.block_filter(500, 2**40, width=BUCKET))
    return rows.groupBy(F.col("block_bucket").cast("bigint").alias("block_bucket")).agg(
        F.count(F.lit(1)).alias("n"), F.min("block_number").alias("first_block"))


@query("b4_sorted_layout", "select block_height, kafka_partition, kafka_offset, run_id from logs", "logs")
def sorted_layout(src):
    path = scratch(src.spark, "b4")
    order = ["block_height", "kafka_partition", "kafka_offset"]
    layout.write_sorted(src.view("logs").select(*order, "run_id"), path, order)
    return src.spark.read.parquet(path)


TX_LOOKUP_SQL = f"select j_hash as tx_hash, block_height as block_number, {S.addr('j_from')} as from_address from p"


def stored_for_lookups(src):
    path = scratch(src.spark, "b4-lookups")
    tx = parsed_tx(src, "tx_hash", "block_number", "from_address")
    layout.write_for_lookups(tx, path, "tx_hash", "block_number", "from_address")
    return layout.read_table(src.spark, path, tx.schema)


@query("b4_interleaved_layout", f"with {S.TXJ} {TX_LOOKUP_SQL}", "tx")
def interleaved_layout(src):
    return stored_for_lookups(src)


@query("c8_hash_lookup", f"""with {S.TXJ}, t as ({TX_LOOKUP_SQL}) select * from t
    where tx_hash = (select max(tx_hash) from t)""", "tx")
def hash_lookup(src):
    """The transactions of one hash; row groups whose Bloom filter lacks it are skipped."""
    stored = stored_for_lookups(src)
    wanted = stored.agg(F.max("tx_hash")).first()[0]
    return stored.where(F.col("tx_hash") == F.lit(wanted))


@query("c8_address_lookup", f"""with {S.TXJ}, t as ({TX_LOOKUP_SQL}) select * from t
    where from_address = (select max(from_address) from t)""", "tx")
def address_lookup(src):
    """The transactions of one sender; row groups of other senders are skipped by their borders."""
    stored = stored_for_lookups(src)
    wanted = stored.agg(F.max("from_address")).first()[0]
    return stored.where(F.col("from_address") == F.lit(wanted))


@query("b5_file_sizing", "select count(*) as n, true as within_limit from tx", "tx")
def file_sizing(src):
    """Files hold at most the given number of records."""
    path, limit = scratch(src.spark, "b5"), 5_000
    layout.write_sorted(src.view("tx").select("block_height", "kafka_offset"), path,
                        ["block_height", "kafka_offset"], max_records=limit)
    sizes = src.spark.read.parquet(path).groupBy(F.input_file_name()).count()
    return sizes.agg(F.sum("count").alias("n"), (F.max("count") <= limit).alias("within_limit"))


@query("b6_hash_shard", f"""with {S.TXJ} select cast(try_cast('0x' || substr(sha256(j_hash), 1, 8) as bigint) % 16 as bigint) as shard,
    count(*) as n from p group by 1""", "tx")
def hash_shard(src):
    tx = silver.parse_tx(src.view("tx"), [], "hash")
    return tx.groupBy(layout.shard(F.col("hash"), 16).alias("shard")).agg(F.count(F.lit(1)).alias("n"))


@query("b6_bucketed_table", f"""with {S.TXJ} select j_hash as tx_hash, count(*) as copies, max(kafka_offset) as last_offset
    from p group by j_hash""", "tx")
def bucketed_table(src):
    """Grouping a bucketed table by its key needs no shuffle. Buckets are even, as the key
    is the transaction hash."""
    path = scratch(src.spark, "b6")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    tx = silver.parse_tx(src.view("tx"), ["kafka_offset"], "hash").withColumnRenamed("hash", "tx_hash")
    layout.write_bucketed(tx, name, "tx_hash", 16, path)
    return src.spark.table(name).groupBy("tx_hash").agg(
        F.count(F.lit(1)).alias("copies"), F.max("kafka_offset").alias("last_offset"))


PRODUCER = {"pod_uid": "uid-1", "pod_name": "pod-1", "run_id": "run-1", "mode": "checkpoint",
            "started_at": "2024-01-01T00:00:00.000Z"}


@query("b9_delete_where", "select kafka_key, kafka_offset from state where kafka_key not like '%.%'", "state")
def delete_where(src):
    return layout.delete_where(src.view("state"), "kafka_key like '%.%'").select("kafka_key", "kafka_offset")


@query("b11_schema_evolution_check", """select block_height, kafka_offset, case when kafka_partition = 0 then inserted_at else 'unknown' end as inserted_at,
    0 as problems_ok, 1 as problems_bad from logs""", "logs")
def schema_evolution_check(src):
    """Files of an older and a newer schema version are read as the newer one."""
    path = scratch(src.spark, "b11")
    new = src.view("logs").select("block_height", "kafka_offset", "inserted_at", "kafka_partition")
    old = new.drop("inserted_at")
    layout.append(old.where("kafka_partition <> 0"), path)
    layout.append(new.where("kafka_partition = 0"), path)
    ok = layout.schema_breaks(old.schema, new.schema, {"inserted_at"})
    bad = layout.schema_breaks(old.schema, new.schema)
    rows = layout.read_as(src.spark, path, new.schema, {"inserted_at": "unknown"})
    return rows.select("block_height", "kafka_offset", "inserted_at", F.lit(len(ok)).alias("problems_ok"),
                       F.lit(len(bad)).alias("problems_bad"))
