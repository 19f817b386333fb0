"""Most frequent keys and lookups: exact, and cheaper than reading or grouping everything."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from chainlake.operators import heavy, layout, quality

KEYS = "a string, b string"


def plain(rows, k):
    order = lambda e: (-e[1], *[(v is not None, v or "") for v in e[0]])
    return [(*key, n) for key, n in sorted(Counter(rows).items(), key=order)[:k]]


def pairs(kind):
    rnd = random.Random(5)
    name = lambda n: rnd.choice([None, *[f"x{i}" for i in range(n)]])
    match kind:
        case "hot":
            return [("h", "h")] * 900 + [(name(40), name(40)) for _ in range(2000)]
        case "flat":
            return [(f"k{i}", None) for i in range(1500)]
        case "tied":
            return [(f"k{i % 97}", f"k{i % 89}") for i in range(97 * 89 // 2)]
        case "few":
            return [("one", None)] * 3 + [(None, "two")] * 3 + [(None, None)] * 2
    return []


@pytest.mark.parametrize("cells", [1, 16, 1 << 16])
@pytest.mark.parametrize("kind", ["hot", "flat", "tied", "few", "none"])
def test_most_frequent_equals_counting_everything(spark, monkeypatch, kind, cells):
    monkeypatch.setattr(heavy, "CELLS", cells)
    data = pairs(kind)
    rows = spark.createDataFrame(data, KEYS).repartition(4)
    assert [tuple(r) for r in heavy.most_frequent(rows, ["a", "b"], 10).collect()] == plain(data, 10)


def test_tables_of_parts_add_up(spark):
    data = pairs("hot")
    parts = [spark.createDataFrame(data[i::3], KEYS) for i in range(3)]
    whole = spark.createDataFrame(data, KEYS)
    table = heavy.merged([heavy.counts(p, ["a", "b"]) for p in parts])
    assert sorted(map(tuple, table.collect())) == sorted(map(tuple, heavy.counts(whole, ["a", "b"]).collect()))
    assert [tuple(r) for r in heavy.most_frequent(whole, ["a", "b"], 5, table).collect()] == plain(data, 5)


def scanned(df):
    """Rows that the scan of an executed plan read."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    while plan.children().size():
        plan = plan.children().head()
    if plan.nodeName().startswith("AdaptiveSparkPlan"):
        plan = plan.executedPlan()
    leaves = plan.collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_lookups_read_a_small_part(spark, scratch):
    n = 80_000
    rows = spark.range(n).select(
        F.concat(F.lit("0x"), F.sha2(F.col("id").cast("string"), 256)).alias("tx_hash"),
        (F.col("id") % 4000).alias("block_number"),
        F.concat(F.lit("0x"), F.md5((F.col("id") * 7 % 900).cast("string"))).alias("sender"))
    path = scratch("lookups")
    layout.write_for_lookups(rows, path, "tx_hash", "block_number", "sender", 2_000, 50_000)
    stored = spark.read.schema(rows.schema).parquet(path)
    assert stored.count() == n and stored.exceptAll(rows).count() == 0
    for row in rows.where("id % 20011 = 3").collect():
        found = stored.where(F.col("tx_hash") == row.tx_hash)
        assert [tuple(r) for r in found.collect()] == [tuple(row)]
        assert scanned(found) <= n / 50
    sender = rows.first().sender
    assert scanned(stored.where(F.col("sender") == sender)) <= n / 6
    assert scanned(stored.where("block_number between 100 and 120")) <= n / 6
    nowhere = stored.where(F.col("tx_hash") == F.lit("0x" + "7" * 64))
    assert nowhere.count() == 0


def test_rows_for_lookups_are_computed_once(spark, scratch):
    made = spark.sparkContext.accumulator(0)

    @F.udf("bigint")
    def counted(n):
        made.add(1)
        return n % 40

    rows = spark.range(500).select(
        F.sha2(F.col("id").cast("string"), 256).alias("tx_hash"), counted("id").alias("block_number"),
        F.md5(F.col("id").cast("string")).alias("sender"))
    path = scratch("once")
    layout.write_for_lookups(rows, path, "tx_hash", "block_number", "sender")
    assert made.value == 500
    assert spark.read.parquet(path).count() == 500
    assert layout.read_table(spark, f"{path}-unordered", rows.schema).count() == 0


def test_bits_are_interleaved(spark):
    rnd = random.Random(2)
    data = [(rnd.randrange(1 << 16), rnd.randrange(1 << 16)) for _ in range(200)] + [(0, 65535), (65535, 0)]
    got = spark.createDataFrame(data, "a int, b int").select(layout.interleaved(F.col("a"), F.col("b")))
    turn = lambda a, b: int("".join(x + y for x, y in zip(f"{a:016b}", f"{b:016b}", strict=True)), 2)
    assert [r[0] for r in got.collect()] == [turn(a, b) for a, b in data]


def test_a_replay_reads_the_buckets_it_touches(spark, scratch):
    stored = spark.range(2000).select(
        F.col("id").alias("block"), F.floor(F.col("id") / 100).alias("block_bucket"))
    path = scratch("replay")
    layout.write_partitioned(stored, path, ["block_bucket"])
    table = spark.read.schema(stored.schema).parquet(path)
    replay = spark.range(1950, 2050).select(
        F.col("id").alias("block"), F.floor(F.col("id") / 100).alias("block_bucket"), F.col("id").alias("kafka_offset"))
    fresh = quality.not_yet_stored(replay, table, ["block"], "block_bucket")
    assert sorted(r.block for r in fresh.collect()) == list(range(2000, 2050))
    assert "dynamicpruning" in fresh._jdf.queryExecution().executedPlan().toString()
