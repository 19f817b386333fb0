"""Answers from file footers and from payloads parsed once."""

from pyspark.sql import functions as F

from chainlake.operators import layout, silver


def test_footers_answer(spark, scratch):
    path = scratch("footers")
    rows = spark.range(1000).select(F.col("id"), (F.col("id") % 3).cast("int").alias("part"))
    rows.write.partitionBy("part").parquet(path)
    stored = layout.read_with_statistics(spark, path, rows.schema)
    whole = stored.agg(F.max("id").alias("last"), F.min("id").alias("first"), F.count("*").alias("n"))
    assert tuple(whole.first()) == (999, 0, 1000)
    marks = stored.groupBy("part").agg(F.max("id").alias("mark"))
    assert sorted(map(tuple, marks.collect())) == [(0, 999), (1, 997), (2, 998)]
    for df in (whole, marks):
        plan = df._jdf.queryExecution().toString()
        assert "PushedAggregation: [" in plan and "PushedAggregation: []" not in plan
    # Other readers are left as they were.
    assert "PushedAggregation" not in spark.read.parquet(path).agg(F.max("id"))._jdf.queryExecution().toString()


def test_payloads_parsed_once(spark):
    raw = ['{"a": "x", "b": {"c": 1}, "d": null}', '{"a": "cut', "", None, '{"a": 5}']
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(raw)], "id int, raw string")
    got = silver.members(silver.parsed_once(rows), ["id"], {"a": "a", "b.c": "c", "d": "d"}).collect()
    assert sorted(map(tuple, got)) == [(0, "x", "1", None), (1, None, None, None), (2, None, None, None), (3, None, None, None), (4, "5", None, None)]
