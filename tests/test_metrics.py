"""Samples of one series at one time."""

import datetime
import itertools

from chainlake.operators import metrics

SCHEMA = "ts timestamp, metric string, chain string, job string, provider string, value double"


def test_ties_do_not_depend_on_the_order_of_rows(spark):
    at = [datetime.datetime(2024, 1, 1, 0, m) for m in (0, 1, 1, 2)]
    samples = [(t, "m", "c", "j", "p", v) for t, v in zip(at, (5.0, 9.0, 7.0, 8.0))]
    for rows in itertools.permutations(samples):
        df = spark.createDataFrame(list(rows), SCHEMA).coalesce(1)
        assert [(r.ts.minute, r.value, r.delta) for r in metrics.increments(df).orderBy("ts", "value").collect()] == [(0, 5, 0), (1, 7, 2), (1, 9, 2), (2, 8, 8)]
        early = df.where("minute(ts) < 2")
        assert metrics.latest_value(early).first().value == 9
        assert metrics.last_over_time(early, "1 hour").first().value == 9
