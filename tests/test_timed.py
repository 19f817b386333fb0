"""Streams with watermarks, timers and state that is forgotten."""

import datetime
from collections import Counter

import pytest
from pyspark.sql import functions as F

from chainlake.operators import ranges
from chainlake.streaming import jobs, stateful, timed
from chainlake.streaming.timed import TimedLifecycle

START = datetime.datetime(2024, 1, 1)


def at(minutes):
    return START + datetime.timedelta(minutes=minutes)


def in_batches(spark, scratch, batches, schema):
    """A stream that takes one batch of rows at a time."""
    path = scratch("batches")
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def test_windows_are_appended_once_and_late_rows_kept(spark, scratch):
    """Windows of ten minutes, rows five minutes late at the most: a row of a window that has
    ended goes to the late rows, whole."""
    schema = "k string, ts timestamp, n bigint"
    batches = [
        [("a", at(1), 1), ("a", at(12), 2), ("b", at(3), 3)],  # watermark 7 behind it
        [("a", at(4), 4), ("a", at(31), 5), ("b", None, 6)],   # 26: windows to 10 and 20 end
        [("a", at(9), 7), ("b", at(15), 8), ("a", at(33), 9)],  # both late
    ]
    rows = in_batches(spark, scratch, batches, schema)
    made = timed.append_windows(rows, ["k"], "ts", 600, "5 minutes", scratch("w"), scratch("w-checkpoint"))
    counts = lambda df: sorted((r.k, r.window_start, r.cnt) for r in df.collect())
    assert counts(made.closed()) == [("a", at(0), 2), ("a", at(10), 1), ("b", at(0), 1)]
    assert counts(made.open()) == [("a", at(30), 2)]
    assert sorted((r.k, r.ts, r.n) for r in made.late().collect()) == [("a", at(9), 7), ("b", at(15), 8)]
    operators = timed.state_operators(spark, made.checkpoint).collect()
    assert [o.operatorName for o in operators] == ["transformWithStateInPandasExec"]


def test_first_deliveries_with_state_that_is_forgotten(spark, scratch):
    """A key that the state has forgotten is found in the table, and the state is small."""
    schema = "block_height bigint, kafka_offset bigint, note string"
    batches = [[(b, 100 * i + b, f"é{i}\n") for b in range(i * 10, i * 10 + 15)] + [(3, 1000 + i, "again"), (None, 5 + i, None)] for i in range(4)]
    rows = in_batches(spark, scratch, batches, schema)
    checkpoint = scratch("f-checkpoint")
    got = timed.append_new_with_state(rows, scratch("f"), checkpoint, ["block_height"], "kafka_offset", 0.001)
    first = {}
    for batch in batches:
        for r in sorted(batch, key=lambda r: r[1]):
            first.setdefault(r[0], r)
    assert Counter(map(tuple, got.collect())) == Counter(first.values())
    # Of the 46 keys at most those of the last two batches are still known.
    assert timed.state_table(spark, checkpoint, "seen").count() <= 34


EVENTS = "job string, range_id bigint, seq bigint, kind string, detail string, ts timestamp"


def test_deadlines(spark, scratch):
    """Results in time, late, and never; the batch operator and the timers agree."""
    data = [
        ("j", 1, 1, "submitted", "a", at(0)), ("j", 1, 2, "done", "b", at(9)),
        ("j", 2, 3, "submitted", "a", at(0)), ("j", 2, 4, "done", "b", at(10)),
        ("j", 3, 5, "submitted", "a", at(1)),
        ("j", 4, 6, "submitted", "a", at(2)), ("j", 4, 7, "error", "e", at(3)), ("j", 4, 8, "submitted", "a", at(4)),
        ("j", 5, 9, "submitted", "a", at(60)),
        *[("j", 6, 10 + i, "submitted", "a", at(11 * i)) for i in range(5)],
        ("j", 7, 20, "planned", "x", at(90)),
    ]
    batches = [data[:6], data[6:]]
    rows = in_batches(spark, scratch, batches, EVENTS)
    path, checkpoint = scratch("t"), scratch("t-checkpoint")
    states = timed.timed_lifecycle(rows, "ts", 600, "20 minutes")
    jobs.for_each(states, lambda b, i: b.write.mode("overwrite").parquet(f"{path}/batch={i}"), checkpoint, mode="update").awaitTermination()
    last = {}
    for r in sorted(spark.read.parquet(path).collect(), key=lambda r: r.batch):
        last[r.range_id] = (r.status, r.retry, r.last_error)
    events = spark.createDataFrame(data, EVENTS)
    until = events.select(F.max("ts") - F.expr("interval 20 minutes")).scalar()
    batch = {r.range_id: (r.status, r.retry, r.last_error) for r in ranges.lifecycle(ranges.with_timeouts(events, "ts", 600, until)).collect()}
    assert last == batch
    assert batch[1] == ("DONE", 0, None) and batch[2] == ("DONE", 1, "timeout") and batch[3] == ("RETRYING", 1, "timeout")
    assert batch[4] == ("RETRYING", 2, "timeout") and batch[5] == ("RETRYING", 1, "timeout")
    assert batch[6] == ("FAILED", 4, "timeout") and batch[7] == ("PLANNED", 0, None)
    kept = {r.range_id: (r.status, r.retry, r.last_error) for r in timed.state_table(spark, checkpoint, "range").collect()}
    assert kept == last


@pytest.mark.parametrize("gap, fails", [(599_999, False), (600_000, True)])
def test_deadline_is_reached_at_its_time(gap, fails):
    machine = TimedLifecycle(3, 600_000)
    state = machine.heard(("PLANNED", 0, None, None, None), "submitted", "a", 0, 1)
    assert state == ("INFLIGHT", 0, None, 600_000, 1)
    assert machine.heard(state, "done", "b", gap, 2)[:2] == ("DONE", int(fails))


def store_rows(spark, checkpoint, name):
    """Rows of the state store, which are what a stream pays for one by one."""
    return spark.read.format("statestore").option("path", checkpoint).option("stateVarName", name).load().count()


def test_many_ranges_share_a_row_of_the_store(spark, scratch):
    """Ranges and keys are kept in groups; each has its own state all the same."""
    kinds = ["submitted", "error", "submitted", "done"]
    data = [("j", r, 4 * r + i, kinds[(r + i) % 4], f"d{i}", at(0) if r % 7 else None) for r in range(1000) for i in range(2)]
    data += [("j", None, 5000 + i, "error", f"n{i}", at(1)) for i in range(2)] + [(None, 1, 6000, "done", None, at(1))]
    events = spark.createDataFrame(data, EVENTS)
    expected = {(r.job, r.range_id): (r.status, r.retry, r.last_error) for r in ranges.lifecycle(events).collect()}
    for made, schema in ((lambda e: stateful.lifecycle(e), EVENTS), (lambda e: timed.timed_lifecycle(e, "ts", 600, "1 day"), EVENTS)):
        path, checkpoint = scratch("g"), scratch("g-checkpoint")
        states = made(in_batches(spark, scratch, [data[:1001], data[1001:]], schema))
        jobs.for_each(states, lambda b, i: b.write.mode("overwrite").parquet(f"{path}/batch={i}"), checkpoint, mode="update").awaitTermination()
        kept = {(r.job, r.range_id): (r.status, r.retry, r.last_error) for r in timed.state_table(spark, checkpoint, "range").collect()}
        assert kept == expected and len(kept) == 1002
        assert store_rows(spark, checkpoint, "range") <= 6


def test_many_keys_share_a_row_of_the_store(spark, scratch, monkeypatch):
    monkeypatch.setattr(timed, "GROUPS", 8)
    batches = [[(b % 500, 1000 * i + b) for b in range(100 * i, 100 * i + 600)] for i in range(2)]
    rows = in_batches(spark, scratch, batches, "block_height bigint, kafka_offset bigint")
    checkpoint = scratch("k-checkpoint")
    got = timed.append_new_with_state(rows, scratch("k"), checkpoint, ["block_height"], "kafka_offset", 3600)
    assert sorted(map(tuple, got.collect())) == [(b, b) for b in range(500)]
    assert timed.state_table(spark, checkpoint, "seen").count() == 500
    assert store_rows(spark, checkpoint, "seen") <= 8
