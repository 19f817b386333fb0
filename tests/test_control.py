"""Heads, ranges, state: small cases by hand and against brute force."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from chainlake.operators import heads, quality, ranges, state
from chainlake.streaming.stateful import Lifecycle

from conftest import rows


def test_fold_example():
    assert heads.fold([100, 103, 90, 99, 500], None, 5, 100) == [100, 103, 103, 99, 199]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 400), min_size=1, max_size=30), st.integers(-300, 900))
def test_summary_of_a_slice_equals_folding_it(raws, start):
    pieces = heads.summed_up(raws, start - 50, start + 50, 5, 100)
    assert pieces[0][0] == start - 50 and pieces[-1][0] <= start + 50
    for head in (start - 50, start, start + 50):
        assert heads.value_of(pieces, head) == heads.fold(raws, head, 5, 100)[-1]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 10**6), min_size=1, max_size=60), st.integers(1, 59))
def test_safe_heads_stay_between_the_heads_seen(raws, cut):
    before = raws[:cut]
    assert min(before) <= heads.fold(before, None, 5, 100)[-1] <= max(before)


@pytest.mark.parametrize("raws", [range(0, 2_000_000, 1000), range(2_000_000, 0, -1000)])
def test_steep_series_have_few_pieces(raws):
    """The spans before the slice bound its pieces, however steep the heads run."""
    raws = list(raws)
    first, rest = raws[:100], raws[100:]
    pieces = heads.summed_up(rest, min(first), max(first), 5, 100)
    assert len(pieces) <= 2 * len(first) + 10


def series(spark, n=800):
    rnd = random.Random(3)
    data, head = [], {"a": 0, "b": 5000}
    for i in range(n):
        chain = "a" if rnd.random() < 0.8 else "b"
        head[chain] += rnd.choice([1, 2, 3, 50])
        data.append((chain, i, head[chain] + rnd.choice([0, 0, 0, -3, -40, 700])))
    return spark.createDataFrame(data, "chain string, seq bigint, raw_block bigint")


@pytest.mark.parametrize("width", [1, 9, 130, 10_000])
def test_safe_head_at_any_width(spark, width):
    df = series(spark)
    expected = []
    for chain in ("a", "b"):
        mine = [r for r in rows(df) if r[0] == chain]
        expected += [(*r, s) for r, s in zip(mine, heads.fold([r[2] for r in mine], None, 5, 100))]
    assert rows(heads.safe_head(df, width=width)) == sorted(expected)


def test_safe_head_goes_on(spark):
    df = series(spark)
    whole = rows(heads.safe_head(df))
    first = heads.safe_head(df.where("seq < 300"), width=40)
    last = first.groupBy("chain").agg(F.max_by("safe_block", "seq").alias("safe_block"))
    second = heads.safe_head(df.where("seq >= 300"), width=40, start=last)
    assert sorted(rows(first) + rows(second)) == whole


def test_plan_bounded(spark):
    bounds = spark.createDataFrame([("a", 1, 12, 100), ("b", 1, 12, 8), ("c", 5, 4, 9)],
                                   "job string, start_block bigint, end_block bigint, head bigint")
    got = rows(ranges.plan_bounded(bounds, 5, head="head"))
    assert got == [("a", 0, 1, 5, False), ("a", 1, 6, 10, False), ("a", 2, 11, 12, True), ("b", 0, 1, 5, False),
                   ("b", 1, 6, 8, False)]


def test_plan_bounded_over_chunks(spark, monkeypatch):
    monkeypatch.setattr(ranges, "CHUNK", 3)
    bounds = spark.createDataFrame([("a", 10, 60)], "job string, start_block bigint, end_block bigint")
    got = rows(ranges.plan_bounded(bounds, 4).select("range_id", "start_block", "end_block"))
    assert got == [(i, s, min(s + 3, 60)) for i, s in enumerate(range(10, 61, 4))]


def test_plan_tailing(spark):
    df = spark.createDataFrame([("a", 1, 10), ("a", 2, 17), ("a", 3, 12), ("a", 4, 18)],
                               "chain string, seq bigint, raw_block bigint")
    got = rows(ranges.plan_tailing(df, 4))
    assert got == [("a", 1, 0, 10, 10), ("a", 2, 1, 11, 14), ("a", 2, 2, 15, 17), ("a", 4, 3, 18, 18)]


@pytest.mark.parametrize("ids,expected", [
    ([0, 1, 3, 4], (2, 19, 2, 2)), ([1, 2], (0, None, 0, 2)), ([0], (1, 9, 1, 0)), ([0, 0, 1, 1, 2], (3, 29, 3, 0))])
def test_commit_frontier(spark, ids, expected):
    df = spark.createDataFrame([("j", i, i * 10, i * 10 + 9) for i in ids],
                               "job string, range_id bigint, start_block bigint, end_block bigint")
    r = ranges.commit_frontier(df).first()
    assert (r["blocked_by"], r["frontier_block"], r["committed"], r["held_back"]) == expected


def test_lifecycle_equals_the_state_machine(spark):
    rnd = random.Random(11)
    kinds = ["planned", "submitted", "error", "empty", "done"]
    data = [("j", rnd.randrange(60), i, rnd.choices(kinds, [1, 3, 3, 3, 1])[0], f"d{i}") for i in range(900)]
    df = spark.createDataFrame(data, "job string, range_id bigint, seq bigint, kind string, detail string")
    machine, expected = Lifecycle(ranges.MAX_RETRY), {}
    for job, rid, _, kind, detail in data:
        expected[job, rid] = machine.apply(expected.get((job, rid), ("PLANNED", 0, None)), kind, detail)
    got = {(r["job"], r["range_id"]): (r["status"], r["retry"], r["last_error"]) for r in ranges.lifecycle(df).collect()}
    assert got == expected
    assert {v[0] for v in got.values()} >= {"DONE", "FAILED"}


def test_gaps(spark):
    heights = [1, 2, 2, 5, 6, 9, 9]
    df = spark.createDataFrame([("c", h) for h in heights] + [("d", 3)], "chain string, height bigint")
    assert rows(quality.gaps(df)) == [("c", 3, 4, 2), ("c", 7, 8, 2)]


def test_reorgs_use_the_latest_delivery(spark):
    blocks = [("c", 1, "h1", "h0", 1), ("c", 2, "h2", "h1", 2), ("c", 3, "h3", "h2", 3), ("c", 2, "x2", "h1", 9)]
    df = spark.createDataFrame(blocks, "chain string, number bigint, hash string, parent_hash string, kafka_offset bigint")
    assert rows(quality.reorgs(df)) == [("c", 3, "h3", "h2", "x2", 2)]


def test_upsert_is_idempotent(spark):
    schema = "kafka_key string, run_id string, v bigint, kafka_offset bigint"
    target = spark.createDataFrame([("a", "r1", 1, 1), ("b", "r1", 2, 2)], schema)
    updates = spark.createDataFrame([("a", "r1", 5, 7), ("c", "r2", 9, 8)], schema)
    once = state.merge_upsert(target, updates)
    assert rows(once) == [("a", "r1", 5, 7), ("b", "r1", 2, 2), ("c", "r2", 9, 8)]
    assert rows(state.merge_upsert(once, updates)) == rows(once)
    assert rows(state.merge_upsert(once, target)) == rows(once)


def test_increment_keeps_a_lagging_partition(spark):
    schema = "kafka_topic string, kafka_partition int, kafka_offset bigint"
    bronze = spark.createDataFrame([("t", p, o) for p in range(3) for o in range(5)], schema)
    silver = spark.createDataFrame([("t", 0, 4), ("t", 1, 1)], schema)
    got = rows(state.increment(bronze, silver))
    assert got == [("t", 1, o) for o in (2, 3, 4)] + [("t", 2, o) for o in range(5)]


def test_replay_adds_nothing(spark):
    schema = "block_height bigint, block_hash string, kafka_offset bigint"
    stored = spark.createDataFrame([(h, f"h{h}", h) for h in range(90, 111)], schema)
    replay = spark.createDataFrame([(h, f"h{h}", 1000 + h) for h in range(100, 121)] * 2, schema)
    fresh = quality.not_yet_stored(replay, stored, ["block_height", "block_hash"])
    assert sorted(r["block_height"] for r in fresh.collect()) == list(range(111, 121))


def test_backfill_status(spark):
    jobs = spark.createDataFrame([("a", 1), ("b", 1), ("c", 1), ("d", 1)], "job_name string, start_block bigint")
    last = spark.createDataFrame([("a", "completed", 50, 100), ("b", "running", 100, 100), ("c", "running", 40, 100)],
                                 "job_name string, status string, checkpoint bigint, range_end bigint")
    assert rows(state.backfill_status(jobs, last).na.fill(-1)) == [
        ("a", "completed", -1), ("b", "inconsistent", -1), ("c", "resume", 41), ("d", "new", 1)]


def test_fencing(spark):
    owners = spark.createDataFrame([("k", "A")], "kafka_key string, producer_pod_uid string")
    updates = spark.createDataFrame([("k", "A"), ("k", "B"), ("free", "B")], "kafka_key string, producer_pod_uid string")
    got = {(r["kafka_key"], r["producer_pod_uid"]): r["accepted"] for r in state.fenced_updates(owners, updates).collect()}
    assert got == {("k", "A"): True, ("k", "B"): False, ("free", "B"): True}


def test_empty_blocks(spark):
    one = lambda ids: spark.createDataFrame([(i,) for i in ids], "block_number bigint")
    got = quality.empty_blocks(one([1, 2, 3]), one([1, 2, 2]), one([1]))
    assert {r["block_number"]: r["status"] for r in got.collect()} == {1: "has_logs", 2: "suspect", 3: "empty_ok"}


def test_dedup_collapses_copies(spark):
    df = spark.createDataFrame([("a", 5), ("a", 2), ("b", 9)], "k string, kafka_offset bigint")
    assert rows(quality.dedup(df, ["k"])) == [("a", 2), ("b", 9)]
    assert rows(quality.duplicates(df, ["k"])) == [("a", 2)]
    assert rows(quality.missing_rows(df, df.where(F.col("k") == "a"), ["k"])) == [("b",)]


def test_missing_rows_take_one_grouping(spark):
    """Copies are collapsed, absent keys equal none, rows that are only present don't count."""
    schema = "p int, o bigint"
    wanted = spark.createDataFrame([(0, 1), (0, 1), (0, 2), (1, 2), (1, 2), (None, 3), (None, 3), (2, None)], schema)
    present = spark.createDataFrame([(0, 2), (0, 2), (1, 9), (None, 3), (2, None)], schema)
    got = quality.missing_rows(wanted, present, ["p", "o"])
    assert sorted(map(tuple, got.collect()), key=repr) == sorted([(0, 1), (1, 2), (None, 3), (2, None)], key=repr)
    plan = got._jdf.queryExecution().sparkPlan().toString()
    assert "Join" not in plan


def test_members_are_found_in_one_reading(spark):
    from conftest import SF_DIR

    from chainlake.plans import load

    plan = load().QUERIES["i14_json_field"](spark, SF_DIR)._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("json_tuple(") == 1 and "get_json_object" not in plan


def test_empty_blocks_are_counted_by_one_grouping(spark):
    """Blocks repeat or have no number; transactions and logs may have none, or no block."""
    one = lambda numbers: spark.createDataFrame([(n,) for n in numbers], "block_number bigint")
    got = quality.empty_blocks(one([1, 1, 2, 3, 3, 3, None, None]), one([1, 2, 2, 9, None]), one([1, 1, 8, None, None]))
    assert "Join" not in got._jdf.queryExecution().optimizedPlan().toString()
    assert rows(got.na.fill(-1, ["block_number"])) == [
        *[(-1, 0, 0, "empty_ok")] * 2, *[(1, 1, 2, "has_logs")] * 2, (2, 2, 0, "suspect"), *[(3, 0, 0, "empty_ok")] * 3]
