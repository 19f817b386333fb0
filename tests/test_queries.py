"""Every registered query against its SQL, and the hot-key paths against the same SQL."""

import pytest
from check import compare

import __spark_entry__ as entry
from chainlake import plans
from conftest import SF_DIR

HOT = [
    "a17_index", "a17_partitioned_text_export", "d2_block_by_time", "e14_conversation_rollup", "e10_commit_interval", "f2_ranked_history", "f5_gap_detect", "f6_commit_interval", "g1_order_state",
    "j9_plan_ranges_tailing", "j10_safe_head", "j11_head_source_arbiter", "l1_counter_rate", "l7_commit_interval_max",
    "l9_commit_overhead_ratio",
]


@pytest.mark.parametrize("name", sorted(plans.load().QUERIES))
def test_matches_sql(spark, database, name):
    _, _, note = compare(spark, database, name, SF_DIR)
    assert note.startswith("ok") and "types" not in note, note


@pytest.mark.parametrize("name", HOT)
def test_matches_sql_with_hot_keys(spark, database, hot, name):
    _, _, note = compare(spark, database, name, SF_DIR)
    assert note.startswith("ok"), note


def test_every_query_has_sql():
    registry = plans.load()
    assert set(registry.ORACLES) == set(registry.QUERIES)
    assert set(registry.QUERIES) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
