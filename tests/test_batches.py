"""Streaming queries over many files: five and more micro-batches give what their SQL gives."""

import os

import pyarrow.parquet as pq
import pytest
from check import compare, database
from pyspark.sql import functions as F

from conftest import SF_DIR

FILES = 320
STREAMED = {
    "lineitem": "l_orderkey", "events": "event_id", "orders": "o_orderkey",
}
QUERIES = [
    "a1_stream_source", "a6_bronze_append", "a11_keyed_upsert_sink", "a18_fan_out_sinks", "f8_dedup_stream", "j1_available_now",
    "j2_processing_trigger", "j5_tumbling_processing_time", "j6_atomic_data_plus_state", "j7_progress_record",
    "j9_tailing_stream", "j10_safe_head_stream", "j15_lifecycle_stream", "j18_stream_progress", "j19_continuous_view",
]


@pytest.fixture(scope="module")
def in_many_files(spark, tmp_path_factory):
    """The tables that streams read, in the order of their keys, dealt to many files."""
    root = tmp_path_factory.mktemp("files")
    for name, key in STREAMED.items():
        rows = spark.read.parquet(f"{SF_DIR}/{name}.parquet")
        width = max(1, rows.count() // FILES)
        arrow = pq.read_table(f"{SF_DIR}/{name}.parquet").sort_by(key)
        folder = root / f"{name}.parquet"
        folder.mkdir()
        for i in range(0, len(arrow), width):
            file = folder / f"part-{i:08d}.parquet"
            pq.write_table(arrow.slice(i, width), file)
            # Streams take files by their age.
            os.utime(file, (1_700_000_000 + i, 1_700_000_000 + i))
        assert spark.read.parquet(str(folder)).schema == rows.schema
        assert len(list(folder.iterdir())) >= 300
    return str(root)


@pytest.mark.parametrize("name", QUERIES)
def test_many_batches(spark, in_many_files, name):
    con = database(SF_DIR)
    for table in STREAMED:
        con.execute(f"create or replace view {table} as select * from '{in_many_files}/{table}.parquet/*.parquet'")
    _, _, note = compare(spark, con, name, in_many_files)
    assert note.startswith("ok"), note


def test_f8_keeps_the_first_delivery(spark, in_many_files):
    from chainlake.plans.registry import Source

    src = Source(spark, in_many_files)
    assert src.stream("tx").isStreaming
    assert src.view("tx").select(F.countDistinct("block_height")).first()[0] > 1000
