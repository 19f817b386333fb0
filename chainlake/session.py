"""Session settings and durable scratch space shared by all jobs."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, wherever they were started."""
    sc = spark.sparkContext
    if getattr(sc, "_chainlake_shipped", False):
        return
    package = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="chainlake-")
    sc.addPyFile(shutil.make_archive(os.path.join(folder, "chainlake"), "zip", os.path.dirname(package), "chainlake"))
    sc._chainlake_shipped = True


def prepare(spark: SparkSession) -> SparkSession:
    """Settings every job relies on; safe to call repeatedly."""
    ship(spark)
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    # One state store for all streams of a session.
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    # HotSpot does not compile methods above 8000 bytes of bytecode; wide projections are
    # faster split into several methods than fused into one that stays interpreted.
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by the cluster; a temporary one only in local mode."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="chainlake-"))
    return spark.conf.get("spark.checkpoint.dir")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def durable(df: DataFrame) -> DataFrame:
    """Write the rows to reliable storage and read them back, so that values that depend on
    how rows were partitioned stay fixed when executors are lost."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)
