"""Running values and joins: spread over tasks they equal plain windows and joins."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from chainlake import session
from chainlake.operators import ordered
from chainlake.operators.ordered import Running

from conftest import rows

VALUES = {
    "n": Running("count"), "s": Running("sum", "v"), "m": Running("max", "v"), "mb": Running("max_before", "v"),
    "l": Running("last", "w"), "p": Running("lag", "w"),
}


@pytest.fixture(scope="module")
def skewed(spark):
    rnd = random.Random(7)
    data = [
        ("hot" if rnd.random() < 0.6 else f"k{rnd.randrange(8)}", i, rnd.randrange(100), rnd.choice([None, None, i]))
        for i in range(1500)
    ] + [(None, 5000 + i, i, i) for i in range(40)]
    return spark.createDataFrame(data, "k string, o int, v int, w int").repartition(5)


@pytest.mark.parametrize("order,slices", [
    ("o", "floor(o / 50)"), ("o", "o"), ("v desc, o", "-v"), ("v desc, o", "floor(-v / 30)")])
def test_slices_equal_one_window(skewed, order, slices):
    order = [F.col(c.split()[0]).desc() if c.endswith("desc") else F.col(c) for c in order.split(", ")]
    plain = ordered.running(skewed, ["k"], order, VALUES)
    sliced = ordered.running(skewed, ["k"], order, VALUES, F.expr(slices))
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(plain.collect(), key=key) == sorted(sliced.collect(), key=key)


def test_a_hot_key_is_many_windows(skewed):
    """The key's rows are shuffled by key and slice, and no job runs before the query."""
    tracker = skewed.sparkSession.sparkContext.statusTracker()
    before = len(tracker.getJobIdsForGroup(None))
    sliced = ordered.row_number(skewed, ["k"], ["o"], slices=ordered.by_span("o", 100))
    plan = sliced._jdf.queryExecution().executedPlan().toString()
    assert len(tracker.getJobIdsForGroup(None)) == before
    assert "hashpartitioning(_at" in plan


def test_first_n_limits_before_the_shuffle(skewed):
    top = ordered.first_n(skewed, ["k"], ["o"], 3)
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")
    assert top.groupBy("k").count().agg(F.max("count")).first()[0] == 3


def test_shared_dir_follows_the_session(spark):
    assert session.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
