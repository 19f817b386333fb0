"""Stateful stream operators: safe head, tailing planner, range lifecycle.

The first two run the batch operators on each micro-batch, from the state that the batch
before left: a chain's observations are worked on in slices, by many tasks, however many a
batch brings. State and rows are written under the batch id, so a repeated batch replaces
what it wrote. The lifecycle keeps a few numbers per range in the state store, in groups of ranges.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from chainlake.operators import heads, ranges
from chainlake.streaming.jobs import for_each

Step = Callable[[DataFrame, DataFrame], tuple[DataFrame, Callable[[DataFrame], DataFrame]]]


def step_by_step(rows: DataFrame, path: str, checkpoint: str, state: str, schema: str, step: Step) -> DataFrame:
    """Run ``step(batch, state)`` on every micro-batch and read the rows it gave. It returns
    the rows and a function from the stored rows to the new state."""

    def work(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = spark.createDataFrame([], state) if batch_id == 0 else spark.read.schema(state).parquet(f"{path}/state/{batch_id - 1}")
        made, after = step(batch, before)
        made.write.mode("overwrite").parquet(f"{path}/rows/batch={batch_id}")
        stored = spark.read.schema(schema).parquet(f"{path}/rows/batch={batch_id}")
        after(stored).select(*before.columns).write.mode("overwrite").parquet(f"{path}/state/{batch_id}")

    for_each(rows, work, checkpoint).awaitTermination()
    return rows.sparkSession.read.schema(schema).parquet(f"{path}/rows/*")


def in_order(rows: Iterator[pd.DataFrame]) -> pd.DataFrame:
    return pd.concat(list(rows)).sort_values("seq", kind="stable")


# Consecutive ranges of a job whose state is one row of the state store. A range by itself takes
# several calls from Python to the store and a data frame; a group takes them once.
GROUP = 256


def grouped(events: DataFrame, *columns: str | Column) -> GroupedData:
    """Events of ranges by job and group of consecutive ranges. Absent numbers have a group of their
    own, and an absent ``seq`` is the last; neither makes others of its column inexact in pandas."""
    group = F.floor(F.col("range_id") / GROUP).cast("string")
    given = events.select(
        "job", F.coalesce(group, F.lit(ABSENT)).alias("_group"), F.coalesce("range_id", F.lit(0)).cast("bigint").alias("range_id"),
        F.coalesce("seq", F.lit(LAST)).cast("bigint").alias("seq"), *columns)
    return given.groupBy("job", "_group")


ABSENT, LAST = "", (1 << 63) - 1


class Lifecycle(StatefulProcessor):
    """Applies range events as they come and reports each range's new state."""

    ENDED = ("DONE", "FAILED")
    # What is kept of a range, and of one nothing was heard of.
    KEPT = "range_id: bigint, status: string, retry: bigint, last_error: string"
    NEW = ("PLANNED", 0, None)

    def __init__(self, max_retry: int):
        self.max_retry = max_retry

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("range", f"ranges array<struct<{self.KEPT}>>")

    def known(self) -> dict:
        """The states of a group by range."""
        return {r[0]: tuple(r[1:]) for r in self.state.get()[0]} if self.state.exists() else {}

    def keep(self, states: dict) -> None:
        self.state.update(([(number, *state) for number, state in states.items()],))

    def apply(self, current: tuple, kind: str, detail: str) -> tuple:
        status, retry, error = current
        if status in self.ENDED:
            return current
        if kind == "done":
            return "DONE", retry, error
        if kind in ranges.FAILURES:
            ended = retry + 1 > self.max_retry
            return ("FAILED" if ended else "RETRYING"), retry + 1, detail
        return ("INFLIGHT" if kind == "submitted" else "PLANNED"), retry, error

    def number(self, key: tuple, number: int) -> int | None:
        """The number of a range as it came."""
        return None if key[1] == ABSENT else number

    def told(self, key: tuple, made: list[tuple]) -> pd.DataFrame:
        """Rows ``(range_id, seq, status, retry, last_error)`` as the operator gives them."""
        found = [(key[0], self.number(key, number), None if seq == LAST else seq, *state) for number, seq, *state in made]
        return pd.DataFrame(found, columns=["job", "range_id", "seq", "status", "retry", "last_error"])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = in_order(rows)
        states, heard = self.known(), {}
        for number, seq, kind, detail in zip(pdf["range_id"].tolist(), pdf["seq"].tolist(), pdf["kind"], pdf["detail"]):
            states[number] = self.apply(states.get(number, self.NEW), kind, detail)
            heard[number] = seq
        self.keep(states)
        yield self.told(key, [(number, seq, *states[number]) for number, seq in heard.items()])

    def close(self) -> None:
        pass


def safe_head(
    observations: DataFrame, path: str, checkpoint: str, tolerance: int = heads.TOLERANCE, jump: int = heads.JUMP
) -> DataFrame:
    def step(batch: DataFrame, before: DataFrame):
        def after(stored: DataFrame) -> DataFrame:
            new = stored.groupBy("chain").agg(F.max_by("safe_block", "seq").alias("new"))
            return before.join(new, "chain", "full").withColumn("safe_block", F.coalesce("new", "safe_block"))

        return heads.safe_head(batch, tolerance, jump, start=before), after

    schema = "chain string, seq bigint, raw_block bigint, safe_block bigint"
    return step_by_step(observations, path, checkpoint, "chain string, safe_block bigint", schema, step)


def plan_tailing(observations: DataFrame, size: int, path: str, checkpoint: str) -> DataFrame:
    def step(batch: DataFrame, before: DataFrame):
        def after(stored: DataFrame) -> DataFrame:
            new = stored.groupBy("chain").agg(F.max("end_block").alias("new_top"), (F.max("range_id") + 1).alias("new_id"))
            both = before.join(new, "chain", "full")
            return both.select("chain", F.coalesce("new_top", "top").alias("top"), F.coalesce("new_id", "next_id").alias("next_id"))

        return ranges.plan_tailing(batch, size, before), after

    schema = "chain string, seq bigint, range_id bigint, start_block bigint, end_block bigint"
    return step_by_step(observations, path, checkpoint, "chain string, top bigint, next_id bigint", schema, step)


def lifecycle(events: DataFrame, max_retry: int = ranges.MAX_RETRY) -> DataFrame:
    """One row per range and micro-batch; the row with the highest ``seq`` is current."""
    return grouped(events, "kind", "detail").transformWithStateInPandas(
        Lifecycle(max_retry),
        "job string, range_id bigint, seq bigint, status string, retry bigint, last_error string",
        "Update", "None",
    )
