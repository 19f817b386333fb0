"""Stream operators with watermarks, timers and expiring state in the state store.

Windows are appended once, when the watermark has passed their end; rows behind the watermark
go to a table of late rows instead of being dropped. First deliveries are found with state
that is forgotten after a while. Ranges whose result never comes are retried or failed by timers. What the
state store holds can be read as a table.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from chainlake.functions import columns as C
from chainlake.operators import ranges
from chainlake.streaming.jobs import for_each, stored_keys_left_out
from chainlake.streaming.stateful import Lifecycle, grouped, in_order

# Rows travel through an operator as text that keeps every microsecond.
EXACT_TIMES = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def as_text(columns: list[str]) -> Column:
    return F.to_json(F.struct(*columns), {**EXACT_TIMES, "ignoreNullFields": "false"})


def from_text(column: str, schema: T.StructType) -> Column:
    return F.from_json(column, schema, EXACT_TIMES)


def state_table(spark: SparkSession, checkpoint: str, name: str) -> DataFrame:
    """The keys and values that a query's operator keeps under ``name``, as of its last batch;
    of a group of keys, a row for each."""
    rows = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", name).load()
    held = rows.schema["value"].dataType.fields
    if len(held) > 1 or not isinstance(held[0].dataType, T.ArrayType):
        return rows.select("key.*", "value.*")
    made = rows.select("key.*", F.inline(F.col("value")[held[0].name]))
    if "range_id" in made.columns:
        made = made.withColumn("range_id", F.when(F.col("_group") != "", F.col("range_id")))
    return made.drop("_group")


def state_operators(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The stateful operators of a query, with the batches whose state can be read."""
    return spark.read.format("state-metadata").load(checkpoint)


class WindowCounts(StatefulProcessor):
    """Counts rows per key and window until the watermark passes the window's end; rows that
    come later than that are handed on one by one."""

    def __init__(self, keys: int):
        self.keys = keys

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.count = handle.getValueState("open", "cnt bigint")

    def rows(self, key: tuple, kind: str, counts: list[int], texts: list) -> pd.DataFrame:
        made = {f"k{i}": [key[i]] * len(counts) for i in range(self.keys)}
        return pd.DataFrame({**made, "window_ms": [key[-1]] * len(counts), "kind": kind, "cnt": counts, "row": texts})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        end = key[-1]
        if end <= timerValues.getCurrentWatermarkInMs():
            for pdf in rows:
                yield self.rows(key, "late", [1] * len(pdf), pdf["row"].tolist())
            return
        known = self.count.get()[0] if self.count.exists() else 0
        if not known:
            self.handle.registerTimer(end)
        self.count.update((known + sum(len(pdf) for pdf in rows),))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.count.exists():
            yield self.rows(key, "closed", [self.count.get()[0]], [None])
            self.count.clear()

    def close(self) -> None:
        pass


def window_end(ts: str, seconds: int) -> Column:
    """The end of a row's window in milliseconds."""
    return ((F.floor(F.unix_micros(ts) / (seconds * 1_000_000)) + 1) * (seconds * 1000)).cast("bigint")


class WindowTables:
    """What :func:`append_windows` leaves: ``closed`` and ``open`` counts by key and window, and
    ``late`` rows as they came."""

    def __init__(self, spark: SparkSession, path: str, checkpoint: str, keys: list[T.StructField], seconds: int, row: T.StructType):
        self.spark, self.path, self.checkpoint, self.keys, self.seconds, self.row = spark, path, checkpoint, keys, seconds, row

    def named(self, df: DataFrame) -> DataFrame:
        names = [F.col(f"k{i}").cast(f.dataType).alias(f.name) for i, f in enumerate(self.keys)]
        end = F.timestamp_millis("window_ms")
        start = F.timestamp_millis(F.col("window_ms") - self.seconds * 1000)
        return df.select(*names, start.alias("window_start"), end.alias("window_end"), "cnt")

    def stored(self) -> DataFrame:
        fields = ", ".join(f"k{i} {f.dataType.simpleString()}" for i, f in enumerate(self.keys))
        schema = f"{fields}, window_ms bigint, kind string, cnt bigint, row string"
        return self.spark.read.schema(f"{schema}, batch bigint").parquet(self.path)

    def closed(self) -> DataFrame:
        return self.named(self.stored().where("kind = 'closed'"))

    def late(self) -> DataFrame:
        return self.stored().where("kind = 'late'").select(from_text("row", self.row).alias("r")).select("r.*")

    def open(self) -> DataFrame:
        return self.named(state_table(self.spark, self.checkpoint, "open"))


def append_windows(rows: DataFrame, keys: list[str], ts: str, seconds: int, delay: str, path: str, checkpoint: str) -> WindowTables:
    """Count the rows of a stream per key and window of event time in append mode.

    A window is appended once, when the watermark (the latest time seen in earlier batches
    less ``delay``) has reached its end; the store holds open windows only. A row whose
    window has been appended or could have been is kept whole in a table of late rows. Every
    row with a time is in exactly one of closed windows, open windows and late rows, in
    whatever order a source brings them. Rows without a time belong to no window.
    """
    row = T.StructType([f for f in rows.schema])
    fields = [rows.schema[k] for k in keys]
    timed = rows.where(F.col(ts).isNotNull()).withWatermark(ts, delay)
    # Computed columns carry no watermark, so nothing is dropped before the operator sees it.
    given = timed.select(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)], window_end(ts, seconds).alias("window_ms"),
                         as_text(rows.columns).alias("row"))
    names = [f"k{i}" for i in range(len(keys))]
    schema = ", ".join(f"k{i} {f.dataType.simpleString()}" for i, f in enumerate(fields))
    counted = given.groupBy(*names, "window_ms").transformWithStateInPandas(
        WindowCounts(len(keys)), f"{schema}, window_ms bigint, kind string, cnt bigint, row string", "Append", "EventTime")

    def work(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").partitionBy("kind").parquet(f"{path}/batch={batch_id}")

    for_each(counted, work, checkpoint).awaitTermination()
    return WindowTables(rows.sparkSession, path, checkpoint, fields, seconds, row)


# Groups by hash that keys are kept in: each is one row of the state store. A key by itself
# takes several calls from Python to the store and a data frame; a group takes them once.
GROUPS = 1 << 12


class FirstSeen(StatefulProcessor):
    """Hands on the first row of each key that the state doesn't know. A key is forgotten
    ``ttl_ms`` after it was first seen, by the timer of its group."""

    def __init__(self, ttl_ms: int):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", "keys array<struct<key: string, arrived: bigint>>")

    def known(self) -> dict:
        return {r[0]: r[1] for r in self.seen.get()[0]} if self.seen.exists() else {}

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        known, first, times = self.known(), {}, {}
        for pdf in rows:
            for name, place, row, arrived in zip(pdf["key"].tolist(), pdf["place"].tolist(), pdf["row"].tolist(), pdf["arrived"].tolist()):
                if name in known:
                    continue
                if name not in first or (place, row) < first[name]:
                    first[name] = (place, row)
                times[name] = max(arrived, times.get(name, arrived))
        if not first:
            return
        if not known:
            self.handle.registerTimer(min(times.values()) + self.ttl_ms)
        self.seen.update(([*known.items(), *times.items()],))
        yield pd.DataFrame({"row": [row for _, row in first.values()]})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = max(timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs())
        left = {name: arrived for name, arrived in self.known().items() if arrived + self.ttl_ms > now}
        if left:
            self.seen.update((list(left.items()),))
            self.handle.registerTimer(min(left.values()) + self.ttl_ms)
        else:
            self.seen.clear()
        yield pd.DataFrame({"row": pd.Series([], dtype=str)})

    def close(self) -> None:
        pass


def append_new_with_state(
    rows: DataFrame, path: str, checkpoint: str, keys: list[str], order: str, ttl_seconds: float,
    block: str = "block_height", width: int = C.BLOCKS_PER_BUCKET,
) -> DataFrame:
    """Append the first delivery of each key, as :func:`chainlake.streaming.jobs.append_new`
    does, with state for the usual case: a key first seen within the last ``ttl_seconds`` is
    known to the state store and needs no look at the table. Only keys the store doesn't know
    (new, or forgotten) are held against the block buckets of the table, so nothing is stored
    twice however late a copy comes, and the store never holds more than the keys of that
    time. It goes by arrival: a watermark on the time of the batch sets the timers off."""
    place = F.coalesce(F.col(order).cast("bigint"), F.lit(2**63 - 1))
    timed = rows.withColumn("_arrived", F.current_timestamp()).withWatermark("_arrived", "0 seconds")
    given = timed.select(
        as_text(keys).alias("key"), place.alias("place"), F.unix_millis("_arrived").alias("arrived"), as_text(rows.columns).alias("row"))
    given = given.withColumn("_group", F.pmod(F.xxhash64("key"), F.lit(GROUPS)))
    unknown = given.groupBy("_group").transformWithStateInPandas(FirstSeen(int(ttl_seconds * 1000)), "row string", "Append", "EventTime")
    fresh = unknown.select(from_text("row", rows.schema).alias("r")).select("r.*")
    return stored_keys_left_out(fresh, path, checkpoint, keys, order, block, width, aside=f"{path}-unknown")


# The time of events without one, which set no deadline.
UNTIMED = -(1 << 63)


class TimedLifecycle(Lifecycle):
    """The lifecycle of ranges with a deadline for results: a submitted range that nothing is
    heard of within ``timeout_ms`` counts a failure more, by a timer or when something
    comes after all."""

    KEPT = f"{Lifecycle.KEPT}, deadline: bigint, seq: bigint"
    NEW = (*Lifecycle.NEW, None, None)

    def __init__(self, max_retry: int, timeout_ms: int):
        super().__init__(max_retry)
        self.timeout_ms = timeout_ms

    def heard(self, state: tuple, kind: str, detail: str, at: int, seq: int) -> tuple:
        """The state after an event: ``(status, retry, last_error, deadline, seq)``."""
        current, deadline = state[:3], state[3]
        if deadline is not None and deadline <= at:
            current = self.apply(current, ranges.TIMEOUT, ranges.TIMEOUT)
        current = self.apply(current, kind, detail)
        waits = kind == "submitted" and current[0] not in self.ENDED
        return (*current, at + self.timeout_ms if waits and at != UNTIMED else None, seq)

    def overdue(self, state: tuple, now: int) -> tuple:
        """The state once the watermark is at ``now``."""
        if state[3] is None or state[3] > now:
            return state
        return (*self.apply(state[:3], ranges.TIMEOUT, ranges.TIMEOUT), None, state[4])

    def wake(self, states: dict) -> None:
        """One timer for a group, at its next deadline."""
        waiting = [state[3] for state in states.values() if state[3] is not None]
        wanted = [min(waiting)] if waiting else []
        timers = list(self.handle.listTimers())
        for timer in timers:
            if timer not in wanted:
                self.handle.deleteTimer(timer)
        if wanted and wanted[0] not in timers:
            self.handle.registerTimer(wanted[0])

    def changed(self, key: tuple, states: dict, numbers) -> pd.DataFrame:
        return self.told(key, [(number, states[number][4], *states[number][:3]) for number in numbers])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf, now = in_order(rows), timerValues.getCurrentWatermarkInMs()
        states, heard = self.known(), {}
        given = (pdf["range_id"].tolist(), pdf["kind"], pdf["detail"], pdf["at"].tolist(), pdf["seq"].tolist())
        for number, kind, detail, at, seq in zip(*given):
            states[number] = self.heard(states.get(number, self.NEW), kind, detail, at, seq)
            heard[number] = True
        # A deadline the watermark has passed already makes no second row of the range.
        states.update({number: self.overdue(states[number], now) for number in heard})
        self.wake(states)
        self.keep(states)
        yield self.changed(key, states, heard)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = max(timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs())
        before = self.known()
        states = {number: self.overdue(state, now) for number, state in before.items()}
        failed = [number for number in states if states[number] != before[number]]
        if failed:
            waiting = [state[3] for state in states.values() if state[3] is not None]
            if waiting:
                self.handle.registerTimer(min(waiting))
            self.keep(states)
            yield self.changed(key, states, failed)

    def close(self) -> None:
        pass


def timed_lifecycle(events: DataFrame, ts: str, timeout_seconds: int, delay: str, max_retry: int = ranges.MAX_RETRY) -> DataFrame:
    """Rows of range states as they change, from a stream of events with a time: like
    :func:`chainlake.streaming.stateful.lifecycle`, and with deadlines. Times are taken to the
    millisecond; a range's events come in the order of ``seq``, their times don't decrease.
    A timer goes off once the watermark has reached it."""
    timed = events.withWatermark(ts, delay)
    return grouped(timed, "kind", "detail", F.coalesce(F.unix_millis(ts), F.lit(UNTIMED)).alias("at")).transformWithStateInPandas(
        TimedLifecycle(max_retry, timeout_seconds * 1000),
        "job string, range_id bigint, seq bigint, status string, retry bigint, last_error string", "Update", "EventTime")
