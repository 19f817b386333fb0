"""Metric queries over long-format samples (ts, metric, labels, value)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chainlake.operators import ordered

# Histogram bounds.
TX_PER_BLOCK = (50, 100, 200, 500, 1000, 2000, 5000, 10000)
COMMIT_INTERVAL = (1, 2, 3, 5, 8, 13, 21, 34, 55, 89)
RPC_LATENCY_MS = (100, 200, 500, 1000, 2000, 5000, 10000, 20000)
QUEUE_WAIT_MS = (0.01, 0.05, 0.1, 0.5, 1, 2, 5, 10, 20, 50, 100, 200, 500)

# Dashboard levels, lowest first.
LAG_LEVELS = ((5, "yellow"), (20, "orange"), (100, "red"))
INTERVAL_LEVELS = (
    (3, "#6ED0E0"), (5, "#EAB839"), (8, "#EF843C"), (13, "#E24D42"), (21, "#1F78C1"), (34, "#BA43A9"),
)

SERIES = ["metric", "chain", "job", "provider"]


def series(samples: DataFrame) -> DataFrame:
    """Labels as columns, so that samples can be grouped by them."""
    return samples.select(
        "ts", "metric", *[F.try_element_at("labels", F.lit(n)).alias(n) for n in ("chain", "job", "provider")], "value"
    )


def increments(samples: DataFrame, keys: list[str] = SERIES) -> DataFrame:
    """Growth of each counter since its previous sample. After a reset the counter starts
    from zero, so its new value is the growth; a first sample has none. Of samples of one
    time the higher is the later one."""
    prev = ordered.lag(samples, keys, ["ts", "value"], {"prev": "value"}, ordered.by_day("ts"))
    grown = F.when(F.col("value") < F.col("prev"), F.col("value")).otherwise(
        F.col("value") - F.col("prev")
    )
    return prev.withColumn("delta", F.coalesce(grown, F.lit(0.0))).drop("prev")


def increase(samples: DataFrame, window: str, by: list[str], keys: list[str] = SERIES) -> DataFrame:
    return (
        increments(samples, keys)
        .groupBy(F.window("ts", window).alias("w"), *by)
        .agg(F.sum("delta").alias("increase"))
        .select(F.col("w.start").alias("window_start"), *by, "increase")
    )


def rate(samples: DataFrame, window: str, seconds: int, by: list[str], keys: list[str] = SERIES) -> DataFrame:
    """Increase per second in each window, without extrapolation to its borders."""
    return increase(samples, window, by, keys).withColumn(
        "rate", F.col("increase") / F.lit(seconds)
    )


def latest() -> Column:
    """The value of the latest sample; of samples of one time the highest."""
    return F.max_by("value", F.struct("ts", "value"))


def last_over_time(samples: DataFrame, window: str, keys: list[str] = SERIES) -> DataFrame:
    return (
        samples.groupBy(F.window("ts", window).alias("w"), *keys)
        .agg(latest().alias("value"))
        .select(F.col("w.start").alias("window_start"), *keys, "value")
    )


def latest_value(samples: DataFrame, keys: list[str] = SERIES) -> DataFrame:
    return samples.groupBy(*keys).agg(latest().alias("value"))


def level(value: Column, levels=LAG_LEVELS, base: str = "green") -> Column:
    """Colour of the highest level reached."""
    out = F.lit(base)
    for bound, name in levels:
        out = F.when(value >= bound, name).otherwise(out)
    return out


def histogram(rows: DataFrame, value: str, bounds, by: list[str] | None = None) -> DataFrame:
    """Cumulative buckets with sum and count; the last bucket has no bound. Counts are
    taken as columns in one pass and turned into rows afterwards."""
    by = by or []
    counts = rows.groupBy(*by).agg(
        *[F.count_if(F.col(value) <= b).alias(f"b{i}") for i, b in enumerate(bounds)],
        F.count(value).alias("n"),
        F.sum(value).alias("total"),
    )
    buckets = [
        F.struct(F.lit(float(b)).alias("le"), F.col(f"b{i}").alias("cumulative"))
        for i, b in enumerate(bounds)
    ] + [F.struct(F.lit(None).cast("double").alias("le"), F.col("n").alias("cumulative"))]
    return counts.select(*by, "n", "total", F.inline(F.array(*buckets))).withColumnsRenamed(
        {"n": "count", "total": "sum"}
    )


def intervals(commits: DataFrame, keys: list[str]) -> DataFrame:
    """Seconds since the previous commit, to two places; NULL for the first."""
    prev = ordered.lag(commits, keys, ["ts"], {"prev": "ts"}, ordered.by_day("ts"))
    micros = F.unix_micros("ts") - F.unix_micros("prev")
    # Rounded on whole numbers, so that halves do not depend on binary fractions.
    hundredths = F.floor((micros + 5_000) / F.lit(10_000))
    return prev.withColumn("interval_sec", hundredths / F.lit(100)).drop("prev")


def cost_by_provider(calls: DataFrame) -> DataFrame:
    """Total and mean cost of calls (provider, cost). Costs are summed as decimals, so the
    result does not depend on the order of the rows."""
    exact = F.sum(F.col("cost").cast("decimal(18,6)"))
    return calls.groupBy("provider").agg(
        F.round(exact.cast("double"), 2).alias("rpc_cost_sec"),
        F.count(F.lit(1)).alias("rpc_calls"),
        F.round(exact.cast("double") / F.count(F.lit(1)), 4).alias("avg_rpc_cost"),
    )


def backlog(samples: DataFrame, submitted: str, finished: str, by: list[str]) -> DataFrame:
    """Submitted minus finished requests, from the latest samples of both counters."""
    both = samples.where(F.col("metric").isin(submitted, finished))
    last = latest_value(both)
    total = {m: F.sum(F.when(F.col("metric") == m, F.col("value"))) for m in (submitted, finished)}
    return last.groupBy(*by).agg(
        total[submitted].alias("submitted"), total[finished].alias("finished")
    ).withColumn(
        "backlog", F.coalesce("submitted", F.lit(0.0)) - F.coalesce("finished", F.lit(0.0))
    )


def lag_vs_head(checkpoints: DataFrame, heads: DataFrame, on: list[str]) -> DataFrame:
    """Blocks a checkpoint is behind the safe and the raw head, never negative."""
    joined = checkpoints.join(heads, on, "left")

    def behind(head: str) -> Column:
        return F.greatest(F.lit(0), F.col(head) - F.col("checkpoint"))

    return joined.select(
        *on, "checkpoint", behind("safe_block").alias("lag"), behind("raw_block").alias("lag_raw")
    )
