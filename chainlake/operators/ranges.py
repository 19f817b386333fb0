"""Block ranges: planning, lifecycle, in-order commit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chainlake.operators import ordered
from chainlake.operators.ordered import Running

# Fixed value: retries before a range fails.
MAX_RETRY = 3

# The kind of event that a deadline makes when nothing has been heard of a range.
TIMEOUT = "timeout"
FAILURES = ("error", "empty", TIMEOUT)

# Ranges made by one row in the first of the two planning steps.
CHUNK = 10_000


def plan_bounded(bounds: DataFrame, size: int, head: str | None = None) -> DataFrame:
    """Closed ranges of ``size`` blocks covering (job, start_block, end_block), cut at the
    ``head`` column. Long spans are first cut to chunks, so that the ranges are made by
    many tasks."""
    upper = F.least(F.col("end_block"), F.col(head)) if head else F.col("end_block")
    spans = bounds.withColumn("upper", upper).where("start_block <= upper")
    chunks = spans.select(
        "job", "start_block", "end_block", "upper",
        F.explode(F.sequence("start_block", "upper", F.lit(size * CHUNK))).alias("chunk"),
    ).repartition("job", "chunk")
    last = F.least(F.col("chunk") + size * CHUNK - 1, F.col("upper"))
    starts = chunks.select(
        "job", "start_block", "end_block", "upper",
        F.explode(F.sequence(F.col("chunk"), last, F.lit(size))).alias("s"),
    )
    return starts.select(
        "job",
        F.floor((F.col("s") - F.col("start_block")) / F.lit(size)).cast("bigint").alias("range_id"),
        F.col("s").alias("start_block"),
        F.least(F.col("s") + size - 1, F.col("upper")).alias("end_block"),
        (F.least(F.col("s") + size - 1, F.col("upper")) >= F.col("end_block")).alias("exhausted"),
    )


def plan_tailing(heads: DataFrame, size: int, start: DataFrame | None = None) -> DataFrame:
    """Ranges planned while following a head series: each observation above all earlier
    ones plans the new blocks, the last range being cut at the head. Planning starts at
    the first head seen, or goes on from ``start`` (chain, top, next_id)."""
    none = F.lit(None).cast("bigint")
    if start is None:
        heads = heads.withColumns({"_top": none, "_next": none})
    else:
        heads = heads.join(start.withColumnsRenamed({"top": "_top", "next_id": "_next"}), "chain", "left")
    spans = ordered.by_span("seq")
    seen = ordered.running(heads, ["chain"], ["seq"], {"top": Running("max_before", "raw_block")}, spans)
    top = F.greatest("top", "_top")
    fresh = seen.withColumn("first", F.coalesce(top, F.col("raw_block") - 1) + 1).where(
        "raw_block >= first"
    )
    n = F.ceil((F.col("raw_block") - F.col("first") + 1) / F.lit(size)).cast("bigint")
    counted = ordered.running(fresh.withColumn("n", n), ["chain"], ["seq"], {"upto": Running("sum", "n")}, spans)
    return counted.select(
        "chain", "seq", "first", "raw_block", "n", (F.col("upto") + F.coalesce("_next", F.lit(0))).alias("upto"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1)).alias("i"),
    ).select(
        "chain", "seq",
        (F.col("upto") - F.col("n") + F.col("i")).alias("range_id"),
        (F.col("first") + F.col("i") * size).alias("start_block"),
        F.least(F.col("first") + F.col("i") * size + size - 1, F.col("raw_block")).alias("end_block"),
    )


def commit_frontier(finished: DataFrame) -> DataFrame:
    """How far each job may commit in order: the end of the unbroken run of finished
    ranges from id 0, the id it waits for, and how many finished ranges are held back.

    Every finished id also announces its successor; an announced id that is not finished
    is a gap. One grouping finds all gaps, without ordering a job's ranges.
    """
    ids = finished.groupBy("job", "range_id").agg(F.max("end_block").alias("end_block"))
    told = ids.select(
        "job",
        F.explode(
            F.array(
                F.struct(F.col("range_id").alias("id"), F.lit(True).alias("has"), F.lit(False).alias("told")),
                F.struct((F.col("range_id") + 1).alias("id"), F.lit(False).alias("has"), F.lit(True).alias("told")),
            )
        ).alias("m"),
    )
    marks = told.groupBy("job", "m.id").agg(
        F.bool_or("m.has").alias("has"), F.bool_or("m.told").alias("told")
    )
    gap = marks.groupBy("job").agg(
        F.when(F.min(F.when(F.col("has"), F.col("id"))) > 0, F.lit(0).cast("bigint"))
        .otherwise(F.min(F.when(~F.col("has"), F.col("id"))))
        .alias("blocked_by")
    )
    before = F.col("range_id") < F.col("blocked_by")
    return (
        ids.join(gap, "job")
        .groupBy("job", "blocked_by")
        .agg(
            F.max(F.when(before, F.col("end_block"))).alias("frontier_block"),
            F.count_if(before).alias("committed"),
            F.count_if(~before).alias("held_back"),
        )
    )


def with_timeouts(events: DataFrame, ts: str, seconds: int, until: Column) -> DataFrame:
    """Events of ranges (job, range_id, seq, kind, detail and a time) and the failures that
    deadlines add: a submitted range fails when its next event comes ``seconds`` later or
    more, or when there is none and the deadline is not after ``until``. Their ``seq`` is twice
    the given one, and one more for a timeout."""
    nxt = F.lead(ts).over(Window.partitionBy("job", "range_id").orderBy("seq"))
    deadline = F.col(ts) + F.make_dt_interval(secs=F.lit(seconds))
    missed = (F.col("kind") == "submitted") & F.coalesce(F.col("_next") >= deadline, deadline <= until)
    told = events.select("job", "range_id", (F.col("seq") * 2).alias("seq"), "kind", "detail")
    late = events.withColumn("_next", nxt).where(missed).select(
        "job", "range_id", (F.col("seq") * 2 + 1).alias("seq"), F.lit(TIMEOUT).alias("kind"), F.lit(TIMEOUT).alias("detail"))
    return told.unionByName(late)


def lifecycle(events: DataFrame, max_retry: int = MAX_RETRY) -> DataFrame:
    """State of each range after its events (job, range_id, seq, kind, detail).

    ``done`` ends a range, and so does the failure after the last retry; events after the
    end have no effect. Only the first ``max_retry + 1`` failures of a range matter, so
    just these are kept, whatever the number of events.
    """
    keys = ["job", "range_id"]
    failed = F.col("kind").isin(*FAILURES)
    failures = ordered.first_n(events.where(failed), keys, ["seq"], max_retry + 1)
    relevant = events.where(~failed).unionByName(failures)
    is_failure = F.col("kind").isin(*FAILURES)
    per_range = relevant.groupBy(*keys).agg(
        F.min(F.when(F.col("kind") == "done", F.col("seq"))).alias("done_at"),
        # At most max_retry + 1 entries.
        F.sort_array(
            F.collect_list(F.when(is_failure, F.struct("seq", "detail")))
        ).alias("fails"),
        F.max_by(F.when(F.col("kind") != "done", F.col("kind")),
                 F.when(F.col("kind") != "done", F.col("seq"))).alias("last_kind"),
    )
    out_at = F.get("fails", F.lit(max_retry))["seq"]
    counted = F.filter(
        "fails", lambda f: F.col("done_at").isNull() | (f["seq"] < F.col("done_at"))
    )
    is_done = F.col("done_at").isNotNull() & (out_at.isNull() | (F.col("done_at") < out_at))
    return per_range.select(
        *keys,
        F.when(is_done, "DONE")
        .when(out_at.isNotNull(), "FAILED")
        .when(F.col("last_kind").isin(*FAILURES), "RETRYING")
        .when(F.col("last_kind") == "submitted", "INFLIGHT")
        .otherwise("PLANNED")
        .alias("status"),
        F.size(counted).cast("bigint").alias("retry"),
        F.get(counted, F.size(counted) - 1)["detail"].alias("last_error"),
    )


def status_counts(ranges: DataFrame) -> DataFrame:
    return ranges.groupBy("job").agg(
        F.count_if(F.col("status") == "INFLIGHT").alias("inflight"),
        F.count_if(F.col("status") == "RETRYING").alias("retrying"),
        F.count_if(~F.col("status").isin("DONE", "FAILED")).alias("active"),
    )


def not_ready(events: DataFrame) -> DataFrame:
    """Ranges whose latest result was empty: they are to be fetched again, not committed."""
    return (
        events.groupBy("job", "range_id")
        .agg(
            F.max_by("kind", "seq").alias("last_kind"),
            F.count_if(F.col("kind") == "empty").alias("empty_results"),
            F.bool_or(F.col("kind") == "done").alias("done"),
        )
        .where("last_kind = 'empty' and not done")
        .select("job", "range_id", "empty_results")
    )


def emit_order(results: DataFrame) -> DataFrame:
    """Results in range order, ready to emit partition by partition."""
    order = ["start_block", "job", "range_id"]
    return results.repartitionByRange(*order).sortWithinPartitions(*order)
