"""Conversation exports: rollup, topics, text files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chainlake.functions import columns as C
from chainlake.operators import ordered

# Topics and their keywords; the order breaks ties.
TOPICS = {
    "kafka": ["kafka", "offset", "consumer", "producer", "topic", "partition"],
    "spark": ["spark", "pyspark", "spark sql", "structured streaming"],
    "airflow": ["airflow", "dag", "task", "operator", "scheduler"],
    "k8s": ["kubernetes", "k8s", "pod", "deployment", "helm"],
    "clickhouse": ["clickhouse", "mergetree", "materialized view"],
    "web3": ["web3", "blockchain", "onchain"],
    "ethereum": ["ethereum", "eth", "erc20", "rpc", "log", "block"],
    "sui": ["sui", "move", "checkpoint", "walrus"],
    "data-platform": ["data platform", "etl", "bi", "pipeline"],
    "frontend": ["react", "next.js", "tailwind", "css", "ui"],
    "backend": ["api", "backend", "auth", "service"],
    "python": ["python", "asyncio", "multiprocessing"],
}
UNCATEGORIZED = "uncategorized"
UNTITLED = "Untitled"

FOLDERS = ["year", "month", "main_topic"]
# Characters of a file name that tell its slice of an index.
NAME_SLICE = 16


def messages(nodes: DataFrame) -> DataFrame:
    """Text messages of (conv_id, turn, role, parts, …): text parts joined by newlines,
    others skipped, blank messages dropped. A part is text, or has ``text`` or ``content``."""
    part_text = F.transform(
        "parts", lambda p: F.coalesce(p["plain"], p["text"], p["content"])
    )
    kept = F.filter(part_text, lambda t: t.isNotNull())
    text = trim_blank(F.array_join(kept, "\n"))
    return nodes.withColumn("text", text).drop("parts").where("role is not null and text <> ''")


def trim_blank(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def rollup(msgs: DataFrame) -> DataFrame:
    """Rendered messages of each conversation with their position from 1. A conversation's
    text is never brought together in a row nor its messages in a task, however many it has."""
    numbered = ordered.row_number(msgs, ["conv_id"], ["turn"], "pos", ordered.by_span("turn"))
    return numbered.select(
        "conv_id", "pos", F.concat(heading(F.col("role")), F.lit("\n"), F.col("text"), F.lit("\n\n")).alias("text")
    )


def heading(role: Column) -> Column:
    # Headings of the exported documents.
    return (
        F.when(role == "user", "## 🧑 User")
        .when(role == "assistant", "## 🤖 Assistant")
        .otherwise(F.concat(F.lit("## "), role))
    )


def score_column(topic: str) -> str:
    return "score_" + topic.replace("-", "_")


def topic_scores(msgs: DataFrame) -> DataFrame:
    """Keyword occurrences per conversation and topic, titles included. As no keyword spans
    a line break, messages are scored one by one and the scores summed, which happens
    before the shuffle and never brings a conversation's text together."""

    def score(text: Column, topic: str) -> Column:
        total = C.occurrences(text, TOPICS[topic][0])
        for word in TOPICS[topic][1:]:
            total = total + C.occurrences(text, word)
        return total

    text, title = F.col("lower_text"), F.col("lower_title")
    lowered = msgs.select(
        "conv_id", "title", "create_time", F.lower("text").alias("lower_text"), F.lower("title").alias("lower_title")
    )
    return lowered.groupBy("conv_id").agg(
        F.first("title").alias("title"),
        F.first("create_time").alias("create_time"),
        *[
            (F.sum(score(text, t)) + F.max(score(title, t))).alias(score_column(t))
            for t in TOPICS
        ],
    )


def classify(scores: DataFrame) -> DataFrame:
    """Main topic (highest score) and the other topics found."""
    names = list(TOPICS)
    best = F.greatest(*[F.col(score_column(t)) for t in names])
    main = F.lit(None).cast("string")
    for t in reversed(names):
        main = F.when((F.col(score_column(t)) == F.col("best")) & (F.col("best") > 0), t).otherwise(main)
    found = F.array_compact(F.array(*[F.when(F.col(score_column(t)) > 0, F.lit(t)) for t in names]))
    return (
        scores.withColumn("best", best)
        .withColumn("main_topic", F.coalesce(main, F.lit(UNCATEGORIZED)))
        .withColumn("other_topics", F.array_remove(found, F.col("main_topic")))
    )


def documents(msgs: DataFrame) -> DataFrame:
    """Documents, one per conversation, in pieces (file_name, pos, text): the front matter
    at position 0, then the messages, with the folder and file name they belong to."""
    title = F.coalesce(F.nullif("title", F.lit("")), F.lit(UNTITLED))
    labels = classify(topic_scores(msgs)).select(
        "conv_id",
        F.date_format("create_time", "yyyy").alias("year"),
        F.date_format("create_time", "MM").alias("month"),
        "main_topic",
        F.concat(C.safe_name(title), F.lit(".md")).alias("file_name"),
        F.concat(
            F.lit("---\ntitle: "), title,
            F.lit("\ndate: "), F.coalesce(F.date_format("create_time", "yyyy-MM-dd HH:mm:ss"), F.lit("")),
            F.lit("\nmain_topic: "), "main_topic",
            F.lit("\ntags: ["), F.array_join(F.concat(F.array("main_topic"), "other_topics"), ", "),
            F.lit("]\nconversation_id: "), F.col("conv_id").cast("string"), F.lit("\n---\n\n"),
        ).alias("front"),
    )
    named = ["conv_id", *FOLDERS, "file_name"]
    front = labels.select(*named, F.lit(0).cast("bigint").alias("pos"), F.col("front").alias("text"))
    return front.unionByName(rollup(msgs).join(labels.drop("front"), "conv_id").select(*named, "pos", "text"))


def write_documents(docs: DataFrame, path: str) -> None:
    """Text files of JSON lines (file_name, pos, text) under year/month/main_topic, the
    pieces of each document in order."""
    order = [*FOLDERS, "file_name", "conv_id", "pos"]
    (
        docs.repartitionByRange(*order).sortWithinPartitions(*order)
        .select(*FOLDERS, "file_name", "conv_id", "pos", "text")
        .write.mode("overwrite").partitionBy(*FOLDERS).json(path)
    )


def index(docs: DataFrame) -> DataFrame:
    """Index lines of each folder, one row per file, in name order."""
    files = docs.where("pos = 0").select(*FOLDERS, "conv_id", "file_name")
    # Slices by the beginning of the name; a name of no more characters can be that of many
    # conversations, which are then cut by their ids.
    short = F.length("file_name") <= NAME_SLICE
    slices = F.struct(
        F.substring("file_name", 1, NAME_SLICE).alias("begin"), (~short).alias("long"),
        F.when(short, ordered.by_span("conv_id")).otherwise(F.lit(0)).alias("span"),
    )
    lined = ordered.row_number(files, FOLDERS, ["file_name", "conv_id"], "line", slices)
    name = F.replace(F.col("file_name"), F.lit(".md"), F.lit(""))
    return lined.select(
        *FOLDERS, "line",
        F.concat(F.lit("# "), F.upper("main_topic"), F.lit(" — "), "year", F.lit("-"), "month").alias("heading"),
        F.concat(F.lit("- ["), name, F.lit("]("), "file_name", F.lit(")")).alias("entry"),
    )


def write_index(lines: DataFrame, path: str) -> None:
    """Index lines as text files beside the documents."""
    (
        lines.repartitionByRange(*FOLDERS, "line")
        .sortWithinPartitions(*FOLDERS, "line")
        .select(*FOLDERS, F.col("entry").alias("value"))
        .write.mode("overwrite").partitionBy(*FOLDERS).text(path)
    )
