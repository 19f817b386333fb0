"""Quality rules whose thresholds adapt to language and source.

Each rule watches one measure of a text, such as symbols per thousand words. A mergeable
quantile sketch holds how the measure is spread among the documents of one language and
source: values fall into buckets of a sixteenth of their size, and the count of a bucket is
the sum of the counts of its parts, in any order. Quartiles of the sketch give a fence, and
documents beyond it are rejected.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chainlake.llm.base import by_batch, written
from chainlake.llm.words import coded, document_of, joined

WINDOW = 8
LEAST_WORDS = 20
MOST_REPEATED = 30
# Measure: what counts at least as spread, so that a language where nothing varies does not
# reject everything that does; and whether small values are rejected as well.
MEASURES = {
    "symbols": (100, False),  # symbols per 1000 words
    "marks": (100, False),  # exclamation and question marks per 1000 words
    "repeats": (50, False),  # words in repeated windows per 1000 words
    "lines": (30, False),  # repeated lines per 1000 words
    "width": (100, True),  # code points per 100 words
}
# A fence stands so many spreads outside the quartiles.
REACH = 3
# Documents that the limits of a wider group count as when they are mixed with a group's own.
PRIOR = 50
SYMBOLS = tuple(b"#*$%&|<>")


def repeated_words(codes: np.ndarray, bounds: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Per text the number of words in windows that the text holds twice or more.

    Windows are numbered exactly: runs of one word, then of two, four and eight, each from
    the numbers of its two halves, and the text's own number comes first."""
    docs = document_of(bounds)
    n = len(codes)
    covered = np.zeros(n + 1, dtype=np.int64)
    if n >= window:
        width, run = 1, joined(docs, codes)
        while width < window:
            run = joined(run[: len(run) - width], run[width:])
            width *= 2
        inside = docs[: len(run)] == docs[window - 1 :]
        count = np.bincount(run[inside], minlength=int(run.max(initial=0)) + 1)
        again = np.flatnonzero(inside & (count[run] > 1))
        np.add.at(covered, again, 1)
        np.add.at(covered, again + window, -1)
    hit = np.cumsum(covered[:-1]) > 0
    return np.bincount(docs[hit], minlength=len(bounds) - 1)


def repeated_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in text.split(b"\n") if line.strip(b" \t\n\v\f\r")]
    return len(lines) - len(set(lines))


def measure_texts(texts: list[bytes]) -> dict[str, np.ndarray]:
    codes, bounds, vocabulary = coded(texts)
    # Code points of a word: its bytes without continuation bytes.
    length = np.array([len(w) if w.isascii() else len(w.decode("utf-8", "replace")) for w in vocabulary], dtype=np.int64)
    chars = np.concatenate([[0], np.cumsum(length[codes])]) if len(codes) else np.zeros(1, dtype=np.int64)
    symbols, marks = [], []
    for text in texts:
        symbols.append(sum(text.count(b) for b in SYMBOLS))
        marks.append(text.count(b"!") + text.count(b"?"))
    return {
        "n_words": np.diff(bounds),
        "word_chars": np.diff(chars[bounds]),
        "n_symbols": np.array(symbols),
        "n_marks": np.array(marks),
        "n_dup_lines": np.array([repeated_lines(text) for text in texts]),
        "n_repeat_words": repeated_words(codes, bounds),
    }


def measured(docs: DataFrame, keep: list[str], id: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts per row: ``doc_id, lang, source, n_words, word_chars, n_symbols, n_marks,
    n_dup_lines, n_repeat_words`` and the columns of ``keep``."""
    counts = ["n_words", "word_chars", "n_symbols", "n_marks", "n_dup_lines", "n_repeat_words"]

    def column(name: str) -> Column:
        return F.col(f"`{name}`").cast("string") if name in docs.columns else F.lit(None).cast("string")

    source = docs.select(
        F.col(f"`{id}`").alias("doc_id"), column("lang").alias("lang"), column("source").alias("source"),
        *[F.col(f"`{c}`").alias(f"kept_{c}") for c in keep],
        F.encode(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")), "UTF-8").alias("_utf8"),
    )
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema if f.name != "_utf8"]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        got = measure_texts([bytes(b) for b in batch.column(batch.num_columns - 1).to_pylist()])
        return pa.RecordBatch.from_arrays(
            [*batch.columns[:-1], *[pa.array(got[c].astype(np.int64)) for c in counts]],
            names=[*batch.schema.names[:-1], *counts],
        )

    return by_batch(source, run, ", ".join([*fields, *[f"{c} long" for c in counts]]))


def measures() -> dict[str, Column]:
    def per(count: str, unit: int) -> Column:
        return F.expr(f"({count} * {unit}) div greatest(n_words, 1)")

    return {
        "symbols": per("n_symbols", 1000), "marks": per("n_marks", 1000), "repeats": per("n_repeat_words", 1000),
        "lines": per("n_dup_lines", 1000), "width": per("word_chars", 100),
    }


def bucket(value: str) -> str:
    """Lower end of a value's bucket: exact below 32, then the leading five bits."""
    bits = f"greatest(length(conv(cast({value} as string), 10, 2)) - 5, 0)"
    return f"shiftleft(shiftright({value}, {bits}), {bits})"


def sketches(counts: DataFrame) -> DataFrame:
    """Buckets and their counts per measure, language and source, of documents that the
    fixed rules accept."""
    pairs = F.array(*[F.struct(F.lit(n).alias("measure"), c.cast("long").alias("value")) for n, c in measures().items()])
    return (
        counts.where("not base_failed")
        .select("lang", "source", F.inline(pairs))
        .groupBy("lang", "source", "measure", F.expr(bucket("value")).alias("bucket"))
        .agg(F.count(F.lit(1)).alias("docs"))
    )


def merged(sketch: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """The sketch of all documents, or those per key, from those of the groups."""
    return sketch.groupBy(*keys, "measure", "bucket").agg(F.sum("docs").alias("docs"))


def quartiles(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """Lower and upper quartile per key: the first buckets that hold a quarter and three
    quarters of the documents."""
    rows = Window.partitionBy(*keys, "measure")
    upto = F.sum("docs").over(rows.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0))
    total = F.sum("docs").over(rows)
    at = sketch.select(*keys, "measure", "bucket", upto.alias("upto"), total.alias("total"))
    return at.groupBy(*keys, "measure").agg(
        F.min(F.when(F.col("upto") * 4 >= F.col("total"), F.col("bucket"))).alias("low"),
        F.min(F.when(F.col("upto") * 4 >= F.col("total") * 3, F.col("bucket"))).alias("high"),
        F.max("total").alias("docs"),
    )


def fences(sketch: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Per language and source, per language, and for all documents: one row with the lowest
    and highest accepted value of each measure, and how many documents tell so."""

    def wide(found: DataFrame, keys: list[str]) -> DataFrame:
        columns = [F.max("docs").alias("docs")]
        for name, (least, both) in MEASURES.items():
            here = F.col("measure") == name
            spread = F.greatest(F.col("high") - F.col("low"), F.lit(least)) * REACH
            columns.append(F.max(F.when(here, F.col("high") + spread)).alias(f"{name}_most"))
            if both:
                columns.append(F.max(F.when(here, F.col("low") - spread)).alias(f"{name}_least"))
        return found.groupBy(*keys).agg(*columns)

    group = ["lang", "source"]
    return (
        wide(quartiles(sketch, group), group),
        wide(quartiles(merged(sketch, ("lang",)), ["lang"]), ["lang"]),
        wide(quartiles(merged(sketch), []), []),
    )


def blended(docs: Column, own: Column, wider: Column) -> Column:
    """A group's own limit and that of the wider group, which counts as much as ``PRIOR``
    documents."""
    mixed = (docs.cast("double") * own.cast("double") + F.lit(float(PRIOR)) * wider) / (docs.cast("double") + F.lit(float(PRIOR)))
    return F.when(own.isNull(), wider).otherwise(mixed)


def verdicts(docs: DataFrame, keep: tuple[str, ...] = (), id: str = "doc_id", text: str = "text") -> DataFrame:
    """Judge every document: ``doc_id, n_words, word_chars, n_symbols, n_marks, n_dup_lines,
    n_repeat_words, base_failed, kept``, and the columns of ``keep`` as ``kept_<name>``.

    The limits of a language and source are mixed with those of the language, and these with
    those of all documents, by the numbers of accepted documents: a small group leans on
    the wider one, and no number of documents makes it leap from one limit to another.

    Null and empty texts have no words and fail. Null languages and sources form groups of
    their own, as do tables without these columns. One row per input row, repeated rows and
    null ids included; an empty table gives no rows.
    """
    counts = written(
        measured(docs, list(keep), id, text).withColumn(
            "base_failed",
            (F.col("n_words") < LEAST_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MOST_REPEATED),
        ),
        "measured",
    )
    group, language, everything = fences(written(sketches(counts), "sketches"))
    limits = [c for c in everything.columns if c != "docs"]
    overall = everything.first()
    own = group.select(F.col("lang").alias("_lang"), F.col("source").alias("_source"), *[F.col(c).alias(f"_own_{c}") for c in ["docs", *limits]])
    wider = language.select(F.col("lang").alias("_spoken"), *[F.col(c).alias(f"_tongue_{c}") for c in ["docs", *limits]])
    at = counts.join(
        own, F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source")), "left"
    ).join(wider, F.col("lang").eqNullSafe(F.col("_spoken")), "left")
    inside = F.lit(True)
    for name, value in measures().items():
        for limit in (f"{name}_most", f"{name}_least"):
            if limit in limits:
                fence = F.lit(overall[limit] if overall else None).cast("double")
                for step in ("_tongue", "_own"):
                    fence = blended(F.col(f"{step}_docs"), F.col(f"{step}_{limit}"), fence)
                inside = inside & F.coalesce(value <= fence if limit.endswith("_most") else value >= fence, F.lit(True))
    return at.select(
        "doc_id", *[f"kept_{c}" for c in keep], "n_words", "word_chars", "n_symbols", "n_marks", "n_dup_lines",
        "n_repeat_words", "base_failed", (~F.col("base_failed") & inside).alias("kept"),
    )
