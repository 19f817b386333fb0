"""Stored segments of a topic as a source with offsets, and a sink that commits in two phases.

A topic kept as files has a folder per partition and, in it, segments: Parquet files of
consecutive offsets, named by their first and last offset. The source reads ranges of
offsets, so a stream can start anywhere, take so many offsets a batch, and read a partition
in several splits. The sink writes what tasks bring to files nobody reads, and makes a batch
visible at once when all its tasks have ended well.
"""

from __future__ import annotations

import json
import re
import time
import uuid
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, DataSourceStreamArrowWriter, DataSourceStreamReader, InputPartition, WriterCommitMessage,
)
from pyspark.sql.types import LongType, StructField, StructType

from chainlake.functions import schemas

SEGMENT = re.compile(r"partition=(\d+)/segment-(\d+)-(\d+)\.parquet$")
# Rows handed to the engine at once.
BATCH = 10_000
# Seconds for which a stream with enough before it goes by one listing of the folder.
LISTED_FOR = 10.0


def opened(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path.removeprefix("file:"))


def lowered(options: dict[str, str]) -> dict[str, str]:
    """Options are told apart without regard to case."""
    return {name.lower(): value for name, value in options.items()}


def segments_of(path: str) -> dict[int, list[tuple[int, int, str]]]:
    """Per partition the first and last offset and the file of each segment, in order."""
    files, root = opened(path)
    found: dict[int, list[tuple[int, int, str]]] = {}
    for info in files.get_file_info(pafs.FileSelector(root, recursive=True, allow_not_found=True)):
        if match := SEGMENT.search(info.path):
            found.setdefault(int(match[1]), []).append((int(match[2]), int(match[3]), info.path))
    return {p: sorted(s) for p, s in sorted(found.items())}


def store_segments(rows: DataFrame, path: str, offsets: int) -> None:
    """Store wire rows (:data:`schemas.KAFKA_ROW`) as segments of at most ``offsets`` consecutive
    offsets. A segment is written by one task; one that exists is replaced by the same."""
    keyed = rows.withColumn("span", F.floor(F.col("offset") / offsets))

    def write(key, table):
        files, root = opened(path)
        table = table.drop_columns(["span"]).sort_by("offset")
        first, last = table["offset"][0].as_py(), table["offset"][-1].as_py()
        folder = f"{root}/partition={key[0].as_py()}"
        files.create_dir(folder, recursive=True)
        aside = f"{folder}/.{uuid.uuid4().hex}"
        pq.write_table(table, aside, filesystem=files)
        files.move(aside, f"{folder}/segment-{first}-{last}.parquet")
        return pa.table({"rows": pa.array([table.num_rows], pa.int64())})

    keyed.groupBy("partition", "span").applyInArrow(write, "rows bigint").agg(F.sum("rows")).collect()


class Range(InputPartition):
    """Offsets ``first`` to below ``stop`` of a partition, and the segments that hold them."""

    def __init__(self, partition: int, first: int, stop: int, files: list[str]):
        self.partition, self.first, self.stop, self.files = partition, first, stop, files


def split(ranges: list[Range], least: int) -> list[Range]:
    """At least ``least`` ranges where there are as many offsets: the widest are cut in
    proportion to the offsets they hold."""
    total = sum(r.stop - r.first for r in ranges)
    out = []
    for r in ranges:
        parts = max(1, min(-(-least * (r.stop - r.first) // max(total, 1)), r.stop - r.first))
        edges = [r.first + (r.stop - r.first) * i // parts for i in range(parts + 1)]
        for a, b in zip(edges, edges[1:]):
            held = [f for f in r.files if (m := SEGMENT.search(f)) and int(m[2]) < b and int(m[3]) >= a]
            out.append(Range(r.partition, a, b, held))
    return out


class SegmentRead:
    """What batch and stream reading share. Options: ``path``; ``minPartitions``."""

    def __init__(self, options: dict[str, str]):
        self.path = options["path"]
        self.least = int(options.get("minpartitions", "1"))

    def listed(self) -> dict[int, list[tuple[int, int, str]]]:
        return segments_of(self.path)

    def ends(self) -> dict[int, int]:
        return {p: s[-1][1] + 1 for p, s in self.listed().items()}

    def begins(self) -> dict[int, int]:
        return {p: s[0][0] for p, s in self.listed().items()}

    def offsets(self, given: str) -> dict[int, int]:
        """``earliest``, ``latest``, or a JSON object of partitions and offsets, where -2 stands for
        the earliest and -1 for the latest; partitions not named begin at their earliest."""
        begins, ends = self.begins(), self.ends()
        if given in ("earliest", "latest"):
            return begins if given == "earliest" else ends
        named = {int(p): int(o) for p, o in json.loads(given).items()}
        return {p: {-2: begins[p], -1: ends[p]}.get(named.get(p, -2), named.get(p, -2)) for p in begins}

    def between(self, start: dict[int, int], end: dict[int, int]) -> list[Range]:
        out = []
        for p, found in self.listed().items():
            first, stop = start.get(p, found[0][0]), end.get(p, 0)
            if first < stop:
                out.append(Range(p, first, stop, [f for a, b, f in self.around(p, found, first, stop) if b >= first]))
        return split(out, self.least)

    def around(self, partition: int, found: list[tuple[int, int, str]], first: int, stop: int) -> list[tuple[int, int, str]]:
        """Segments that begin below ``stop``."""
        return found[:bisect_left(found, stop, key=lambda s: s[0])]

    def read(self, part: Range) -> Iterator[pa.RecordBatch]:
        files, _ = opened(self.path)
        for name in part.files:
            with files.open_input_file(name) as source:
                for batch in pq.ParquetFile(source).iter_batches(BATCH):
                    at = pc.and_(pc.greater_equal(batch["offset"], part.first), pc.less(batch["offset"], part.stop))
                    kept = batch.filter(at)
                    if kept.num_rows:
                        yield kept


class SegmentBatch(SegmentRead, DataSourceReader):
    """A bounded read. Options: ``startingOffsets`` (earliest), ``endingOffsets`` (latest)."""

    def __init__(self, options: dict[str, str]):
        super().__init__(options)
        self.start = options.get("startingoffsets", "earliest")
        self.end = options.get("endingoffsets", "latest")

    def partitions(self) -> list[Range]:
        # A read of nothing still needs a partition.
        return self.between(self.offsets(self.start), self.offsets(self.end)) or [Range(0, 0, 0, [])]


class SegmentStream(SegmentRead, DataSourceStreamReader):
    """A stream. Options: ``startingOffsets`` (latest), ``maxOffsetsPerTrigger`` (shared among
    partitions in proportion to what waits in them)."""

    def __init__(self, options: dict[str, str]):
        super().__init__(options)
        self.start = options.get("startingoffsets", "latest")
        self.most = int(options.get("maxoffsetspertrigger", "0"))
        self.planned: dict[int, int] | None = None
        self.known: dict[int, list[tuple[int, int, str]]] | None = None
        self.reached: dict[int, list[int]] = {}
        self.at = 0.0

    def refresh(self) -> None:
        self.known, self.at = segments_of(self.path), time.monotonic()
        # The highest offset of a partition's segments up to each, which bisection needs to rise.
        self.reached = {p: list(accumulate((b for _, b, _ in s), max)) for p, s in self.known.items()}

    def listed(self) -> dict[int, list[tuple[int, int, str]]]:
        """Segments are never changed, so that a listing holds for what it names. Listing for each
        batch would make a stream's work grow with the square of its segments."""
        if self.known is None:
            self.refresh()
        return self.known

    def around(self, partition: int, found: list[tuple[int, int, str]], first: int, stop: int) -> list[tuple[int, int, str]]:
        return found[bisect_left(self.reached[partition], first):bisect_left(found, stop, key=lambda s: s[0])]

    def enough(self) -> bool:
        """Whether the listing is young and names more than the next batch may take."""
        if not self.most or self.known is None or time.monotonic() - self.at > LISTED_FOR:
            return False
        return sum(max(end - (self.planned or {}).get(p, 0), 0) for p, end in self.ends().items()) > self.most

    def initialOffset(self) -> dict:
        return as_json(self.offsets(self.start))

    def latestOffset(self) -> dict:
        if not self.enough():
            self.refresh()
        ends = self.ends()
        if self.planned is None:
            self.planned = self.offsets(self.start)
        if self.most:
            waiting = {p: max(end - self.planned.get(p, 0), 0) for p, end in ends.items()}
            total = sum(waiting.values())
            if total > self.most:
                ends = {p: self.planned.get(p, 0) + min(max(w * self.most // total, 1), w) for p, w in waiting.items()}
        self.planned = ends
        return as_json(ends)

    def partitions(self, start: dict, end: dict) -> list[Range]:
        first, stop = from_json(start), from_json(end)
        # After a restart the stream goes on from what it had planned.
        self.planned = {p: max(o, (self.planned or {}).get(p, 0)) for p, o in stop.items()}
        ends = self.ends()
        if any(ends.get(p, 0) < o for p, o in stop.items()):
            self.refresh()
        return self.between(first, stop)

    def commit(self, end: dict) -> None:
        pass


def as_json(offsets: dict[int, int]) -> dict[str, int]:
    return {str(p): o for p, o in offsets.items()}


def from_json(offsets: dict[str, int]) -> dict[int, int]:
    return {int(p): o for p, o in offsets.items()}


class Written(WriterCommitMessage):
    """A task's file and its rows."""

    def __init__(self, file: str, rows: int):
        self.file, self.rows = file, rows


class TwoPhaseWriter(DataSourceStreamArrowWriter):
    """Tasks write files under ``pending``; the driver names those of all tasks in one manifest
    per batch, which is what readers go by. A batch that fails leaves its files without a
    manifest and removes them; one that is repeated finds its manifest and changes nothing."""

    def __init__(self, options: dict[str, str], schema: StructType):
        self.path, self.schema = options["path"], schema

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        files, root = opened(self.path)
        files.create_dir(f"{root}/pending", recursive=True)
        name, rows, writer = f"pending/{uuid.uuid4().hex}.parquet", 0, None
        for batch in iterator:
            writer = writer or pq.ParquetWriter(f"{root}/{name}", batch.schema, filesystem=files)
            writer.write_batch(batch)
            rows += batch.num_rows
        if writer:
            writer.close()
        return Written(name if rows else "", rows)

    def manifest(self, batch: int) -> str:
        return f"{opened(self.path)[1]}/commits/{batch}.json"

    def commit(self, messages: list[Written | None], batchId: int) -> None:
        files, root = opened(self.path)
        files.create_dir(f"{root}/commits", recursive=True)
        if files.get_file_info(self.manifest(batchId)).type != pafs.FileType.NotFound:
            return self.abort(messages, batchId)
        told = [m for m in messages if m and m.file]
        aside = f"{root}/commits/.{uuid.uuid4().hex}"
        with files.open_output_stream(aside) as out:
            out.write(json.dumps({"batch": batchId, "files": [m.file for m in told], "rows": sum(m.rows for m in told)}).encode())
        files.move(aside, self.manifest(batchId))

    def abort(self, messages: list[Written | None], batchId: int) -> None:
        files, root = opened(self.path)
        for m in messages:
            if m and m.file and files.get_file_info(f"{root}/{m.file}").type != pafs.FileType.NotFound:
                files.delete_file(f"{root}/{m.file}")


class Segments(DataSource):
    """``spark.read`` and ``spark.readStream`` format ``segments``."""

    @classmethod
    def name(cls) -> str:
        return "segments"

    def schema(self) -> str:
        return schemas.KAFKA_ROW

    def reader(self, schema: StructType) -> DataSourceReader:
        return SegmentBatch(lowered(self.options))

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return SegmentStream(lowered(self.options))


class TwoPhase(DataSource):
    """``writeStream`` format ``two_phase``."""

    @classmethod
    def name(cls) -> str:
        return "two_phase"

    def streamWriter(self, schema: StructType, overwrite: bool) -> TwoPhaseWriter:
        return TwoPhaseWriter(lowered(self.options), schema)


def registered(spark: SparkSession) -> SparkSession:
    spark.dataSource.register(Segments)
    spark.dataSource.register(TwoPhase)
    return spark


def committed(spark: SparkSession, path: str, schema: StructType, batch: str | None = None) -> DataFrame:
    """The rows of committed batches, with the number of their batch as column ``batch`` where that is
    named. Manifests are read as a table; their files as one."""
    files, root = opened(path)
    if files.get_file_info(f"{root}/commits").type == pafs.FileType.NotFound:
        return spark.createDataFrame([], StructType([*schema, StructField(batch, LongType())]) if batch else schema)
    names = spark.read.schema("batch bigint, files array<string>, rows bigint").json(f"{path}/commits")
    told = names.select(F.col("batch").alias("_batch"), F.explode("files").alias("file"))
    told = told.select("_batch", F.element_at(F.split("file", "/"), -1).alias("_file"))
    rows = spark.read.schema(schema).parquet(f"{path}/pending")
    named = rows.withColumn("_file", F.element_at(F.split(F.input_file_name(), "/"), -1))
    if batch:
        return named.join(told, "_file").drop("_file").withColumnRenamed("_batch", batch)
    return named.join(told.select("_file"), "_file", "left_semi").drop("_file")
