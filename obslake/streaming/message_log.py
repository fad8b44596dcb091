"""A log of messages in files with offsets, as a Spark data source for batches and streams.

A log is a folder of segments ``partition=<p>/<first>-<end>.txt``, one message a line, named by the offsets that they hold;
``end`` is the first one after it. Appending is a batch write; its commit gives the segments their names, so a segment is
there whole or not at all. Old segments may be removed at any time.

``read_log`` streams it like a topic: from the earliest or the latest offset on, at most ``per_trigger`` messages a
micro-batch, in as many tasks as there are segments. A stream that asks for offsets which the log no longer holds
fails, unless loss is allowed. Its position is the checkpoint's, so a restarted stream goes on where it was.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceStreamReader, InputPartition, WriterCommitMessage

FORMAT = "message_log"
SEGMENT = re.compile(r"partition=(\d+)/(\d+)-(\d+)\.txt$")
PARTITIONS = 3
BATCH = 10_000


class LostOffsets(RuntimeError):
    """The log no longer holds messages that were not read yet."""


def _located(path: str) -> tuple[fs.FileSystem, str]:
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path.rstrip("/"))


@dataclass(frozen=True)
class Segment(InputPartition):
    """Messages ``first`` to ``end`` of a partition, of which those from ``start`` to ``upto`` are wanted."""

    partition: int
    first: int
    end: int
    path: str
    start: int = 0
    upto: int = 0


def segments(path: str) -> dict[int, list[Segment]]:
    """The segments of each partition in their order."""
    system, folder = _located(path)
    found: dict[int, list[Segment]] = {}
    for info in system.get_file_info(fs.FileSelector(folder, recursive=True, allow_not_found=True)):
        if name := SEGMENT.search(info.path):
            partition, first, end = map(int, name.groups())
            found.setdefault(partition, []).append(Segment(partition, first, end, info.path))
    return {partition: sorted(own, key=lambda s: s.first) for partition, own in sorted(found.items())}


def between(path: str, start: dict, end: dict, allow_loss: bool = False) -> list[Segment]:
    """What lies between the offsets; a partition that ``start`` does not name begins with its first segment."""
    found, held = [], segments(path)
    for key, upto in sorted(end.items()):
        own = held.get(int(key), [])
        at = int(start.get(key, own[0].first if own else upto))
        for segment in own:
            if segment.end <= at or segment.first >= upto:
                continue
            if segment.first > at and not allow_loss:
                break
            found.append(Segment(segment.partition, segment.first, segment.end, segment.path, max(at, segment.first), min(upto, segment.end)))
            at = segment.end
        if at < upto and not allow_loss:
            raise LostOffsets(f"partition {key} of {path}: no message {at} any more, read up to there of {upto}")
    return found


def read_segment(path: str, segment: Segment) -> Iterator[pa.RecordBatch]:
    system, _ = _located(path)
    rows: list[tuple[int, str]] = []

    def batch() -> pa.RecordBatch:
        offsets, values = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(values, pa.string()), pa.array([segment.partition] * len(rows), pa.int32()), pa.array(offsets, pa.int64())],
            ["value", "partition", "offset"],
        )

    with system.open_input_stream(segment.path) as stream:
        for offset, line in enumerate(_lines(stream), segment.first):
            if offset >= segment.upto:
                break
            if offset >= segment.start:
                rows.append((offset, line.decode()))
            if len(rows) == BATCH:
                yield batch()
                rows.clear()
        if rows:
            yield batch()


def _lines(stream) -> Iterator[bytes]:
    rest = b""
    while block := stream.read(1 << 20):
        *whole, rest = (rest + block).split(b"\n")
        yield from whole
    if rest:
        yield rest


class _Batch(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]

    def partitions(self) -> list[Segment]:
        held = segments(self.path)
        return between(self.path, {}, {str(p): own[-1].end for p, own in held.items()}) or [Segment(0, 0, 0, "")]

    def read(self, partition: Segment) -> Iterator[pa.RecordBatch]:
        return read_segment(self.path, partition) if partition.path else iter(())


class _Stream(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.from_latest = options.get("startingoffsets", options.get("startingOffsets", "latest")) == "latest"
        self.limit = int(options.get("maxoffsetspertrigger", options.get("maxOffsetsPerTrigger", 0)))
        self.allow_loss = str(options.get("failondataloss", options.get("failOnDataLoss", "true"))).lower() == "false"
        self.position: dict[str, int] = {}

    def initialOffset(self) -> dict:
        held = segments(self.path)
        self.position = {str(p): own[-1].end if self.from_latest else own[0].first for p, own in held.items()}
        return self.position

    def latestOffset(self) -> dict:
        held = segments(self.path)
        last = {str(p): own[-1].end for p, own in held.items()}
        # what the log no longer lists at all stays where it is; a new partition begins with its first segment
        start = {key: self.position.get(key, held[int(key)][0].first) for key in last} | {k: v for k, v in self.position.items() if k not in last}
        waiting = {key: max(0, last.get(key, at) - at) for key, at in start.items()}
        total = sum(waiting.values())
        if self.limit and total > self.limit:
            left = self.limit
            for key, count in waiting.items():
                waiting[key] = min(count, -(-self.limit * count // total), left)
                left -= waiting[key]
        return {key: at + waiting[key] for key, at in start.items()}

    def partitions(self, start: dict, end: dict) -> list[Segment]:
        self.position = {key: int(at) for key, at in end.items()}  # also how a restarted stream learns where it was
        return between(self.path, start, end, self.allow_loss)

    def read(self, partition: Segment) -> Iterator[pa.RecordBatch]:
        return read_segment(self.path, partition)

    def commit(self, end: dict) -> None:
        """The checkpoint holds the position; segments are removed by their owner."""


@dataclass
class Appended(WriterCommitMessage):
    partition: int
    task: int
    count: int
    path: str


class _Append(DataSourceArrowWriter):
    """A task writes a file aside; the commit moves it behind the last segment of its partition, tasks in their order."""

    def __init__(self, options: dict):
        self.path, self.job = options["path"], uuid.uuid4().hex
        self.partitions = int(options.get("partitions", PARTITIONS))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Appended | None:
        from pyspark import TaskContext

        system, folder = _located(self.path)
        task, count = TaskContext.get().partitionId(), 0
        aside = f"{folder}/_aside/{self.job}-{task}-{uuid.uuid4().hex}"
        system.create_dir(f"{folder}/_aside", recursive=True)
        with system.open_output_stream(aside) as sink:
            for batch in iterator:
                for value in batch.column("value").to_pylist():
                    if value is not None:
                        sink.write(value.replace("\n", " ").encode() + b"\n")
                        count += 1
        return Appended(task % self.partitions, task, count, aside)

    def commit(self, messages: list[Appended | None]) -> None:
        system, folder = _located(self.path)
        ends = {partition: own[-1].end for partition, own in segments(self.path).items()}
        for message in sorted((m for m in messages if m and m.count), key=lambda m: (m.partition, m.task)):
            first = ends.get(message.partition, 0)
            ends[message.partition] = first + message.count
            target = f"{folder}/partition={message.partition}"
            system.create_dir(target, recursive=True)
            system.move(message.path, f"{target}/{first:020d}-{first + message.count:020d}.txt")
        self.abort(messages)

    def abort(self, messages: list[Appended | None]) -> None:
        system, folder = _located(self.path)
        for info in system.get_file_info(fs.FileSelector(f"{folder}/_aside", allow_not_found=True)):
            if info.base_name.startswith(self.job):
                system.delete_file(info.path)


class MessageLog(DataSource):
    """The format ``message_log``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "value string, partition int, offset long"

    def reader(self, schema) -> DataSourceReader:
        return _Batch(dict(self.options))

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _Stream(dict(self.options))

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return _Append(dict(self.options))


def append_messages(messages: DataFrame, path: str, key: str | None = None, partitions: int = PARTITIONS) -> None:
    """Adds the text column ``value``; messages of one ``key`` keep to one partition. One writer at a time.

    A partition gets as many segments as it takes to keep all cores at work, so that no task writes, or reads, a whole partition.
    """
    spark = messages.sparkSession
    spark.dataSource.register(MessageLog)
    tasks = partitions * -(-spark.sparkContext.defaultParallelism // partitions)
    dealt = messages.repartition(tasks, key) if key else messages.repartition(tasks)
    dealt.select(F.col("value").cast("string")).write.format(FORMAT).option("partitions", partitions).mode("append").save(path)


def read_log(
    spark: SparkSession, path: str, from_earliest: bool = False, per_trigger: int | None = None, allow_loss: bool = False
) -> DataFrame:
    """The log as a stream; the choices are those of ``feed.kafka_options``."""
    spark.dataSource.register(MessageLog)
    reader = spark.readStream.format(FORMAT).option("startingOffsets", "earliest" if from_earliest else "latest")
    if per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", per_trigger)
    return reader.option("failOnDataLoss", str(not allow_loss).lower()).load(path)
