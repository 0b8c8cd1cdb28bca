"""Landed event lines as a stream source whose offsets are event times.

``land_by_time`` writes event lines into folders of a span of event time each.  The source
``landed_events`` reads them: an offset says up to which event time spans were read, and a
micro-batch takes the spans between two offsets, dealt to tasks by bytes.  Spans are read once they are
closed, that is once a later span has begun (``drain`` closes the newest as well).

The same two offsets give the same rows whenever they are read: an offset also holds how far
the files of its spans had been written, and files that land in a span later than that are not
part of it.  Such lines are late, as lines before the start offset are; ``read_events`` still has
them.  A stream that is to start somewhere else than at the first line takes ``start`` in
microseconds.

The source lists and opens files through pyarrow, on the driver and in tasks, so it reads
what pyarrow has a file system for.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

FORMAT = "landed_events"
SPAN = "span"
# How much event time a folder holds.
SPAN_US = 10_000_000
# How much a task holds at once, and how many bytes of files one task reads (a larger file is one task's).
BLOCK_BYTES, TASK_BYTES = 1 << 22, 1 << 26


def land_by_time(lines: DataFrame, path: str, span_us: int = SPAN_US, payload: str = "value") -> None:
    """Append event lines to the folders of their event time; lines without one get folder -1, which no stream reads."""
    stamp = F.get_json_object(payload, "$.time_us").try_cast("bigint")
    span = F.coalesce(stamp - F.pmod(stamp, F.lit(span_us)), F.lit(-1))
    spread = lines.select(F.col(payload).alias("value"), span.alias(SPAN))
    spread.hint("rebalance", F.col(SPAN)).write.mode("append").partitionBy(SPAN).text(path)


def spans(spark: SparkSession, path: str, since_us: int = 0, until_us: int | None = None) -> DataFrame:
    """The landed lines of a stretch of event time, as a batch."""
    rows = spark.read.text(path).filter(F.col(SPAN) >= since_us)
    return rows.filter(F.col(SPAN) < until_us) if until_us is not None else rows


@dataclass
class LandedFiles(InputPartition):
    paths: list[str]


class LandedEvents(DataSource):
    """Options: ``path``, ``span_us``, ``start`` (the first event time wanted), ``drain``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "value string"

    def streamReader(self, schema) -> "LandedEventsReader":
        return LandedEventsReader(self.options)


class LandedEventsReader(DataSourceStreamReader):
    def __init__(self, options):
        self.path = options["path"]
        self.span_us = int(options.get("span_us", SPAN_US))
        self.start = int(options.get("start", 0))
        self.drain = options.get("drain", "false").lower() == "true"

    def _files(self) -> list[tuple[int, int, str, int]]:
        """``(span, written at, path, bytes)`` of every landed file."""
        system, root = fs.FileSystem.from_uri(self.path) if "://" in self.path else (fs.LocalFileSystem(), self.path)
        found = []
        for info in system.get_file_info(fs.FileSelector(root, allow_not_found=True, recursive=True)):
            parent, _, name = info.path.rpartition("/")
            folder = parent.rpartition("/")[2]
            if info.type == fs.FileType.File and name[0] not in "._" and folder.startswith(f"{SPAN}="):
                span = int(folder.removeprefix(f"{SPAN}="))
                if span >= 0:
                    found.append((span, info.mtime_ns, info.path, info.size))
        return found

    def _offset(self, time_us: int, files: list[tuple[int, int, str, int]]) -> dict:
        return {"time_us": time_us, "written_ns": max((at for span, at, *_ in files if span < time_us), default=0)}

    def initialOffset(self) -> dict:
        return {"time_us": self.start, "written_ns": 0}

    def latestOffset(self) -> dict:
        files = self._files()
        newest = max((span for span, *_ in files), default=None)
        if newest is None:
            return self.initialOffset()
        end = newest + self.span_us if self.drain else newest
        return self._offset(max(end, self.start), files)

    def partitions(self, start: dict, end: dict) -> list[LandedFiles]:
        first, parts, held = start["time_us"] - start["time_us"] % self.span_us, [], 0
        for span, at, path, size in sorted(self._files()):
            if first <= span < end["time_us"] and at <= end["written_ns"]:
                if not parts or held + size > TASK_BYTES:
                    parts.append(LandedFiles([]))
                    held = 0
                parts[-1].paths.append(path)
                held += size
        return parts

    def read(self, partition: LandedFiles) -> Iterator[pa.RecordBatch]:
        system = fs.FileSystem.from_uri(self.path)[0] if "://" in self.path else fs.LocalFileSystem()
        for path in partition.paths:
            with system.open_input_stream(path) as stream:
                rest = b""
                while block := stream.read(BLOCK_BYTES):
                    *lines, rest = (rest + block).split(b"\n")
                    if lines:
                        yield self._lines(lines)
                if rest:
                    yield self._lines([rest])

    def _lines(self, lines: list[bytes]) -> pa.RecordBatch:
        # Lines need not be whole events, nor valid text.
        return pa.RecordBatch.from_pydict({"value": pa.array([line.decode("utf-8", "replace") for line in lines], pa.string())})


def read_events_by_time(
    spark: SparkSession, path: str, start_us: int = 0, span_us: int = SPAN_US, drain: bool = False
) -> DataFrame:
    """Landed lines as a stream with event-time offsets; the start's span is cut to the events that are wanted."""
    spark.dataSource.register(LandedEvents)
    options = {"path": path, "start": str(start_us), "span_us": str(span_us), "drain": str(drain)}
    lines = spark.readStream.format(FORMAT).options(**options).load()
    if not start_us:
        return lines
    return lines.filter(F.get_json_object("value", "$.time_us").try_cast("bigint") >= start_us)
