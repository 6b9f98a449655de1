"""A message log with numbered messages, and its streaming source (SRC4, STR1, STR6).

``append_messages`` adds a segment: parquet files whose rows carry consecutive
offsets, in a folder named by its first offset and its number of rows.  The
reader finds the end of the log from folder names alone.

The streaming source ``message_log`` decides when a batch is admitted, as a
consumer with a buffer does: once ``minRows`` messages wait, or once any wait
and ``maxDelay`` seconds have passed since the last batch.  What a batch has
finished is acknowledged in the log under the consumer's ``group``; a reader
that starts again goes on from Spark's checkpoint, and what waits there has
waited long enough.

One writer at a time; any number of readers with groups of their own.
"""

from __future__ import annotations

import json
import sys
import time
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from raresift.operators.persist import discard, materialize

FORMAT = "message_log"
SCHEMA = "offset long, value string"
# A batch at so many waiting messages, or after so many seconds.
MIN_ROWS = 50
MAX_DELAY = 1.0
#: Rows that one task reads.
TASK_ROWS = 500_000


def _file_system(path: str):
    """(file system, path on it) of a path or URI."""
    from pyarrow import fs

    if path.startswith("file:"):
        path = "/" + path[len("file:") :].lstrip("/")
    return fs.FileSystem.from_uri(path)


def log_segments(path: str) -> list[tuple[int, int, str]]:
    """(first offset, rows, folder) of the written segments, in order."""
    from pyarrow import fs

    files, root = _file_system(path)
    found = []
    for info in files.get_file_info(fs.FileSelector(f"{root}/segments", allow_not_found=True)):
        first, _, rows = info.base_name.partition("-")
        if first.isdigit() and rows.isdigit() and files.get_file_info(f"{info.path}/_SUCCESS").type == fs.FileType.File:
            found.append((int(first), int(rows), info.path))
    return sorted(found)


def log_end(path: str) -> int:
    """The offset that the next message gets."""
    segments = log_segments(path)
    return segments[-1][0] + segments[-1][1] if segments else 0


def append_messages(messages: DataFrame, path: str) -> int:
    """Add the ``value`` texts of a DataFrame as one segment; returns the log's new end.

    Rows are numbered in the order of their tasks: the rows of each task are
    counted once, and the counts (a row a task) become offsets.
    """
    task, serial = F.spark_partition_id(), F.monotonically_increasing_id()
    staged = materialize(messages.select(F.col("value").cast("string").alias("value"), task.alias("task"), serial.alias("serial")), "messages")
    tasks = staged.groupBy("task").agg(F.count(F.lit(1)).alias("rows"), F.min("serial").alias("least")).orderBy("task").collect()
    end = log_end(path)
    first, starts = end, []
    for t in tasks:
        starts.append((t["task"], end - t["least"]))
        end += t["rows"]
    if starts:
        shifts = staged.sparkSession.createDataFrame(starts, "task int, shift long")
        numbered = staged.join(F.broadcast(shifts), "task").select((F.col("serial") + F.col("shift")).alias("offset"), "value")
        numbered.sortWithinPartitions("offset").write.parquet(f"{path.rstrip('/')}/segments/{first:020d}-{end - first}")
    discard(staged)
    return end


@dataclass
class LogRange(InputPartition):
    """Messages ``start`` to ``end`` (excluded) of one segment."""

    folder: str
    start: int
    end: int


class MessageLogReader(DataSourceStreamReader):
    """Admits batches of a log by waiting rows or by time."""

    def __init__(self, options):
        self.path = options["path"]
        self.group = options.get("group", "default")
        self.min_rows = int(options.get("minRows", MIN_ROWS))
        self.max_delay = float(options.get("maxDelay", MAX_DELAY))
        self.now: dict | None = None
        self.last = 0.0

    def _acknowledged_file(self):
        files, root = _file_system(self.path)
        return files, f"{root}/groups/{self.group}"

    def acknowledged(self) -> int:
        """The offset before which this group has finished all messages."""
        from pyarrow import fs

        files, at = self._acknowledged_file()
        if files.get_file_info(at).type != fs.FileType.File:
            return 0
        with files.open_input_stream(at) as stream:
            return int(json.loads(stream.read())["offset"])

    def initialOffset(self) -> dict:  # noqa: N802 (Spark's name)
        return {"offset": 0, "by": "start"}

    def latestOffset(self) -> dict:  # noqa: N802
        if self.now is None:
            self.now = {"offset": self.acknowledged(), "by": "start"}
        end = log_end(self.path)
        waiting = end - self.now["offset"]
        if waiting >= self.min_rows:
            self.now, self.last = {"offset": end, "by": "rows"}, time.monotonic()
        elif waiting > 0 and time.monotonic() - self.last > self.max_delay:
            self.now, self.last = {"offset": end, "by": "delay"}, time.monotonic()
        return self.now

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        out: list[InputPartition] = []
        for first, rows, folder in log_segments(self.path):
            lo, hi = max(first, start["offset"]), min(first + rows, end["offset"])
            out += [LogRange(folder, at, min(at + TASK_ROWS, hi)) for at in range(lo, hi, TASK_ROWS)]
        return out

    def read(self, partition: LogRange) -> Iterator:
        import pyarrow.compute as pc
        import pyarrow.dataset as ds

        files, _ = _file_system(self.path)
        inside = (pc.field("offset") >= partition.start) & (pc.field("offset") < partition.end)
        segment = ds.dataset(partition.folder, filesystem=files, format="parquet", exclude_invalid_files=True)
        for batch in segment.to_batches(columns=["offset", "value"], filter=inside):
            if batch.num_rows:
                yield batch

    def commit(self, end: dict) -> None:
        files, at = self._acknowledged_file()
        files.create_dir(at.rsplit("/", 1)[0], recursive=True)
        with files.open_output_stream(at) as stream:
            stream.write(json.dumps({"offset": end["offset"]}).encode())


class MessageLogSource(DataSource):
    """The streaming source ``message_log``; options path, group, minRows and maxDelay (seconds)."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> MessageLogReader:  # noqa: N802
        return MessageLogReader(self.options)


def register_message_log(spark: SparkSession) -> None:
    """Make ``spark.readStream.format("message_log")`` known to a session; its code travels with the plan."""
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(MessageLogSource)
