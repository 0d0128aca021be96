"""A stored log as a streaming source with positions.

The stream's position is the next offset of each partition, so that a query can
be pinned to some partitions, what it has committed are offsets of the log, and
its lag is a difference of offsets, also while it runs. A micro-batch reads the
files of the batches of the log that hold its offsets, a task for each file.
"""

from __future__ import annotations

import ast
import json
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.streaming import StreamingQuery

from ..schema import STORED_SCHEMA
from ..storage import has_files, read_text
from .files import exists, names, opened, text_of
from .log import log_note

FORMAT = "logweave_log"


class LogSource(DataSource):
    """Options: ``path``, and ``partitions``, a list like ``0,3`` (default: all)."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self):
        return STORED_SCHEMA

    def streamReader(self, schema) -> "_Reader":
        pinned = self.options.get("partitions")
        return _Reader(self.options["path"],
                       [int(p) for p in pinned.split(",")] if pinned else None)


class _Range(InputPartition):
    """Offsets from ``first`` to below ``end`` in one file of a partition."""

    def __init__(self, partition: int, file: str, first: int, end: int):
        self.partition, self.file, self.first, self.end = partition, file, first, end


class _Reader(DataSourceStreamReader):
    def __init__(self, path: str, pinned: list[int] | None):
        self.path, self.pinned = path, pinned

    def _notes(self) -> list[dict]:
        """Notes of the finished batches, oldest first."""
        system, root = opened(self.path)
        numbers = sorted(int(n[6:]) for n in names(system, root) if n.startswith("batch="))
        return [json.loads(text_of(system, f"{root}/batch={n}/_log.json")) for n in numbers
                if exists(system, f"{root}/batch={n}/_SUCCESS")]

    def _last(self) -> dict | None:
        system, root = opened(self.path)
        numbers = sorted((int(n[6:]) for n in names(system, root) if n.startswith("batch=")),
                         reverse=True)
        for n in numbers:
            if exists(system, f"{root}/batch={n}/_SUCCESS"):
                return json.loads(text_of(system, f"{root}/batch={n}/_log.json"))
        return None

    def _wanted(self, note: dict) -> list[int]:
        return [p for p in range(note["partitions"]) if self.pinned is None or p in self.pinned]

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        note = self._last()
        return {} if note is None else {
            str(p): note["next"].get(str(p), 0) for p in self._wanted(note)}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        system, root = opened(self.path)
        out: list[_Range] = []
        before: dict = {}
        for note in self._notes():
            for p in self._wanted(note):
                name = str(p)
                first = max(before.get(name, 0), start.get(name, 0))
                last = min(note["next"].get(name, 0), end.get(name, 0))
                if first < last:
                    folder = f"{root}/batch={note['batch']}/partition={p}"
                    out.extend(_Range(p, f"{folder}/{file}", first, last)
                               for file in names(system, folder) if file.endswith(".parquet"))
            before = note["next"]
        # In this order the tasks, and what they write, follow the log.
        return sorted(out, key=lambda r: (r.partition, r.first))

    def read(self, partition: _Range) -> Iterator[pa.RecordBatch]:
        system, _ = opened(self.path)
        with system.open_input_file(partition.file) as file:
            for batch in pq.ParquetFile(file).iter_batches(
                    columns=["key", "value", "ord", "offset"]):
                at = batch.column("offset")
                kept = batch.filter(pc.and_(pc.greater_equal(at, partition.first),
                                            pc.less(at, partition.end)))
                if kept.num_rows:
                    yield pa.RecordBatch.from_arrays(
                        [*[kept.column(c) for c in ("key", "value", "ord", "offset")],
                         pa.array([partition.partition] * kept.num_rows, pa.int32())],
                        [f.name for f in STORED_SCHEMA])

    def commit(self, end: dict) -> None:
        pass


def stream_positions(spark: SparkSession, path: str,
                     partitions: list[int] | None = None) -> DataFrame:
    """A stored log as a stream of its records with partition and offset, from the
    beginning; ``partitions`` pins it."""
    spark.dataSource.register(LogSource)
    reader = spark.readStream.format(FORMAT).option("path", path)
    if partitions is not None:
        reader = reader.option("partitions", ",".join(map(str, partitions)))
    return reader.load()


def committed_positions(spark: SparkSession, checkpoint: str, source: int = 0) -> dict[int, int]:
    """The next offset of each partition that a stream has finished with, from its
    checkpoint: whether it runs, has ended or has failed."""
    number = 0
    if not has_files(spark, f"{checkpoint}/commits/0"):
        return {}
    while has_files(spark, f"{checkpoint}/commits/{number + 1}"):
        number += 1
    # A version, the batch's settings, then a line for each source.
    line = read_text(spark, f"{checkpoint}/offsets/{number}").splitlines()[2 + source]
    return {int(p): n for p, n in json.loads(line).items()}


def running_positions(query: StreamingQuery, source: int = 0) -> dict[int, int]:
    """The same of a running query, from its last progress."""
    progress = query.lastProgress
    if progress is None:
        return {}
    end = progress["sources"][source]["endOffset"]
    end = ast.literal_eval(end) if isinstance(end, str) else end   # a dict as text
    return {int(p): n for p, n in (end or {}).items()}


def stream_lag(spark: SparkSession, path: str, positions: dict[int, int]) -> DataFrame:
    """``partition, end_offset, next_offset, lag`` of a reader of the log at
    ``positions``; partitions it isn't at count from 0. The log isn't read: its
    last note has the ends."""
    note = log_note(spark, path) or {"partitions": 0, "next": {}}
    ends = {p: note["next"].get(str(p), 0) for p in range(note["partitions"])}
    return spark.createDataFrame(
        [(p, end, positions.get(p, 0), end - positions.get(p, 0)) for p, end in ends.items()],
        "partition int, end_offset long, next_offset long, lag long")
