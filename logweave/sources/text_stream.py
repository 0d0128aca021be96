"""The printed output as a streaming sink.

A task writes its lines to a file that no reader takes, and tells the driver its
name. When all tasks of a micro-batch are done, the driver renames the files into
the output, in the order of the tasks, and marks the batch. A batch that fails is
taken back; one that is repeated after it was finished adds nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamArrowWriter, WriterCommitMessage
from pyspark.sql.streaming import StreamingQuery

from ..operators.layout import format_sink_record
from ..storage import matching_parents
from .files import exists, opened
from .sink import SINK_HEADER

FORMAT = "logweave_lines"


class LineSink(DataSource):
    """Option: ``path``. Takes rows of one string column ``line``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def streamWriter(self, schema, overwrite: bool) -> "_Writer":
        if [f.simpleString() for f in schema] != ["line:string"]:
            raise ValueError(f"needs the column line string, not {schema.simpleString()}")
        return _Writer(self.options["path"])


@dataclass
class _Written(WriterCommitMessage):
    task: int
    file: str | None


class _Writer(DataSourceStreamArrowWriter):
    def __init__(self, path: str):
        self.path = path

    def write(self, iterator: Iterator[pa.RecordBatch]) -> _Written:
        system, root = opened(self.path)
        file, stream = None, None
        for batch in iterator:
            if stream is None:
                system.create_dir(f"{root}/_pending")
                file = f"{root}/_pending/{uuid.uuid4().hex}"
                stream = system.open_output_stream(file)
            for line in batch.column(0).to_pylist():
                stream.write(f"{line or ''}\n".encode())
        if stream is not None:
            stream.close()
        return _Written(TaskContext.get().partitionId(), file)

    def commit(self, messages, batchId: int) -> None:
        system, root = opened(self.path)
        target = f"{root}/records/batch={batchId:010d}"
        if exists(system, f"{target}/_SUCCESS"):
            return self.abort(messages, batchId)
        if not exists(system, f"{root}/header/part-0"):
            system.create_dir(f"{root}/header")
            with system.open_output_stream(f"{root}/header/part-0") as stream:
                stream.write(f"{SINK_HEADER}\n".encode())
        # A commit that failed half-way left files, whose lines come again.
        if exists(system, target):
            system.delete_dir_contents(target)
        system.create_dir(target)
        for m in messages:
            if m is not None and m.file:
                system.move(m.file, f"{target}/part-{m.task:05d}")
        with system.open_output_stream(f"{target}/_SUCCESS"):
            pass

    def abort(self, messages, batchId: int) -> None:
        system, _ = opened(self.path)
        for m in messages:
            if m is not None and m.file and exists(system, m.file):
                system.delete_file(m.file)


def stream_text_sink(stored: DataFrame, path: str, checkpoint: str,
                     trigger: dict | None = None) -> StreamingQuery:
    """Print a stream of stored records as it comes: the heading in
    ``path/header``, once, and the lines of micro-batch ``b`` in
    ``path/records/batch=<b>``. Files in name order follow the log if the stream
    does, as that of ``stream_positions``; ``printed_lines`` reads the finished
    batches."""
    spark = stored.sparkSession
    spark.dataSource.register(LineSink)
    return (format_sink_record(stored).select("line").writeStream.format(FORMAT)
            .option("path", path).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


def printed_lines(spark: SparkSession, path: str) -> DataFrame:
    """Heading and lines of the finished batches of a streaming sink."""
    done = matching_parents(spark, f"{path}/records/batch=*/_SUCCESS")
    return spark.read.text([f"{path}/header", *done]).select("value").withColumnRenamed(
        "value", "line")
