"""Shared-folder helpers: scratch paths and tables that cut a plan's lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: A task that multiplied its rows leaves several files, which are then read
#: by as many tasks.
ROWS_PER_FILE = 500_000


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only where none is named and driver and tasks are one process, as in
    tests, a temporary one is set; a cluster without one is an error.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None:
        named = context.getCheckpointDir()
    if named is None:
        if not context.master.startswith("local[") and context.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the "
                             "driver and all executors share")
        named = "file:" + tempfile.mkdtemp(prefix="logweave-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(named)
    return named.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path under the shared folder."""
    return f"{shared_folder(spark)}/logweave/{label}-{uuid.uuid4().hex}"


def settle(df: DataFrame, label: str = "settled", **options: str) -> DataFrame:
    """Write a DataFrame once and read it back.

    Several passes over the result see the same rows at the price of column-
    pruned scans, and a lost executor costs a re-read instead of a recompute.
    Like checkpoint files, the table stays until the shared folder is cleaned.
    """
    return _settled(df, scratch_path(df.sparkSession, label), **options)


def _settled(df: DataFrame, path: str, **options: str) -> DataFrame:
    df.write.options(maxRecordsPerFile=ROWS_PER_FILE, **options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scratch_tables(spark: SparkSession):
    """Gives a ``settle`` whose tables go when the block ends, but for those that
    it is told to ``keep``: for steps whose result is itself written."""
    made: list[str] = []

    def temporary(df: DataFrame, label: str = "settled", keep: bool = False,
                  **options: str) -> DataFrame:
        path = scratch_path(spark, label)
        if not keep:
            made.append(path)
        return _settled(df, path, **options)

    yield temporary
    for path in made:
        drop_path(spark, path)


def _file_system(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def matching_parents(spark: SparkSession, pattern: str) -> list[str]:
    """Folders of the files a glob matches."""
    fs, jpath = _file_system(spark, pattern)
    found = fs.globStatus(jpath) or []
    return sorted(str(s.getPath().getParent().toString()) for s in found)


def published(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of the finished batches in a folder, ascending."""
    return sorted(int(p.rpartition("=")[2])
                  for p in matching_parents(spark, f"{folder}/batch=*/_SUCCESS"))


def publish(spark: SparkSession, folder: str, name: str,
            write: Callable[[str], None]) -> bool:
    """Make ``folder/name`` visible to readers in whole or not at all.

    ``write`` gets a hidden path and puts tables and notes there; one rename then
    shows them. What is there already stays and nothing is written: the name
    stands for the content, as a repeated micro-batch gives the same rows, and a
    stream that has taken these files isn't given others. Returns whether it
    wrote. One writer at a time may publish a name.
    """
    fs, target = _file_system(spark, f"{folder}/{name}")
    if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(target, "_SUCCESS")):
        return False
    fs.delete(target, True)
    hidden = f"{folder}/_pending-{uuid.uuid4().hex}"
    write(hidden)
    if not fs.rename(spark._jvm.org.apache.hadoop.fs.Path(hidden), target):
        raise OSError(f"cannot rename {hidden}")
    return True


def move(spark: SparkSession, source: str, target: str) -> None:
    fs, jpath = _file_system(spark, source)
    if not fs.rename(jpath, spark._jvm.org.apache.hadoop.fs.Path(target)):
        raise OSError(f"cannot rename {source}")


def make_folder(spark: SparkSession, path: str) -> None:
    fs, jpath = _file_system(spark, path)
    fs.mkdirs(jpath)


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text, or None."""
    fs, jpath = _file_system(spark, path)
    if not fs.exists(jpath):
        return None
    stream = fs.open(jpath)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Replace a small file."""
    fs, jpath = _file_system(spark, path)
    stream = fs.create(jpath, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def has_files(spark: SparkSession, pattern: str) -> bool:
    fs, jpath = _file_system(spark, pattern)
    return bool(fs.globStatus(jpath))


def drop_path(spark: SparkSession, path: str) -> None:
    fs, jpath = _file_system(spark, path)
    fs.delete(jpath, True)
