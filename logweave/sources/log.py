"""The stored log: batches of Parquet folders by partition, with offsets.

A batch and the note that belongs to it (the next offsets after it, and the
names of the appends so far) become visible by one rename. Batch writes and the
hops of a stream share this layout and the readers.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..operators.layout import assign_offset, assign_partition
from ..operators.spans import ROWS_PER_SPAN, plan_spans
from ..schema import LOG_SCHEMA, STORED_SCHEMA
from ..storage import (drop_path, has_files, matching_parents, move, publish, published,
                       read_text, scratch_path, write_text)

_NOTE = "_log.json"
_STORED = [f.name for f in STORED_SCHEMA]


def log_note(spark: SparkSession, path: str, before: int | None = None) -> dict | None:
    """What the log's last batch (or the last one before a number) notes:
    ``batch``, ``partitions``, ``next`` (offset by partition) and ``appends``."""
    done = [n for n in published(spark, path) if before is None or n < before]
    if not done:
        return None
    return json.loads(read_text(spark, f"{path}/batch={done[-1]}/{_NOTE}"))


def publish_batch(log: DataFrame, path: str, number: int, partitions: int,
                  kept: dict | None = None, append_id: str | None = None,
                  rows_per_span: int | None = None) -> bool:
    """Store a keyed log as batch ``number``, its offsets behind those that
    ``kept`` notes. A large partition is numbered and written by several tasks;
    rows leave the numbering step grouped by partition, so the write needs no
    further shuffle."""
    spark = log.sparkSession

    def write(hidden: str) -> None:
        placed = assign_partition(
            log.select("key", F.col("value").cast("string"), "ord"), partitions)
        following = {int(p): n for p, n in kept["next"].items()} if kept else {}
        start = spark.createDataFrame(list(following.items()), "partition int, next_offset long") \
            if following else None
        spans = plan_spans(placed, "partition", rows_per_span)
        assign_offset(spans.rows, spans, start).write.partitionBy("partition").parquet(hidden)
        # A row for each partition of the log.
        for r in spans.rows.groupBy("partition").agg(F.count(F.lit(1)).alias("rows")).collect():
            following[r["partition"]] = following.get(r["partition"], 0) + r["rows"]
        appends = (kept["appends"] if kept else []) + ([append_id] if append_id else [])
        write_text(spark, f"{hidden}/{_NOTE}", json.dumps(
            {"batch": number, "partitions": partitions, "next": following, "appends": appends}))

    return publish(spark, path, f"batch={number}", write)


def write_log(log: DataFrame, path: str, partitions: int,
              mode: str = "overwrite", rows_per_span: int | None = None,
              append_id: str | None = None) -> None:
    """Store a keyed log, partition chosen by key, offsets dense.

    ``mode="append"`` continues the stored offsets; the number of partitions
    must be the log's, as a key stays in its partition. The number and the next
    offsets are kept with each batch, so an append doesn't read the log. Rows,
    offsets and the append's name appear together or not at all: after a failure
    at any point, an append that names itself with ``append_id`` may be repeated
    and counts once. A log has one writer at a time.
    """
    spark = log.sparkSession
    if mode == "overwrite":
        # What was there goes when the new rows are ready.
        fresh = f"{path}/_fresh"
        drop_path(spark, fresh)
        publish_batch(log, fresh, 0, partitions, None, append_id, rows_per_span)
        for n in published(spark, path):
            drop_path(spark, f"{path}/batch={n}")
        publish(spark, path, "batch=0", lambda hidden: move(spark, f"{fresh}/batch=0", hidden))
        return
    if mode != "append":
        raise ValueError(f"mode is overwrite or append, not {mode}")
    kept = log_note(spark, path)
    if kept:
        if kept["partitions"] != partitions:
            raise ValueError(f"the log has {kept['partitions']} partitions, not {partitions}")
        if append_id is not None and append_id in kept["appends"]:
            return
    elif has_files(spark, f"{path}/partition=*"):
        raise ValueError(f"{path} was not written by write_log")
    publish_batch(log, path, kept["batch"] + 1 if kept else 0, partitions, kept, append_id,
                  rows_per_span)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(STORED_SCHEMA).parquet(path).select(*_STORED)


def read_partition(spark: SparkSession, path: str, partition: int) -> DataFrame:
    """One partition; the others are not listed for reading."""
    return read_log(spark, path).filter(F.col("partition") == partition)


def stream_log(spark: SparkSession, path: str, stored: bool = True,
               **options) -> DataFrame:
    """A log as a stream. ``maxFilesPerTrigger`` and ``maxBytesPerTrigger``
    bound what one micro-batch takes in, the oldest files first: where windows follow,
    files must then be in order, as ``append_in_order`` writes them."""
    names = _STORED if stored else [f.name for f in LOG_SCHEMA]
    # With the columns of the folders, in their order, as the first of these may
    # appear when the stream already runs.
    schema = T.StructType([STORED_SCHEMA[n] for n in names if n != "partition"]).add(
        "batch", T.LongType())
    if stored:
        schema = schema.add(STORED_SCHEMA["partition"])
    return spark.readStream.schema(schema).options(**options).parquet(path).select(*names)


def append_in_order(log: DataFrame, path: str, rows_per_file: int = ROWS_PER_SPAN) -> None:
    """Add a keyed log to a folder as files of about ``rows_per_file`` rows, for a
    stream that takes a few files at a time.

    Such a stream takes the oldest files first, and a window wants each key's records
    in order. Files that tasks write side by side end in any order, and hold
    positions among each other's where the log isn't sorted. These follow each other
    by position, and by age, as each is written when the one before it is there. What
    the folder holds already should precede the log. The log is counted, then moved
    once; a record of one key and position stays beside its like.
    """
    spark = log.sparkSession
    files = -(-log.count() // rows_per_file)
    if files <= 1:
        log.repartition(1).write.mode("append").parquet(path)
        return
    cut = scratch_path(spark, "in-order")
    placed = log.repartitionByRange(files, "ord", "key").withColumn(
        "file", F.spark_partition_id())
    placed.write.partitionBy("file").parquet(cut)
    shares = spark.read.schema(placed.schema).parquet(cut)
    for k in range(files):
        shares.filter(F.col("file") == k).drop("file").coalesce(1).write.mode("append").parquet(
            path)
    drop_path(spark, cut)


def read_committed(spark: SparkSession, path: str) -> DataFrame:
    """The finished batches a stream has written below ``path``."""
    done = matching_parents(spark, f"{path}/batch=*/_SUCCESS")
    if not done and has_files(spark, f"{path}/*.parquet"):
        raise ValueError(f"{path} holds rows, but was not written in batches")
    if not done:
        return spark.createDataFrame([], LOG_SCHEMA).withColumn(
            "batch", F.lit(0).cast("bigint"))
    return spark.read.option("basePath", path).parquet(*done).withColumn(
        "batch", F.col("batch").cast("bigint"))


def log_from_topic(records: DataFrame) -> DataFrame:
    """Keyed log of the columns Spark's message-log connectors deliver (binary
    key and value, partition, offset); the offset orders a key's records, as
    equal keys share a partition."""
    return records.filter(
        "key is not null and value is not null and offset is not null").select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        F.array(F.col("offset").cast("bigint")).alias("ord"))
