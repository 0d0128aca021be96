"""Keys, partitions and offsets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.strings import java_hash, sink_line
from .spans import SpanPlan, numbered


def assign_key(df: DataFrame, seq: Column | str, n_keys: int = 5) -> DataFrame:
    """Add ``key``: one of ``n_keys`` names, taken in turn along ``seq``.

    The choice is a function of the row, so a retried task repeats it.
    """
    seq = F.col(seq) if isinstance(seq, str) else seq
    return df.withColumn("key", F.concat(
        F.lit("Key"), F.pmod(seq.cast("bigint"), F.lit(n_keys)).cast("string")))


def assign_partition(log: DataFrame, partitions: int) -> DataFrame:
    """Add ``partition``; equal keys share one."""
    if partitions < 1:
        raise ValueError(f"need at least one partition, got {partitions}")
    return log.withColumn("partition", F.pmod(
        java_hash(F.col("key")), F.lit(partitions)).cast("int"))


def assign_offset(log: DataFrame, spans: SpanPlan | None = None,
                  start: DataFrame | None = None) -> DataFrame:
    """Add ``offset``: dense and increasing along ``ord`` in each partition.

    ``spans`` is planned over the group ``partition``; its ``rows`` are then the
    log. ``start`` gives the next
    free offset per partition (``partition``, ``next_offset``) of a log being
    appended to, one row per partition.
    """
    columns = [c for c in log.columns if c != "span"]
    rows, spec = numbered(log, "partition", spans, ["ord", "key"], reach=1)
    place = F.struct("ord", "key")
    offset = F.when(F.lag(place).over(spec) == place, F.raise_error(F.concat(
        F.lit("position used twice, for key "), F.col("key")))).otherwise(F.col("n") - 1)
    rows = rows.withColumn("n", offset)
    offset = F.col("n")
    rows = rows.filter(F.col("n0").isNull())
    if start is not None:             # one row per partition of the log
        rows = rows.join(F.broadcast(start.select("partition", "next_offset")),
                         "partition", "left")
        offset = offset + F.coalesce("next_offset", F.lit(0))
    return rows.select(*columns, offset.cast("bigint").alias("offset"))


def format_sink_record(stored: DataFrame) -> DataFrame:
    """The printed line of each stored record, as column ``line``."""
    return stored.select("partition", "offset", sink_line(
        F.col("partition"), F.col("offset"), F.col("key"), F.col("value")
    ).alias("line"))
