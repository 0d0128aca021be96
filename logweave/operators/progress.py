"""Reading progress: committed offsets, lag and silent catch-up."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, functions as F

from ..functions.aggregates import concat
from .spans import SpanPlan, in_all_spans
from .window import apply_aggregate, fresh_frames


def committed_offsets(processed: DataFrame) -> DataFrame:
    """The next offset to read per partition: the last processed, plus one."""
    return processed.groupBy("partition").agg(
        (F.max("offset") + 1).alias("next_offset"))


def consumer_lag(log: DataFrame, committed: DataFrame) -> DataFrame:
    """End offset, committed offset and their distance, per partition.

    Both sides are one row per partition when they meet.
    """
    end = committed_offsets(log).withColumnRenamed("next_offset", "end_offset")
    return end.join(committed, "partition", "left").select(
        "partition", "end_offset",
        F.coalesce("next_offset", F.lit(0)).alias("next_offset"),
        (F.col("end_offset") - F.coalesce("next_offset", F.lit(0))).alias("lag"))


def catch_up(log: DataFrame, emitted: DataFrame, size: int = 3, slide: int = 1,
             fn: Callable = concat, spans: SpanPlan | None = None) -> DataFrame:
    """Rebuild the window state from the whole log, but give out only what
    follows the last emitted position of each key.

    ``emitted`` has ``key`` and ``ord``, any number of rows per key.
    """
    last = emitted.groupBy("key").agg(F.max("ord").alias("emitted_ord"))
    rows = apply_aggregate(fresh_frames(log, size, slide, spans, fn=fn), fn)
    on = ["key"]
    if spans:                         # keep the split of large keys
        last, on = in_all_spans(last, spans), ["key", "span"]
    return (rows.join(last, on, "left")
            .filter(F.col("emitted_ord").isNull()
                    | (F.col("ord") > F.col("emitted_ord")))
            .select("key", "value", "ord"))
