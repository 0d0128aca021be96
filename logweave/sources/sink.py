"""Printed output and counters."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F

from ..operators.layout import format_sink_record

# Fixed value: the first line of the printed output.
SINK_HEADER = "SINK RECORDS"


def text_sink(stored: DataFrame, path: str, ordered: bool = True,
              mode: str = "overwrite") -> None:
    """Write stored records as text lines.

    ``path/header`` has the heading and ``path/records`` the lines. Ordered
    output is range-partitioned, so the part files in name order follow
    partition and offset.
    """
    spark = stored.sparkSession
    lines = format_sink_record(stored)
    if ordered:
        lines = lines.orderBy("partition", "offset")
    (spark.range(1).select(F.lit(SINK_HEADER).alias("line"))
     .write.mode(mode).text(f"{path}/header"))
    lines.select("line").write.mode(mode).text(f"{path}/records")


def observe_stage(log: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count what passes a stage while the query runs."""
    seen = Observation(name)
    return log.observe(seen, F.count(F.lit(1)).alias("records"),
                       F.max("ord").alias("last_ord")), seen
