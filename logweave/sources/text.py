"""Text into lines and words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.strings import java_split, text_lines


def _positioned(lines: DataFrame, batch: int | None = None) -> DataFrame:
    """``line`` and ``ord``: in a stream the micro-batch, then file age, file,
    block start, row within the task.

    One task reads a block from front to back, so the row id increases along
    it. Files are ordered as a file stream takes them, oldest first; files of
    one age or older ones may come in a later micro-batch.
    """
    return lines.select(
        F.col("value").alias("line"),
        F.array(
            *([] if batch is None else [F.lit(batch).cast("bigint")]),
            F.unix_micros(F.col("_metadata.file_modification_time")),
            F.xxhash64("_metadata.file_path"),
            F.col("_metadata.file_block_start"),
            F.monotonically_increasing_id()).alias("ord"))


def read_lines(spark: SparkSession, path) -> DataFrame:
    """Lines of UTF-8 text files with their position."""
    return _positioned(spark.read.text(path))


def stream_lines(spark: SparkSession, path: str, **options) -> DataFrame:
    """Text files as a stream. Positions are set per micro-batch: pass
    ``prepare=lines_prepared(...)`` to the stream run."""
    return spark.readStream.options(**options).text(path).select(
        "value", "_metadata")


def lines_prepared(to_log):
    """Turn a function of positioned lines into a stream's ``prepare`` step."""
    return lambda batch, number: to_log(_positioned(batch, number))


def _words(df: DataFrame, line: Column, keep: list[str]) -> DataFrame:
    return df.select(*keep, "ord", F.posexplode(java_split(line)).alias(
        "pos", "value")).select(
        *keep, "value",
        F.concat("ord", F.array(F.col("pos").cast("bigint"))).alias("ord"))


def tokenize_lines(lines: DataFrame, line: str = "line",
                   keep: list[str] | None = None) -> DataFrame:
    """Words of positioned lines: ``value``, and ``ord`` with the place of the
    word in its line."""
    return _words(lines, F.col(line), keep or [])


def tokenize_text(df: DataFrame, text: str, seq: str,
                  keep: list[str] | None = None) -> DataFrame:
    """Words of whole texts held in a column; ``ord`` is (seq, line, word)."""
    keep = keep or []
    lines = df.filter(F.col(text).isNotNull()).select(
        *keep, F.col(seq).cast("bigint").alias("seq"),
        F.posexplode(text_lines(F.col(text))).alias("at", "line"))
    lines = lines.select(*keep, "line", F.array(
        F.col("seq"), F.col("at").cast("bigint")).alias("ord"))
    return _words(lines, F.col("line"), keep)
