"""The test tables as keyed logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators import assign_key
from ..operators.spans import ROWS_PER_SPAN
from ..schema import keyed_log
from ..functions import text_lines
from ..sources import tokenize_text


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def events(spark: SparkSession, sf: str, value: str = "event_type",
           key: str = "user_id") -> DataFrame:
    return keyed_log(table(spark, sf, "events"), key, value, "event_id")


def orders(spark: SparkSession, sf: str) -> DataFrame:
    return keyed_log(table(spark, sf, "orders"), "o_custkey", "o_orderstatus",
                     "o_orderkey")


def conversations(spark: SparkSession, sf: str) -> DataFrame:
    return keyed_log(table(spark, sf, "conversations"), "conv_id", "role",
                     "turn")


def words(spark: SparkSession, sf: str) -> DataFrame:
    """Words of all documents under five keys, taken in turn along a line."""
    tokens = tokenize_text(table(spark, sf, "documents"), "text", "doc_id")
    return assign_key(tokens, F.get("ord", F.lit(0)) + F.get("ord", F.lit(1))
                      + F.get("ord", F.lit(2))).select("key", "value", "ord")


def share_of(log: DataFrame, parts: int) -> int:
    """Rows per span such that even small tables are split."""
    return min(log.count() // parts + 1, ROWS_PER_SPAN)


def at(position: int, name: str) -> Column:
    return F.get("ord", F.lit(position)).alias(name)


def flat(log: DataFrame, *names: str) -> DataFrame:
    """Key, value and the parts of the position as plain columns."""
    return log.select("key", "value", *[at(i, n) for i, n in enumerate(names)])


def named_lines(df: DataFrame, text: str, *ids: str) -> DataFrame:
    """``value``: every line of the texts, after its name (the ids and the line's
    number in the text) and a tab."""
    lines = df.filter(F.col(text).isNotNull()).select(
        *ids, F.posexplode(text_lines(F.col(text))).alias("at", "line"))
    return lines.select(F.concat(F.concat_ws("/", *[F.col(i).cast("string") for i in ids],
                                             F.col("at").cast("string")),
                                 F.lit("\t"), F.col("line")).alias("value"))


def lines_by_name(lines: DataFrame) -> DataFrame:
    """Split the ``line`` that was read into its name and the line itself."""
    at_tab = F.instr("line", "\t")
    return lines.withColumn("name", F.substring_index("line", "\t", 1)).withColumn(
        "line", F.substring(F.col("line"), at_tab + 1, F.length("line")))
