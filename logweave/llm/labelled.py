"""Bounded samples of labelled documents, on which models are fitted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(id_col: str = "doc_id") -> Column:
    """Documents no model learns from: crc32 of the id as text, modulo 5, is 0.
    A null id is not held out."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")),
                             F.lit(5)) == 0, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str,
                    label_col: str, most: int) -> DataFrame:
    """``doc_id, text, label`` of about ``most`` labelled documents, chosen by a
    hash of the id before any join. Held-out documents, null texts and ids with
    contradictory labels are left out."""
    clean = labels.where(F.col(label_col).isNotNull()).groupBy(
        F.col(id_col).alias("doc_id")).agg(
            F.min(F.col(label_col).cast("int")).alias("label"),
            F.max(F.col(label_col).cast("int")).alias("_most")).where(
        (F.col("label") == F.col("_most")) & ~held_out("doc_id"))
    share = min(1.0, most / max(clean.count(), 1))
    few = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)) <= int(share * (1 << 40))
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias(
        "text")).where(F.col("text").isNotNull())
    return texts.where(few).join(clean.select("doc_id", "label").where(few), "doc_id")
