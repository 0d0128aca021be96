"""A training corpus from raw documents: STAGES are applied in turn, each to
all that the one before it kept, written as Parquet between them.

Documents have ``doc_id`` and ``text``; further columns, whatever they are called,
go along unchanged up to the last stage. Null and empty texts and null ids pass
through every stage; an empty table gives an empty one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from logweave.llm.catalog import PIECES
from logweave.llm.decontamination import decontaminate
from logweave.llm.ngram_join import keep_representatives
from logweave.llm.sentencepiece_scan import decode, encode
from logweave.llm.substring_dedup import substring_dedup
from logweave.llm.toxicity import drop_toxic, learn_lexicon
from logweave.storage import scratch_path, settle


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the learned lexicon rejects go. A null or empty text is not
    rejected; repeated rows fare alike."""
    return drop_toxic(docs, learn_lexicon(docs, _table(spark, sf_dir, "labels")))


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, that of the smallest id; rows
    that repeat id and text leave as one. Texts without a word are no copies."""
    return keep_representatives(docs)


def substring_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts lose passages that an earlier document has, and may be empty then; rows
    that repeat id and text lose the same. A column ``removed_spans`` is dropped."""
    return substring_dedup(docs).drop("removed_spans")


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with an item of the benchmark go; null and empty texts have none."""
    return decontaminate(docs, _table(spark, sf_dir, "benchmark"))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every text, and the text that they decode to, in chunks; of a
    null text, null. The ids are written in between: a task that did both would hold
    two Python workers, and an executor keeps all that it ever had at once."""
    return decode(settle(encode(docs, PIECES), "pieces"), PIECES)


STAGES = [
    ("toxicity", toxicity),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("substring_dedup", substring_deduplication),
    ("benchmark_decontamination", benchmark_decontamination),
    ("sentencepiece", sentencepiece),
]

#: No stage but the last could be told in SQL: the lexicon is learned, the joins
#: are by similarity. tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
