"""Queries of the operators over the corpus tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..storage import scratch_path, settle
from .conversation_repair import damage_and_repair
from .decontamination import contaminated
from .embedding_dedup import embedding_dedup
from .language_id import language_id
from .mixing import mix_sources
from .ngram_join import ngram_join
from .quality import quality_scores
from .sentencepiece_scan import decode, encode
from .sharding import shard_documents
from .substring_dedup import substring_dedup
from .toxicity import learn_lexicon, toxicity
from .training_order import write_training_order
from .whitening import whiten, whitened_components

#: Folder of the public tokenizers' files.
TOKENIZERS = "/opt/tokenizers"
PIECES = f"{TOKENIZERS}/piece_bpe_32k.model"
RANKS = f"{TOKENIZERS}/byte_bpe_multi_50k.tiktoken"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join(_table(spark, sf_dir, "documents")).drop("th")


def op2_histogram_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("text")
    return shard_documents(_table(spark, sf_dir, "documents")).select(
        "doc_id", (F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.lit("bytes").alias("law"), "shard",
        "slot", F.lit(None).cast("int").alias("grown_shard"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id(_table(spark, sf_dir, "documents"))


def op4_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return write_training_order(_table(spark, sf_dir, "documents"),
                                scratch_path(spark, "training-order"), RANKS)


def op5_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op6_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup(_table(spark, sf_dir, "embeddings"))


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Written in between, as in the pipeline: one Python worker a task.
    return decode(settle(encode(_table(spark, sf_dir, "documents"), PIECES), "pieces"), PIECES)


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return toxicity(docs, learn_lexicon(docs, _table(spark, sf_dir, "labels")))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = whitened_components(whiten(_table(spark, sf_dir, "embeddings")), "vec_id")
    return rows.withColumn("deviation", F.col("deviation").cast("long"))


def op12_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources(_table(spark, sf_dir, "documents"), budgets=(0.25, 0.5, 1.0))
    by_budget = F.col("taken_by_budget")
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies",
                        by_budget[0].alias("taken_quarter"), by_budget[1].alias("taken_half"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return damage_and_repair(_table(spark, sf_dir, "conversations"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages of corpus_pipeline.py, one after the other."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_ngram_jaccard_join, op2_histogram_sort, op3_language_id, op4_training_order,
        op5_template_decontamination, op6_ordinal_quality, op7_embedding_dedup,
        op8_sentencepiece, op9_substring_dedup, op10_toxicity, op11_whitening,
        op12_mixing, op13_conversation_repair, pipeline)}

_REACH = """
reach AS (SELECT i AS a, i AS b FROM nodes UNION
          SELECT reach.a, links.j FROM reach JOIN links ON links.i = reach.b),
heads AS (SELECT a AS i, min(b) AS head FROM reach GROUP BY a)"""

_NGRAM_JOIN = f"""
WITH RECURSIVE words AS (
  SELECT doc_id AS i, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}\\p{{M}}]+') AS w
  FROM documents),
grams AS (
  SELECT i, list_sort(list_distinct(CASE
    WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3),
                                         lambda k: array_to_string(w[k:k + 4], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END)) AS g FROM words),
nodes AS (SELECT i, g, len(g) AS n FROM grams),
each AS (SELECT i, n, hash(unnest(g)) AS x FROM nodes),
shared AS (SELECT p.i, q.i AS j, p.n AS n, q.n AS m, count(*) AS c
           FROM each p JOIN each q ON p.x = q.x AND p.i <> q.i GROUP BY ALL),
links AS (SELECT i, j FROM shared WHERE c / (n + m - c) >= 0.8),
{_REACH},
counts AS (SELECT i, count(*) AS k FROM links GROUP BY i)
SELECT nodes.i AS doc_id,
       CASE WHEN n = 0 THEN nodes.i ELSE min(nodes.i) OVER (PARTITION BY g) END AS class_id,
       coalesce(k, 0) AS n_links, head AS group_id, head = nodes.i AS kept
FROM nodes JOIN heads ON heads.i = nodes.i LEFT JOIN counts ON counts.i = nodes.i"""

_VECTOR_LINKS = f"""
WITH RECURSIVE nodes AS (
  SELECT vec_id AS i, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
links AS (SELECT p.i, q.i AS j FROM nodes p JOIN nodes q
          ON p.label = q.label AND p.i <> q.i
          WHERE list_cosine_similarity(p.v, q.v) >= 0.93),
{_REACH},
counts AS (SELECT i, count(*) AS k FROM links GROUP BY i)
SELECT nodes.i AS vec_id, coalesce(k, 0) AS n_links, head AS component_id,
       head = nodes.i AS kept
FROM nodes JOIN heads ON heads.i = nodes.i LEFT JOIN counts ON counts.i = nodes.i"""

_MIXING = """
WITH docs AS (
  SELECT doc_id, source AS s,
         coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS size,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS h
  FROM documents),
sources AS (
  SELECT s, sum(size) AS words, CASE (row_number() OVER (ORDER BY s NULLS LAST) - 1) % 3
           WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END::DOUBLE AS w
  FROM docs GROUP BY s),
budgets AS (SELECT b, b * (SELECT sum(words) FROM sources)::DOUBLE AS goal
            FROM (VALUES (0.25::DOUBLE), (0.5::DOUBLE), (1.0::DOUBLE)) AS v(b)),
filling AS (
  SELECT b, goal, s, words, w, 3.0::DOUBLE * words AS cap,
         sum(3.0::DOUBLE * words) OVER (PARTITION BY b ORDER BY words / w, s NULLS LAST
                                        ROWS UNBOUNDED PRECEDING) - 3.0::DOUBLE * words AS below,
         sum(w) OVER (PARTITION BY b ORDER BY words / w, s NULLS LAST
                      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest
  FROM budgets, sources),
levels AS (SELECT b, arg_min((goal - below) / rest, below) AS level FROM filling
           WHERE (goal - below) / rest <= cap / w GROUP BY b),
targets AS (
  SELECT b, s, words, least(cap, w * coalesce(level, 'inf'::DOUBLE)) AS target
  FROM filling LEFT JOIN levels USING (b)),
passes AS (SELECT *, CASE WHEN words > 0 THEN floor(target / words) ELSE 0 END::INT AS k
           FROM targets),
lines AS (SELECT doc_id, s, size, sum(size) OVER (
            PARTITION BY s ORDER BY h ROWS UNBOUNDED PRECEDING) - size AS before FROM docs),
chosen AS (
  SELECT doc_id, b, size, words, target,
         k + CASE WHEN before + size / 2.0 < target - k * words THEN 1 ELSE 0 END AS copies
  FROM lines JOIN passes ON lines.s IS NOT DISTINCT FROM passes.s)
SELECT doc_id, size, words::BIGINT AS source_size, target, copies * size AS taken, copies,
       max(CASE WHEN b = 0.25 THEN copies * size END) OVER mine AS taken_quarter,
       max(CASE WHEN b = 0.5 THEN copies * size END) OVER mine AS taken_half
FROM chosen WINDOW mine AS (PARTITION BY doc_id) QUALIFY b = 1.0"""

_REPAIR = r"""
WITH RECURSIVE hashed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(
           coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''),
           lambda ch: ord(ch)::BIGINT)),
           lambda c, b: list_reduce(list_prepend(xor(c, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
             lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384::BIGINT)
                               ELSE x // 2 END)), 4294967295::BIGINT) % 20 AS hit
  FROM conversations),
damaged AS (
  SELECT conv_id, turn, CASE WHEN hit = 4 THEN 'user' ELSE role END AS role,
         CASE hit WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g')
                  ELSE text END AS text,
         unnest(range(CASE hit WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM hashed),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
                               md5(len(role) || ':' || role || ':' || text)) AS n,
         regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS final
  FROM damaged),
lines AS (
  SELECT *, substr(role, 1, 1) AS i,
         CASE WHEN final = '' THEN 'blank'
              WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1
              THEN 'duplicate'
              WHEN final NOT IN ('.', '!', '?') THEN 'truncated' ELSE 'sound' END AS fault
  FROM placed),
-- Inserts before a row: the state they lead to, and what they write.
inserts(s, j, to_s, cost, a, o) AS (VALUES
  (0, 0, 0, 0, '', ''), (1, 0, 1, 0, '', ''), (2, 0, 2, 0, '', ''), (3, 0, 3, 0, '', ''),
  (0, 1, 2, 5, 'I', chr(10) || 'user:'), (1, 1, 2, 5, 'I', chr(10) || 'user:'),
  (2, 1, 3, 5, 'I', chr(10) || 'assistant:'), (3, 1, 2, 5, 'I', chr(10) || 'user:'),
  (0, 2, 3, 10, 'II', chr(10) || 'user:' || chr(10) || 'assistant:'),
  (1, 2, 3, 10, 'II', chr(10) || 'user:' || chr(10) || 'assistant:'),
  (2, 2, 2, 10, 'II', chr(10) || 'assistant:' || chr(10) || 'user:'),
  (3, 2, 3, 10, 'II', chr(10) || 'user:' || chr(10) || 'assistant:')),
-- Edits of a row: K needs the initial.
edits(s, a, i, to_s, cost, role) AS (VALUES
  (0, 'D', '', 0, 2, ''), (1, 'D', '', 1, 2, ''), (2, 'D', '', 2, 2, ''), (3, 'D', '', 3, 2, ''),
  (0, 'R', '', 2, 1, 'user'), (1, 'R', '', 2, 1, 'user'), (2, 'R', '', 3, 1, 'assistant'),
  (3, 'R', '', 2, 1, 'user'), (0, 'K', 's', 1, 0, ''), (0, 'K', 'u', 2, 0, ''),
  (1, 'K', 'u', 2, 0, ''), (3, 'K', 'u', 2, 0, ''), (2, 'K', 'a', 3, 0, '')),
ways AS (
  SELECT conv_id, 0::BIGINT AS n, 0 AS s, {'c': 0::BIGINT, 'a': '', 'o': ''} AS best
  FROM (SELECT DISTINCT conv_id FROM lines) AS ids
  UNION ALL
  SELECT w.conv_id, w.n + 1, e.to_s, min({
    'c': w.best.c + p.cost + e.cost + CASE WHEN e.a <> 'D' AND l.fault = 'truncated'
                                           THEN 5 ELSE 0 END,
    'a': w.best.a || p.a || e.a,
    'o': w.best.o || p.o || CASE e.a WHEN 'D' THEN ''
      WHEN 'K' THEN chr(10) || l.role || ':' || l.text
      ELSE chr(10) || e.role || ':' || l.text END})
  FROM ways AS w JOIN lines AS l ON l.conv_id IS NOT DISTINCT FROM w.conv_id AND l.n = w.n + 1
  JOIN inserts AS p ON p.s = w.s JOIN edits AS e ON e.s = p.to_s
  WHERE (e.a <> 'K' OR e.i = l.i) AND (e.a = 'D' OR l.fault NOT IN ('blank', 'duplicate'))
  GROUP BY w.conv_id, w.n, e.to_s),
ends AS (
  SELECT w.conv_id, min({'c': w.best.c + p.cost, 'a': w.best.a || p.a, 'o': w.best.o || p.o})
           AS best
  FROM ways AS w JOIN inserts AS p ON p.s = w.s AND p.to_s IN (0, 3)
  WHERE w.n = (SELECT count(*) FROM lines AS l WHERE l.conv_id IS NOT DISTINCT FROM w.conv_id)
  GROUP BY w.conv_id),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'blank') AS blank,
         count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM (SELECT *, lag(i) OVER (PARTITION BY conv_id ORDER BY n) || i AS pair FROM lines) AS l
  GROUP BY conv_id)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank,
       coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce(e.best.c, 0) AS cost,
       coalesce(e.best.a, '') AS audit, sha256(substr(coalesce(e.best.o, ''), 2)) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) AS c
LEFT JOIN counts AS k ON k.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN ends AS e ON e.conv_id IS NOT DISTINCT FROM c.conv_id"""

ORACLE: dict[str, str] = {"op1_ngram_jaccard_join": _NGRAM_JOIN,
                          "op7_embedding_dedup": _VECTOR_LINKS,
                          "op12_mixing": _MIXING,
                          "op13_conversation_repair": _REPAIR}
