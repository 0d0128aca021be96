"""Ordinal quality regression on hashed text.

A cumulative-link model: one weight vector over hashed features of the text and
K - 1 ordered thresholds, P(grade <= k) = sigmoid(threshold_k - w.x). Features
are shares of words, word pairs, character n-grams and word shapes, so that
length does not matter. Fitted by full-batch accelerated gradient on a bounded
sample of graded documents; every document is scored on its whole text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textual
from .labelled import held_out, labelled_sample

#: Buckets of the hashed features.
BUCKETS = 1 << 15
#: Graded documents the model is fitted on, at most about; gradient rounds.
SAMPLE, ROUNDS, RIDGE = 10_000, 200, 1e-5
#: Shares are small numbers; times this they suit the gradient's step.
SCALE = 20.0
_U = np.uint64


def _word_features(words: textual.Words) -> tuple[np.ndarray, np.ndarray]:
    """Texts and hashes of single words and of facts about neighbours."""
    h, t = words.hashes, words.text
    if not len(h):
        return t, h
    pair = (t[1:] == t[:-1])
    again = np.concatenate(([False], pair & (h[1:] == h[:-1])))
    gap = np.concatenate(([0], np.minimum(words.starts[1:] - words.ends[:-1], 9) * pair))
    fact = textual.mix((gap * 2 + again).astype(_U) + _U(77))
    return np.concatenate((t, t)), np.concatenate((h, fact))


def _character_features(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Texts and hashes of every three characters: letters by case, others as
    they are."""
    table = textual.char_classes()
    for i, text in enumerate(texts):
        for first, last in textual.slices(text) if text else ():
            codes = textual.code_points(text[first:last])
            kind = np.where(table[codes] & textual.LETTER,
                            1 + (table[codes] & textual.UPPER != 0), codes + 8).astype(_U)
            three = textual.mix((kind[:-2] * _U(0x10001) + kind[1:-1]) * _U(0x10001) + kind[2:])
            yield np.full(len(three), i), three


def occurrences(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(text, bucket)`` of every occurrence of a feature."""
    row, hashes = _word_features(textual.words_of(texts))
    yield row, (hashes % _U(BUCKETS)).astype(np.int64)
    for row, hashes in _character_features(texts):
        yield row, (hashes % _U(BUCKETS)).astype(np.int64)


def features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(text, bucket, value)``, each bucket once a text: shares of the text's
    occurrences, times ``SCALE``."""
    cells = [row * BUCKETS + bucket for row, bucket in occurrences(texts)]
    cells, counts = np.unique(np.concatenate(cells), return_counts=True)
    row = cells // BUCKETS
    total = np.bincount(row, counts, len(texts))
    return row, cells % BUCKETS, SCALE * counts / total[row]


def linear_scores(texts: list[str | None], w: np.ndarray) -> np.ndarray:
    """The products of weights and features, without gathering the features."""
    sums, total = np.zeros(len(texts)), np.zeros(len(texts))
    for row, bucket in occurrences(texts):
        sums += np.bincount(row, w[bucket], len(texts))
        total += np.bincount(row, minlength=len(texts))
    return SCALE * sums / np.maximum(total, 1)


def _sigmoid(x):
    return 0.5 * (1 + np.tanh(x / 2))


def fit_ordinal(row: np.ndarray, bucket: np.ndarray, value: np.ndarray,
                grade: np.ndarray, grades: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ordered thresholds for grades 0 to ``grades - 1``."""
    n = len(grade)
    cuts = grades - 1
    share = np.array([(grade <= k).mean() for k in range(cuts)]).clip(1e-3, 1 - 1e-3)
    theta = np.log(share / (1 - share))
    w = np.zeros(BUCKETS)
    step_w, step_t = np.zeros(BUCKETS), np.zeros(cuts)
    low = (grade[:, None] <= np.arange(cuts)).astype(float)
    for _ in range(ROUNDS):
        look_w, look_t = w + 0.9 * step_w, theta + 0.9 * step_t
        score = np.bincount(row, look_w[bucket] * value, n)
        p = _sigmoid(look_t[None, :] - score[:, None])
        # Cumulative logits with shared weights: every threshold is a logistic
        # regression on "grade is at most k".
        error = p - low
        grad_w = -np.bincount(bucket, error.sum(axis=1)[row] * value, BUCKETS) / n
        step_w = 0.9 * step_w - 2.0 * (grad_w + RIDGE * look_w)
        step_t = 0.9 * step_t - 1.0 * error.mean(axis=0)
        w, theta = w + step_w, np.maximum.accumulate(theta + step_t)
    return w, theta


def _fit(pdf: pd.DataFrame, grades: list[int]) -> tuple[np.ndarray, np.ndarray]:
    parts, at = [], 0
    texts = pdf["text"].tolist()
    for first, last in textual.batches(texts):
        row, bucket, value = features(texts[first:last])
        parts.append((row + first, bucket.astype(np.int32), value.astype(np.float32)))
        at = last
    row, bucket, value = (np.concatenate(c) for c in zip(*parts, strict=True))
    order = {g: k for k, g in enumerate(grades)}
    return fit_ordinal(row, bucket, value,
                       pdf["grade"].map(order).to_numpy()[:at], len(grades))


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
                   text_col: str = "text", grade_col: str = "quality") -> DataFrame:
    """``doc_id, held_out, expected_grade, tail_probability, score, predicted``
    for every row.

    Grades are the distinct whole numbers of ``grade_col``; ``expected_grade``
    is the mean grade under the model, ``tail_probability`` the chance of the
    best grade and ``score`` the same, ``predicted`` the likeliest grade (the
    lowest of equal ones). A null or empty text has no features and gets the
    thresholds' base rates. Documents graded more than once with different
    grades, or held out, are not learned from. With fewer than two grades all
    scores are null. Repeated rows are scored alike; other columns are ignored; an
    empty table gives no rows.
    """
    sample = labelled_sample(docs, labels, id_col, text_col, grade_col, SAMPLE)
    # A row for each grade.
    grades = sorted(r["g"] for r in labels.where(F.col(grade_col).isNotNull()).select(
        F.col(grade_col).cast("int").alias("g")).distinct().collect())
    model = None
    if len(grades) > 1:
        def fit(batches):
            frames = [b.to_pandas() for b in batches]
            if frames:
                w, theta = _fit(pd.concat(frames, ignore_index=True), grades)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([w.tobytes()]), pa.array([theta.tobytes()])], ["w", "theta"])

        # A bounded sample, so one task holds it.
        got = sample.select("text", F.col("label").alias("grade")).repartition(1).mapInArrow(
            fit, "w binary, theta binary").collect()
        if got:
            model = (np.frombuffer(got[0]["w"]), np.frombuffer(got[0]["theta"]))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    values = np.array(grades, float)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in textual.small(batches):
            texts = batch.column("text").to_pylist()
            p = np.full((len(texts), max(len(values), 1)), np.nan)
            if shared.value is not None:
                w, theta = shared.value
                for first, last in textual.batches(texts):
                    score = linear_scores(texts[first:last], w)
                    below = _sigmoid(theta[None, :] - score[:, None])
                    edge = np.zeros((len(score), 1))
                    p[first:last] = np.diff(np.hstack((edge, below, edge + 1)), axis=1)
            known = ~np.isnan(p[:, 0])
            mean = p @ values if len(values) else p[:, 0]
            best = [int(grades[k]) if ok else None
                    for k, ok in zip(np.nan_to_num(p).argmax(axis=1), known, strict=True)]
            number = lambda x: pa.array(x, pa.float64(), mask=~known)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), number(mean),
                 number(p[:, -1].copy()), number(p[:, -1].copy()), pa.array(best, pa.int32())],
                ["doc_id", "held_out", "expected_grade", "tail_probability", "score",
                 "predicted"])

    return docs.select(F.col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"),
                       F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, f"doc_id {docs.schema[id_col].dataType.simpleString()}, held_out boolean, "
             "expected_grade double, tail_probability double, score double, predicted int")
