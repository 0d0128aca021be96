"""Toxicity: a weighted lexicon, matched by Aho-Corasick on folded text.

Folding undoes disguises: look-alike letters of other alphabets and digits or
signs that stand for letters. The lexicon's entries are word beginnings and
whole words with log-odds weights learned from labelled documents, plus given
ones. Exception phrases (learned words and given phrases) are matched too and
weigh nothing; at each place the longest match counts. The sum of weights,
normalised by length, goes through a small logistic calibration.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Mapping, Sequence
from typing import NamedTuple

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import settle
from .labelled import held_out, labelled_sample
from .textual import small

#: Labelled documents the lexicon and the calibration are fitted on, about.
SAMPLE = 20_000
#: Lengths of word beginnings that may become entries.
SHORTEST, LONGEST = 3, 8
#: Entries kept, strongest first; the weight and the z-value they need.
ENTRIES, LEAST_WEIGHT, LEAST_Z = 5_000, 1.5, 4.0
#: Counted features that a task holds before it passes them on.
HELD = 150_000

# Letters of other alphabets that look like a Latin letter.
LOOK_ALIKES = {
    "а": "a", "в": "b", "е": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p",
    "с": "c", "т": "t", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d",
    "ɡ": "g", "ӏ": "l", "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k",
    "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ı": "i", "ⅼ": "l",
}
# Digits and signs that stand for a letter.
STAND_INS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b",
             "@": "a", "$": "s"}
_BREAKS = {c: " " for c in "\t\n\r\v\f!\"#%&'()*+,-./:;<=>?[\\]^_`{|}~«»“”‘’„…–—·¡¿ "}
_FOLD = str.maketrans(LOOK_ALIKES | STAND_INS | _BREAKS
                      | {"​": "", "‌": "", "‍": "", "­": ""}
                      | {chr(0xFF41 + i): chr(97 + i) for i in range(26)})
#: A token without a letter keeps its digits: it is a number, not a disguise.
_NO_LETTER = re.compile(r"(?<!\S)[0-9@$]+(?!\S)")
_BREAK_TABLE = str.maketrans(_BREAKS)


def folded(text: str) -> str:
    """Lower case without disguises; words are set apart by one blank, and a
    blank stands at both ends."""
    low = text.lower().translate(_BREAK_TABLE)
    if any(d in low for d in "0134578@$"):
        low = _NO_LETTER.sub(" ", low)
    return f" {' '.join(low.translate(_FOLD).split())} "


class Lexicon(NamedTuple):
    """Entries as folded text with a leading blank (a trailing one for whole
    words) and their weights; 0 marks an exception. ``calibration`` has a bias
    and a weight for each of the measures of :func:`measures`."""

    weights: dict[str, float]
    calibration: tuple[float, ...]


def _automaton(weights: Mapping[str, float]):
    out = ahocorasick.Automaton()
    for entry, weight in weights.items():
        out.add_word(entry, (len(entry), weight))
    if len(weights):
        out.make_automaton()
    return out


def measures(text: str | None, automaton) -> tuple[float, float, float]:
    """Log of the summed weight, summed weight by length, largest weight."""
    if not text or not len(automaton):
        return 0.0, 0.0, 0.0
    plain = folded(text)
    longest: dict[int, tuple[int, float]] = {}
    for end, (size, weight) in automaton.iter(plain):
        start = end - size + 1
        if size > longest.get(start, (0, 0.0))[0]:
            longest[start] = (size, weight)
    if not longest:
        return 0.0, 0.0, 0.0
    total = most = 0.0
    covered = -1
    for start in sorted(longest):
        size, weight = longest[start]
        # A match ends before the blank that the next word begins with.
        if start >= covered:
            total += weight
            most = max(most, weight)
            covered = start + size - (size > 1 and plain[start + size - 1] == " ")
    words = plain.count(" ") - 1
    return math.log1p(total), total / math.sqrt(words + 25.0), most


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many toxic and other documents have each word and word beginning."""
    toxic: Counter = Counter()
    other: Counter = Counter()

    def drained():
        names = list(toxic.keys() | other.keys())
        batch = pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), pa.array([toxic[n] for n in names], pa.int64()),
             pa.array([other[n] for n in names], pa.int64())], ["entry", "toxic", "other"])
        toxic.clear()
        other.clear()
        return batch

    for batch in small(batches):
        for text, label in zip(batch.column("text").to_pylist(),
                               batch.column("label").to_pylist(), strict=True):
            words = set(folded(text).split())
            into = toxic if label else other
            into.update({f" {w} " for w in words if len(w) <= 40})
            into.update({f" {w[:k]}" for w in words
                         for k in range(SHORTEST, min(LONGEST, len(w)) + 1)})
            if len(toxic) + len(other) >= HELD:
                yield drained()
    if toxic or other:
        yield drained()


def _calibrated(rows: np.ndarray, label: np.ndarray) -> tuple[float, ...]:
    """Logistic regression by Newton steps with a small ridge. A step that doesn't
    lessen the loss is halved: where the labels are all but separable, whole steps
    overshoot and may end with the weights' signs turned."""
    x = np.hstack((np.ones((len(rows), 1)), rows))
    w = np.zeros(x.shape[1])
    ridge = np.diag([1e-6] + [0.05] * rows.shape[1])

    def loss(w):
        z = x @ w
        return (np.logaddexp(0, z) - label * z).sum() + w @ ridge @ w / 2

    here = loss(w)
    for _ in range(200):
        p = 0.5 * (1 + np.tanh(x @ w / 2))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge,
                               x.T @ (p - label) + ridge @ w)
        while (there := loss(w - step)) > here and np.abs(step).max() >= 1e-8:
            step = step / 2
        if there > here or np.abs(step).max() < 1e-8:
            break
        w, here = w - step, there
    return tuple(float(v) for v in w)


def learn_lexicon(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
                  text_col: str = "text", label_col: str = "toxic",
                  entries: Mapping[str, float] | None = None,
                  exceptions: Sequence[str] = ()) -> Lexicon:
    """A lexicon from labelled documents that are not held out.

    ``entries`` are given words or phrases with weights, ``exceptions`` phrases
    that are harmless where they occur. Documents with contradictory labels and
    null texts are left out. Without documents of both labels the lexicon has
    the given entries and a default calibration.
    """
    sample = settle(labelled_sample(docs, labels, id_col, text_col, label_col, SAMPLE),
                    "toxic-sample")
    groups = {r["label"] > 0: r["n"] for r in sample.groupBy(
        (F.col("label") > 0).cast("int").alias("label")).agg(F.count("*").alias("n")).collect()}
    weights: dict[str, float] = {}
    bad, good = groups.get(True, 0), groups.get(False, 0)
    if bad and good:
        counts = sample.select("text", "label").mapInArrow(
            _counted, "entry string, toxic bigint, other bigint").groupBy("entry").agg(
                F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
        p, q = (F.col("toxic") + 0.5) / (bad + 1), (F.col("other") + 0.5) / (good + 1)
        share = (F.col("toxic") + F.col("other")) / (bad + good)
        z = (F.col("toxic") / bad - F.col("other") / good) / F.sqrt(
            share * (1 - share) * (1 / bad + 1 / good) + 1e-12)
        rated = settle(counts.where("toxic + other >= 3").select(
            "entry", "toxic", "other", F.log(p / q).alias("weight"), z.alias("z")), "lexicon")
        rows = rated.where((F.col("weight") >= LEAST_WEIGHT) & (F.col("z") >= LEAST_Z)).orderBy(
            F.desc("z"), "entry").limit(ENTRIES).collect()
        weights = {r["entry"]: r["weight"] for r in rows}
        if weights:
            # Whole words that begin like an entry but are at home in other
            # documents are exceptions.
            begins = rated.where(F.col("entry").endswith(" ") & (F.col("weight") < 0.5)
                                 & (F.col("other") >= 3))
            # From Arrow: a list would go through Python workers of its own.
            starts = docs.sparkSession.createDataFrame(pa.table({"start": pa.array(
                [w for w in weights if not w.endswith(" ")] or [""], pa.string())}))
            spared = None
            for k in range(SHORTEST, LONGEST + 1):
                part = begins.withColumn("start", F.substring("entry", 1, k + 1)).join(
                    starts, "start", "left_semi").select("entry", "z")
                spared = part if spared is None else spared.union(part)
            weights |= {r["entry"]: 0.0 for r in spared.groupBy("entry").agg(
                F.min("z").alias("z")).orderBy("z", "entry").limit(ENTRIES).collect()}
    weights |= {folded(e): float(w) for e, w in (entries or {}).items()}
    weights |= {folded(e): 0.0 for e in exceptions}
    calibration = (-4.0, 1.0, 0.5, 0.5)
    if bad and good:
        automaton = _automaton(weights)

        def measured(batches):
            for batch in small(batches):
                got = np.array([measures(t, automaton) for t in
                                batch.column("text").to_pylist()]).reshape(-1, 3)
                yield pa.RecordBatch.from_arrays(
                    [*[pa.array(got[:, k]) for k in range(3)], batch.column("label")],
                    ["a", "b", "c", "label"])

        # Four numbers for each row of the bounded sample.
        pdf: pd.DataFrame = sample.select("text", "label").mapInArrow(
            measured, "a double, b double, c double, label int").toPandas()
        calibration = _calibrated(pdf[["a", "b", "c"]].to_numpy(),
                                  (pdf["label"] > 0).to_numpy(float))
    return Lexicon(weights, calibration)


_BUILT: dict[int, object] = {}


def _scorer(lexicon: Lexicon):
    """Scores of a list of texts; the automaton is built once a worker."""
    key = hash((tuple(sorted(lexicon.weights.items())), lexicon.calibration))
    if key not in _BUILT:
        _BUILT.clear()
        _BUILT[key] = _automaton(lexicon.weights)
    automaton, w = _BUILT[key], np.array(lexicon.calibration)

    def score(texts):
        rows = np.array([measures(t, automaton) for t in texts]).reshape(-1, 3)
        return 0.5 * (1 + np.tanh((w[0] + rows @ w[1:]) / 2))
    return score


def toxicity(docs: DataFrame, lexicon: Lexicon, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row, by its whole text.

    A null or empty text, or one without a match, has the score of no match.
    Repeated rows are scored alike; other columns are ignored; an empty table gives
    no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = _scorer(shared.value)
        for batch in small(batches):
            got = score(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(got),
                 pa.array((got >= 0.5).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"])

    return docs.select(F.col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"),
                       F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, f"doc_id {docs.schema[id_col].dataType.simpleString()}, held_out boolean, "
             "score double, predicted int")


def drop_toxic(docs: DataFrame, lexicon: Lexicon, text_col: str = "text",
               limit: float = 0.5) -> DataFrame:
    """The rows, with all their columns, that score below ``limit``: see
    :func:`toxicity`. Null and empty texts stay, and an empty table gives no rows."""
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)

    def mild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = _scorer(shared.value)
        for batch in small(batches):
            texts = batch.column(text_col).cast(pa.string()).to_pylist()
            yield batch.filter(pa.array(score(texts) < limit))

    return docs.mapInArrow(mild, docs.schema)
