"""Language identification by cross-parsing entropy.

Each language has the suffix automaton of a bounded amount of labelled text.
A text is parsed greedily into the longest phrases that occur in a language's
text; the language that needs the fewest phrases, weighed by what naming one
costs there (log of the training length), wins. Symbols are the halves of UTF-8
bytes: no letter of any script is left out, and the automata are small dense
tables. All segments of a batch of texts take a step at a time.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textual
from .labelled import held_out

#: Training characters of a language, and of all languages together.
TRAINING, TRAINING_ALL = 40_000, 1_600_000
#: Characters that a row gives to its language's training text, from any place.
WINDOW = 400
#: Symbols: half a byte each.
_WIDTH = 16
#: A text is parsed in segments of so many symbols, so that segments can be parsed
#: side by side; every symbol of the text is in one. A segment's parse begins WARM
#: symbols before it, where it has nearly always met the parse of the whole text;
#: phrases are counted where they begin.
SEGMENT, WARM = 512, 128
UNDETERMINED = "und"


def folded(text: str) -> str:
    """Lower case; runs of anything but letters and marks become one blank."""
    table = textual.char_classes()
    low = textual.lowered(text)
    codes = textual.code_points(low)
    keep = table[codes] & (textual.LETTER | textual.MARK) != 0
    first = np.ones(len(keep), bool)
    first[1:] = keep[:-1]
    out = np.where(keep, codes, 32)[keep | first]
    return out.astype(np.uint32).tobytes().decode("utf-32-le", "surrogatepass")


def suffix_automaton(symbols: np.ndarray) -> list[dict[int, int]]:
    """Transitions of the suffix automaton of a symbol sequence."""
    nexts: list[dict[int, int]] = [{}]
    length, link, last = [0], [-1], 0
    for c in symbols.tolist():
        new = len(nexts)
        nexts.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in nexts[p]:
            nexts[p][c] = new
            p = link[p]
        if p >= 0:
            q = nexts[p][c]
            if length[p] + 1 == length[q]:
                link[new] = q
            else:
                clone = len(nexts)
                nexts.append(dict(nexts[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and nexts[p].get(c) == q:
                    nexts[p][c] = clone
                    p = link[p]
                link[q] = link[new] = clone
        last = new
    return nexts


def symbols(text: str) -> np.ndarray:
    """High and low halves of a text's UTF-8 bytes."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    out = np.empty(2 * len(raw), np.uint8)
    out[::2], out[1::2] = raw >> 4, raw & 15
    return out


class Parser:
    """Phrase counts of texts against every language's training text."""

    def __init__(self, training: dict[str, str]):
        self.languages = sorted(training)
        self.tables, self.weight = [], []
        for name in self.languages:
            text = symbols(training[name])
            self.tables.append(self._dense(suffix_automaton(text)))
            self.weight.append(math.log2(len(text) + 2))

    def _dense(self, nexts: list[dict[int, int]]) -> np.ndarray:
        """Next state doubled, plus 1 where a phrase begins with the symbol: in
        the root, and where no phrase goes on with it. A symbol that the text
        lacks is a phrase by itself."""
        root = np.ones(_WIDTH, np.int32)
        for c, to in nexts[0].items():
            root[c] = to << 1 | 1
        out = np.tile(root, (len(nexts), 1))
        for state, near in enumerate(nexts):
            if near and state:
                out[state, list(near)] = np.array(list(near.values()), np.int32) << 1
        return out.reshape(-1)

    def phrases(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Phrases of each folded text by language, and its symbols."""
        each = [symbols(t) for t in texts]
        sizes = np.array([len(e) for e in each], np.int64)
        stream = np.concatenate(each)
        pieces = -(-sizes // SEGMENT)
        owner = np.repeat(np.arange(len(texts)), pieces)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        early = np.minimum(WARM, nth * SEGMENT)
        begin = np.repeat(np.cumsum(sizes) - sizes, pieces) + nth * SEGMENT - early
        length = np.minimum(SEGMENT, sizes[owner] - nth * SEGMENT) + early
        order = np.argsort(-length, kind="stable")
        owner, begin, length, early = (x[order] for x in (owner, begin, length, early))
        active = np.searchsorted(-length, -np.arange(SEGMENT + WARM), "left")
        counts = np.zeros((len(texts), len(self.tables)))
        for k, table in enumerate(self.tables):
            state = np.zeros(len(owner), np.int32)
            begun = np.zeros(len(owner), np.int32)
            for step in range(SEGMENT + WARM):
                n = active[step]
                if not n:
                    break
                to = table[state[:n] * _WIDTH + stream[begin[:n] + step]]
                begun[:n] += (to & 1) if step >= WARM else (to & 1) * (early[:n] <= step)
                state[:n] = to >> 1
            counts[:, k] = np.bincount(owner, begun, len(texts))
        return counts, sizes

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        out: list[tuple[str, float]] = [(UNDETERMINED, 0.0)] * len(texts)
        if not self.languages:
            return out
        for first, last in textual.batches(texts):
            plain = [folded(t) if t else "" for t in texts[first:last]]
            some = [i for i, t in enumerate(plain) if t.strip()]
            if not some:
                continue
            counts, sizes = self.phrases([plain[i] for i in some])
            bits = counts * np.array(self.weight) / sizes[:, None]
            best = bits.argmin(axis=1)
            # How likely the best is if a text's odds follow its bits a phrase.
            odds = np.exp2(-(bits - bits.min(axis=1, keepdims=True)) * np.minimum(
                sizes, SEGMENT)[:, None] / 8)
            sure = 1 / odds.sum(axis=1)
            for j, i in enumerate(some):
                out[first + i] = (self.languages[best[j]], float(sure[j]))
        return out


def training_text(docs: DataFrame, text_col: str, lang_col: str,
                  id_col: str) -> dict[str, str]:
    """The bounded training text of every language, of documents that are not
    held out and whose text and language are not null. Rows are chosen by a hash of
    their id, as many as hold twice the bound; each gives its text, or a window of
    it from a place that the hash decides."""
    known = docs.where(~held_out(id_col) & F.col(lang_col).isNotNull()
                       & F.col(text_col).isNotNull()).select(
        F.col(lang_col).cast("string").alias("lang"), F.xxhash64(id_col).alias("h"),
        F.col(text_col).cast("string").alias("text"))
    held = known.groupBy("lang").agg(F.sum(F.least(F.length("text"), F.lit(WINDOW))).alias("n"))
    names = held.count()
    most = min(TRAINING, TRAINING_ALL // max(names, 1))
    # A row for each language; a model of each is broadcast as well.
    spread = F.pmod("h", F.lit(1 << 40))
    start = F.pmod(F.xxhash64("h"), F.greatest(F.length("text") - WINDOW, F.lit(0)) + 1) + 1
    rows = known.join(F.broadcast(held), "lang").where(
        spread < F.least(F.lit(1.0), 2.0 * most / F.col("n")) * (1 << 40)).select(
        "lang", "h", F.substring("text", start, F.lit(WINDOW)).alias("text"))
    out: dict[str, str] = {}
    for r in sorted(rows.collect(), key=lambda r: (r["lang"], r["h"], r["text"])):
        text = out.get(r["lang"], "")
        if len(text) < most:
            out[r["lang"]] = (text + folded(r["text"]) + " ")[:most]
    return {k: v for k, v in out.items() if v.strip()}


_PARSERS: dict[tuple, Parser] = {}


def language_id(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                lang_col: str = "lang") -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every row.

    The whole text decides; a null text and one without a letter is ``und``
    with score 0, and so is every text if no labelled text can be learned from.
    Ties go to the language first in order. Repeated rows are predicted alike;
    other columns are ignored; an empty table gives no rows.
    """
    training = training_text(docs, text_col, lang_col, id_col)
    shared = docs.sparkSession.sparkContext.broadcast(training)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = tuple(sorted((k, hash(v)) for k, v in shared.value.items()))
        if key not in _PARSERS:
            _PARSERS.clear()
            _PARSERS[key] = Parser(shared.value)
        for batch in textual.small(batches):
            found = _PARSERS[key].predict(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"),
                 pa.array([n for n, _ in found], pa.string()),
                 pa.array([s for _, s in found], pa.float64())],
                ["doc_id", "held_out", "lang_pred", "score"])

    return docs.select(F.col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"),
                       F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, f"doc_id {docs.schema[id_col].dataType.simpleString()}, held_out boolean, "
             "lang_pred string, score double")
