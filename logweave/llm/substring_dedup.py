"""Substring deduplication by content-defined chunking.

A gear hash rolls over the words of each text. A chunk begins where the hash of
the four words from there is the least among those of ``passage_words -
LEADING + 1`` successive places, so that an insertion shifts chunk borders only
near itself, and any two copies of a passage of ``passage_words`` words have a
border in common. A chunk goes by the digest of its leading words. Chunks whose
digest another text has too are candidates only: the digests of the passages
around them are compared. Such a passage's first occurrence in the order
(document id, place) stays, later ones are removed, so that what goes stood
together in one earlier document, and shorter repeats stay. Equal texts are
found first, by a digest of the whole; only one of them is cut into chunks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..storage import scratch_tables
from . import textual
from .columns import packed, unpacked

#: Words of a passage whose repetition is removed, and those a chunk goes by.
PASSAGE_WORDS, LEADING = 50, 16
#: Words under the gear hash, each shifting it by _SHIFT bits.
_ROLLING, _SHIFT = 4, 16
_IDEOGRAPH = 0x2E80
#: Places that are compared at once; a place takes as many bits of the keys.
_BLOCK_BITS = 22
_U = np.uint64


def words_of(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Where each word begins, with the blanks behind the one before it, and its
    hash. Chunks begin with words."""
    table = textual.char_classes()
    out = []
    at, n = 0, len(text)
    while at < n:
        codes = textual.code_points(text[at:at + textual.SLICE])
        blank = table[codes] & textual.SPACE != 0
        begins = ~blank
        begins[1:] &= blank[:-1] | (codes[1:] >= _IDEOGRAPH)
        starts = np.flatnonzero(begins)
        size = len(codes)
        if at + size < n and len(starts) and starts[-1]:
            size, starts = int(starts[-1]), starts[:-1]
        last_word = np.maximum.accumulate(np.where(blank, 0, np.arange(len(codes))))
        ends = np.append(starts[1:], size)[:len(starts)]
        out.append((starts + at, textual.range_hashes(codes, starts, last_word[ends - 1] + 1)))
        at += size
    if not out:
        none = np.zeros(0, np.int64)
        return none, none.astype(_U)
    starts, hashes = (np.concatenate(c) for c in zip(*out, strict=True))
    starts[:1] = 0
    return starts, hashes


def gear(hashes: np.ndarray) -> np.ndarray:
    """The gear hash at each word: h = (h << 16) + g(word), which four words after
    a word has shifted it out."""
    n = max(len(hashes) - _ROLLING + 1, 0)
    out = np.zeros(n, _U)
    for k in range(_ROLLING):
        out = (out << _U(_SHIFT)) + hashes[k:k + n]
    return textual.mix(out)


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The place of the least value of every ``width`` successive ones, of equal
    ones the last."""
    out = []
    n = len(values) - width + 1
    step = (1 << _BLOCK_BITS) - width
    for at in range(0, n, step):
        some = values[at:at + step + width - 1]
        place = np.arange(len(some), dtype=_U)
        low = _U((1 << _BLOCK_BITS) - 1)
        key = (some & ~low) | (low - place)
        spans, held = 1, key
        while 2 * spans <= width:         # doubling: the least of 2, 4, 8 ...
            held = np.minimum(held[:-spans], held[spans:])
            spans *= 2
        count = len(some) - width + 1
        held = np.minimum(held[:count], held[width - spans:width - spans + count])
        out.append((low - (held & low)).astype(np.int64) + at)
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def anchors(hashes: np.ndarray, passage_words: int) -> tuple[np.ndarray, np.ndarray]:
    """For each passage of a text, the border that lies in it: where its value is
    least. And the digest of the leading words from every place."""
    leading = min(LEADING, passage_words)
    digests = textual.windows(hashes, leading)
    if not len(digests):
        return np.zeros(0, np.int64), digests
    values = gear(hashes)[:len(digests)] if leading >= _ROLLING else textual.mix(digests)
    return _least(values, passage_words - leading + 1), digests


def chunks(text: str, passage_words: int = PASSAGE_WORDS
           ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends, digests and word counts of a text's chunks; they cover it."""
    starts, hashes = words_of(text)
    of, digests = anchors(hashes, passage_words)
    borders = np.unique(np.concatenate(([0], of))).astype(np.int64)
    if not len(starts):
        borders = borders[:0]
    edges = np.append(starts, len(text))
    after = np.append(borders[1:], len(starts))[:len(borders)]
    if not len(digests):
        digests = textual.windows(hashes, max(len(hashes), 1))
    return edges[borders], edges[after], digests[borders], after - borders


def _passages(hashes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """A 128-bit digest of every ``size`` successive words, as two halves."""
    return textual.windows(hashes, size), textual.windows(
        textual.mix(hashes ^ _U(0x5851F42D4C957F2D)), size)


def _chunk_rows(passage_words: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in textual.small(batches):
            texts = batch.column("text").to_pylist()
            for first, last in textual.batches(texts, textual.SLICE):
                found, inner = [], []
                for text in texts[first:last]:
                    of, digests = anchors(words_of(text or "")[1], passage_words)
                    own = digests[np.unique(of)]
                    different = np.unique(own)
                    inner.append(len(different) < len(own))
                    found.append(different.view(np.int64))
                offsets = np.concatenate(([0], np.cumsum([len(d) for d in found])))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row").slice(first, last - first),
                     pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)),
                                              pa.array(np.concatenate(found))),
                     pa.array(inner)], ["row", "digests", "inner"])
    return rows


def near(text: str, candidates, passage_words: int
         ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First words and digests of the passages whose border begins a chunk with a
    candidate digest."""
    hashes = words_of(text)[1]
    of, digests = anchors(hashes, passage_words)
    wanted = np.asarray(candidates, np.int64).view(_U)
    place = np.flatnonzero(np.isin(digests[of], wanted))
    high, low = _passages(hashes, passage_words)
    return place, high[place], low[place]


def _passage_rows(passage_words: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in textual.small(batches):
            texts = batch.column("text").to_pylist()
            for first, last in textual.batches(texts, textual.SLICE):
                found = [near(text, numbers, passage_words) for text, numbers in zip(
                    texts[first:last], batch.column("candidates").slice(
                        first, last - first).to_pylist(), strict=True)]
                of = pa.array(np.repeat(np.arange(first, last), [len(f[0]) for f in found]))
                place, high, low = (np.concatenate([f[i] for f in found]) for i in range(3))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("number").take(of), batch.column("row").take(of),
                     pa.array(place.astype(np.int32)), pa.array(high.view(np.int64)),
                     pa.array(low.view(np.int64))], ["number", "row", "nth", "high", "low"])
    return rows


def _named(id_col: str, text_col: str) -> tuple[Column, Column, Column]:
    """A document's id as a number, a 128-bit name of its id and text, and one of
    its text alone. Documents are in the order of numbers, null last, then names."""
    number = F.col(f"`{id_col}`").cast("long")
    text = F.unhex(F.md5(F.col(f"`{text_col}`").cast("string").cast("binary")))
    shown = F.coalesce(number.cast("string"), F.lit("null")).cast("binary")
    return number, F.unhex(F.md5(F.concat(shown, F.coalesce(text, F.lit(b""))))), text


def _order() -> Column:
    return F.struct(F.col("number").isNull(), F.col("number"), F.col("row"))


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      passage_words: int = PASSAGE_WORDS) -> DataFrame:
    """``row, starts, ends, copy`` for documents (see :func:`_named`) with passages
    that occur before: the first words of the first and last passage of each run of
    those that an earlier document has; or ``copy``, where an earlier document has
    the same text. Passages that only repeat within a document aren't listed, but
    the document is."""
    number, row, whole = _named(id_col, text_col)
    texts = docs.select(number.alias("number"), row.alias("row"), whole.alias("whole"),
                        F.col(f"`{text_col}`").cast("string").alias("text")).where(
        "text IS NOT NULL")
    spark = docs.sparkSession
    with scratch_tables(spark) as settle:
        firsts = texts.groupBy("whole").agg(F.min(_order()).alias("first"),
                                            F.max(_order()).alias("last")).where(
            "first < last").select("whole", F.col("first.row").alias("kept"))
        # A large group's rows meet its first as pairs that differ from each other.
        names = texts.select("whole", "row").distinct()
        copies = settle(names.join(settle(firsts, "equal-texts"), "whole").where(
            "row <> kept").select("row"), "copies")
        cut = settle(texts.select("row", "text").mapInArrow(
            _chunk_rows(passage_words), "row binary, digests array<bigint>, inner boolean")
            .where("size(digests) > 0").join(copies, "row", "left_anti").dropDuplicates(["row"]),
            "chunks")
        # Digests of chunks that two texts have.
        digests = cut.select("row", F.explode("digests").alias("digest"))
        shared = settle(digests.groupBy("digest").count().where("count > 1").select("digest"),
                        "shared-chunks")
        candidates = settle(digests.join(shared, "digest").groupBy("row").agg(
            F.collect_list("digest").alias("candidates")), "candidates")
        passages = settle(texts.drop("whole").join(candidates, "row").mapInArrow(
            _passage_rows(passage_words),
            "number bigint, row binary, nth int, high bigint, low bigint"), "passages")
        first = settle(passages.groupBy("high", "low").agg(
            F.min(_order()).alias("first"), F.max(_order()).alias("last"))
            .where("first < last").select("high", "low", "first"), "first-passages")
        later = passages.join(first, ["high", "low"]).where(_order() > F.col("first")).select(
            "row", "nth")
        inner = cut.where("inner").select("row", F.lit(None).cast("int").alias("nth"))
        # A set: rows that repeat id and text are one document.
        listed = later.union(inner).groupBy("row").agg(
            F.sort_array(F.collect_set("nth")).alias("nth"))
        before = F.filter("nth", lambda x, i: (i == 0) | (F.get("nth", i - 1) < x - 1))
        behind = F.filter("nth", lambda x, i: (i == F.size("nth") - 1)
                          | (F.get("nth", i + 1) > x + 1))
        out = listed.select("row", before.alias("starts"), behind.alias("ends"),
                            F.lit(False).alias("copy"))
        none = F.array().cast("array<int>")
        return settle(out.union(copies.distinct().select("row", none, none, F.lit(True))),
                      "repeated-passages", keep=True)


def removed(text: str, starts, ends, passage_words: int, copy: bool = False
            ) -> list[tuple[int, int]]:
    """Character spans of a text's passages that occur before: those listed, and
    those that end in it before they begin again. A copy has no others."""
    begins, hashes = words_of(text)
    if copy:
        return [(0, len(text))] if len(hashes) >= passage_words else []
    high, low = _passages(hashes, passage_words)
    _, first, which = np.unique(high + textual.mix(low), return_index=True, return_inverse=True)
    place = np.flatnonzero(np.arange(len(high)) - first[which] >= passage_words)
    covered = np.zeros(len(begins) + 1, np.int64)
    np.add.at(covered, np.concatenate((place, np.asarray(starts, np.int64))), 1)
    np.add.at(covered, np.concatenate((place, np.asarray(ends, np.int64))) + passage_words, -1)
    inside = (np.cumsum(covered)[:-1] > 0).astype(np.int8)
    step = np.diff(np.concatenate(([0], inside, [0])))
    edges = np.append(begins, len(text))
    return [(int(edges[a]), int(edges[b])) for a, b in
            zip(np.flatnonzero(step == 1), np.flatnonzero(step == -1), strict=True)]


def _remover(passage_words: int):
    @F.pandas_udf("text string, spans array<struct<start: int, end: int>>")
    def without(texts: pd.Series, starts: pd.Series, ends: pd.Series,
                copies: pd.Series) -> pd.DataFrame:
        out = []
        for text, first, last, copy in zip(texts, starts, ends, copies, strict=True):
            spans = [] if text is None else removed(text, first, last, passage_words, bool(copy))
            if not spans:
                out.append((text, None))
                continue
            kept, at = [], 0
            for start, end in spans:
                kept.append(text[at:start])
                at = end
            kept.append(text[at:])
            out.append(("".join(kept), [{"start": a, "end": b} for a, b in spans]))
        return pd.DataFrame(out, columns=["text", "spans"])
    return without


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    passage_words: int = PASSAGE_WORDS) -> DataFrame:
    """All rows and columns with the text less its repeated passages, and
    ``removed_spans`` (null where nothing was removed; a column of that name is
    replaced; no other name clashes).

    Documents are ordered by id (null last), those of equal id by a digest of
    id and text. Rows that repeat id and text are one document and get the same
    result; an equal text of another id is a copy and loses its text if it has
    ``passage_words`` words. Passages repeated within a document are kept once. A
    null or empty text stays as it is, and so does a text whose repeated passages
    are all too short. An empty table gives no rows.
    """
    _, row, _ = _named(id_col, text_col)
    found = repeated_passages(docs, id_col, text_col, passage_words)
    joined = docs.select(packed(docs).alias("_all"), row.alias("row")).join(found, "row", "left")
    # Texts without a repeated passage don't go through Python.
    some = F.col("copy").isNotNull()
    original = F.col("_all").getField(text_col)
    cut = joined.withColumn("cut", _remover(passage_words)(
        F.when(some, original.cast("string")), "starts", "ends", "copy"))
    text = F.when(some, F.col("cut.text")).otherwise(original)
    names = [c for c in docs.columns if c.lower() != "removed_spans"]
    return cut.select(*[text.alias(c) if c == text_col else unpacked("_all", [c])[0]
                        for c in names], F.col("cut.spans").alias("removed_spans"))
