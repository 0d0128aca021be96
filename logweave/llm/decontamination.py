"""Benchmark decontamination by template canonicalisation.

Numbers, names and units become typed placeholders, so that a question and its
re-parameterised copy have the same template. Windows of template tokens are
looked up in the benchmark's window table (a hash join whose build side is the
benchmark, a bounded slice of its items at a time); a hit counts if its slots
are consistent: one value of the item always stands for one value of the
document, and different values for different ones. A document is contaminated
by an item if enough of the item's windows hit. Beside the templates, the very
words are looked up without regard to case: in capitals or lower case, names can't
be told from other words.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textual

#: Tokens in a window, and the share of an item's windows that must hit.
WINDOW, COVERAGE = 8, 0.5
#: Least tokens of a window that are not placeholders.
LITERALS = 4
#: Benchmark characters that a pass over the documents looks up at once.
SLICE_CHARS = 8_000_000
_U = np.uint64
WORD, NUMBER, NAME, UNIT = 0, 1, 2, 3

# Number words and units of measure.
NUMBER_WORDS = """zero one two three four five six seven eight nine ten eleven twelve
thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty thirty forty fifty
sixty seventy eighty ninety hundred thousand million billion""".split()
UNITS = """mm cm m km in ft yd mi inch inches foot feet yard yards mile miles meter meters
metre metres kilometer kilometers kilometre kilometres centimeter centimeters centimetre
centimetres mg g kg t lb lbs oz gram grams kilogram kilograms ton tons pound pounds ounce
ounces ml l liter liters litre litres gallon gallons pint pints cup cups s sec secs second
seconds min mins minute minutes h hr hrs hour hours day days week weeks month months year
years c f k degree degrees celsius fahrenheit kelvin percent usd eur gbp dollar dollars
euro euros cent cents mph kph kmh kw w v j kj n pa hz khz mhz ghz kb mb gb tb""".split()


class Tokens(NamedTuple):
    """Template hashes, kinds and value hashes of texts' words, and whose; which
    words may be names that begin a sentence."""

    template: np.ndarray
    kind: np.ndarray
    value: np.ndarray
    text: np.ndarray
    initial: np.ndarray

    def named(self) -> np.ndarray:
        """Template hashes if all words that may be names are."""
        return np.where(self.initial, textual.mix(_U([NAME + 1])), self.template)


def _hashes(words: list[str]) -> np.ndarray:
    return np.unique(textual.words_of(["\n".join(words)]).hashes)


_NUMBERS, _UNITS = None, None


def tokens(texts: list[str | None]) -> tuple[Tokens, Tokens]:
    """Words with their kind, and the words as they are, in lower case and without
    kinds. A number is a word that begins with a digit (its
    decimals and thousands are further words of the same number), or a number
    word; a unit is a unit word after a number; a name begins with a capital,
    goes on in lower case and does not begin a sentence. Names, and number words
    behind a number, that only a blank or hyphen parts are one token."""
    global _NUMBERS, _UNITS
    if _NUMBERS is None:
        _NUMBERS, _UNITS = _hashes(NUMBER_WORDS), _hashes(UNITS)
    words = textual.words_of(texts)
    n = len(words.hashes)
    kind = np.zeros(n, np.int8)
    plain = _plain(texts, words)
    if not n:
        return plain, plain
    table = textual.char_classes()
    at = textual.bounds(words.text, len(texts))
    joined, new_sentence, beside = np.zeros(n, bool), np.ones(n, bool), np.zeros(n, bool)
    digit, capital, second_upper = (np.zeros(n, bool) for _ in range(3))
    for i, text in enumerate(texts):
        a, b = at[i], at[i + 1]
        if a == b:
            continue
        starts, ends = words.starts[a:b], words.ends[a:b]
        for first in range(0, b - a, textual.SLICE // 8):
            part = slice(first, min(first + textual.SLICE // 8, b - a))
            base = int(starts[part][0] if first == 0 else ends[first - 1])
            codes = textual.code_points(text[base:int(ends[part][-1])])
            flags = table[codes]
            s, e = starts[part] - base, ends[part] - base
            digit[a:b][part] = flags[s] & textual.DIGIT != 0
            capital[a:b][part] = flags[s] & textual.UPPER != 0
            second_upper[a:b][part] = (flags[np.minimum(s + 1, len(flags) - 1)]
                                       & textual.UPPER != 0) & (e - s > 1)
            # What lies between a word and the one before it.
            stop = np.concatenate(([0], np.cumsum(np.isin(codes, _STOPS))))
            from_end = np.concatenate(([0], e[:-1]))
            fresh = stop[s] - stop[from_end] > 0
            if first == 0:
                fresh[0] = True
            new_sentence[a:b][part] = fresh
            gap = s - from_end
            point = (gap == 1) & np.isin(codes[np.maximum(s - 1, 0)], _POINTS)
            point[0] = point[0] and first > 0
            joined[a:b][part] = point
            between = codes[np.maximum(s - 1, 0)]
            beside[a:b][part] = (gap == 1) & ((table[between] & textual.SPACE != 0)
                                              | np.isin(between, _HYPHENS))
            beside[a] = False
    number = digit | np.isin(words.hashes, _NUMBERS)
    joined &= digit & np.concatenate(([False], digit[:-1]))
    kind[number] = NUMBER
    name = ~number & capital & ~second_upper & ~new_sentence
    kind[name] = NAME
    after = np.concatenate(([False], (number & (words.text == np.roll(words.text, -1)))[:-1]))
    kind[(kind == WORD) & after & np.isin(words.hashes, _UNITS)] = UNIT
    template = np.where(kind == WORD, words.hashes, textual.mix(kind.astype(_U) + _U(1)))
    # New York and Paris, thirty five and forty are one token each.
    same = beside & np.concatenate(([False], kind[1:] == kind[:-1]))
    joined |= same & ((kind == NAME) | (number & ~digit))
    # A number with its decimals is one token: its value is that of all parts.
    whole = np.flatnonzero(~joined)
    group = np.cumsum(~joined) - 1
    value = np.zeros(len(whole), _U)
    np.add.at(value, group, textual.mix(words.hashes + np.arange(n, dtype=_U) - whole[group].astype(_U)))
    initial = capital & ~second_upper & new_sentence & (kind == WORD)
    return Tokens(template[whole], kind[whole], value, words.text[whole], initial[whole]), plain


def _plain(texts: list[str | None], words: textual.Words) -> Tokens:
    """The words in folded case. Only in texts that folding makes longer (as that of
    a sharp s) they are other words than those in lower case."""
    folded = [text.casefold() if text else "" for text in texts]
    longer = np.array([i for i, text in enumerate(folded) if len(text) != len(texts[i] or "")],
                      np.int64)
    hashes, text = words.hashes, words.text
    if len(longer):
        kept = ~np.isin(text, longer)
        again = textual.words_of([folded[i] for i in longer])
        hashes = np.concatenate((hashes[kept], again.hashes))
        text = np.concatenate((text[kept], longer[again.text]))
        order = np.argsort(text, kind="stable")
        hashes, text = hashes[order], text[order]
    none = np.zeros(len(hashes), np.int8)
    return Tokens(hashes, none, hashes, text, none > 0)


_STOPS = np.array([ord(c) for c in ".!?\n\r:|。"], np.uint32)
_HYPHENS = np.array([ord(c) for c in "-\u2010\u2011"], np.uint32)
_POINTS = np.array([ord(c) for c in ".,"], np.uint32)


def _literal(literal: np.ndarray, size: int, least: int) -> np.ndarray:
    """Windows with so many literals."""
    count = np.concatenate(([0], np.cumsum(literal)))
    return np.flatnonzero(count[size:] - count[:-size] >= least)


def _known(h: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """Which windows the sorted table has."""
    return np.flatnonzero(h[np.minimum(np.searchsorted(h, windows), len(h) - 1)] == windows)


class Benchmark:
    """A slice of the benchmark's items, by templates and by their very words."""

    def __init__(self, items: list[tuple[int, str]]):
        self.ids = [i for i, _ in items]
        typed, plain = tokens([text for _, text in items])
        # Shorter items are looked up as they stand by the templates' table.
        self.tables = (_Table(len(items), typed, 1), _Table(len(items), plain, WINDOW))

    def hits(self, texts: list[str | None]) -> Iterator[tuple[int, int, float, int]]:
        """``(text, item, coverage, changed slots)`` of contaminated texts."""
        best: dict[tuple[int, int], tuple[float, int]] = {}
        for table, t in zip(self.tables, tokens(texts), strict=True):
            for d, i, coverage, changed in table.hits(t, len(texts)):
                # Of equal shares, the reading that changes less.
                now = (coverage, -changed)
                best[d, i] = max(best.get((d, i), now), now)
        for (d, i), (coverage, changed) in sorted(best.items()):
            yield d, i, coverage, -changed


class _Table:
    """Window table and tokens of items of at least ``shortest`` tokens."""

    def __init__(self, many: int, t: Tokens, shortest: int):
        items = range(many)
        at = textual.bounds(t.text, many)
        self.kind = [t.kind[at[i]:at[i + 1]] for i in range(len(items))]
        self.value = [t.value[at[i]:at[i + 1]] for i in range(len(items))]
        self.initial = [t.initial[at[i]:at[i + 1]] for i in range(len(items))]
        named = t.named()
        #: Windows of items as long as a window, and of every shorter length.
        self.sizes: dict[tuple[int, bool], tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        self.total = [0] * len(items)
        rows: dict[tuple[int, bool], list] = {}
        for i in range(len(items)):
            part = t.template[at[i]:at[i + 1]]
            size = min(WINDOW, len(part))
            if len(part) < shortest:
                continue
            least = min(LITERALS, (size + 1) // 2)
            place = _literal(self.kind[i] == WORD, size, least)
            verbatim = not len(place)
            if verbatim and (size == WINDOW or (self.kind[i] == WORD).any()):
                # Too few literals for a template: the very words count.
                part, place = self.value[i], np.arange(len(part) - size + 1)
            self.total[i] = len(place)
            if not len(place):
                continue
            rows.setdefault((size, verbatim), []).append(
                (textual.windows(part, size)[place], np.full(len(place), i), place))
            if not verbatim:
                # Windows with names that begin sentences, if these are names.
                both = named[at[i]:at[i + 1]]
                also = _literal((self.kind[i] == WORD) & ~self.initial[i], size, least)
                also = np.setdiff1d(also, _literal(~self.initial[i], size, size))
                rows[size, False].append((textual.windows(both, size)[also],
                                          np.full(len(also), i), also))
        for key, parts in rows.items():
            h, item, place = (np.concatenate(c) for c in zip(*parts, strict=True))
            order = np.argsort(h, kind="stable")
            self.sizes[key] = h[order], item[order], place[order]

    def hits(self, t: Tokens, many: int) -> Iterator[tuple[int, int, float, int]]:
        at = textual.bounds(t.text, many)
        found: dict[tuple[int, int], set] = {}
        named = t.named()
        for (size, verbatim), (h, item, place) in self.sizes.items():
            for first in range(0, len(t.template), textual.SLICE):
                part = slice(first, first + textual.SLICE + size - 1)
                got = textual.windows((t.value if verbatim else t.template)[part], size)
                near = _known(h, got)
                w, lookup = near, got[near]
                if not verbatim:
                    other = textual.windows(named[part], size)
                    near = _known(h, other)
                    near = near[other[near] != got[near]]
                    w, lookup = np.append(w, near), np.append(lookup, other[near])
                left = np.searchsorted(h, lookup, "left")
                right = np.searchsorted(h, lookup, "right")
                for w, a, b in zip(w.tolist(), left.tolist(), right.tolist(), strict=True):
                    w += first
                    d = int(t.text[w])
                    if w + size > at[d + 1]:
                        continue
                    for k in range(a, b):
                        found.setdefault((d, int(item[k])), set()).add(
                            (w - int(at[d]), int(place[k]), size))
        for (d, i), places in sorted(found.items()):
            coverage, changed = self._consistent(i, places, t.value[at[d]:at[d + 1]])
            if coverage >= COVERAGE:
                yield d, i, coverage, changed

    def _consistent(self, i: int, places: set, value) -> tuple[float, int]:
        """The largest share of the item's windows that hit with one reading of
        its slots, near one place of the document, and the slots that differ.

        A copy's windows follow each other in both; a word more or less moves
        the rest of them, by up to half the item's tokens."""
        best = (0.0, 0)
        by_start = sorted((w - p, p, w, size) for w, p, size in places)
        offsets = [start for start, *_ in by_start]
        band = len(self.kind[i]) // 2
        # Each place of the document where a copy may begin, by the windows
        # that agree on it.
        for start, _ in Counter(offsets).most_common():
            near = by_start[bisect_left(offsets, start - band):bisect_right(offsets, start + band)]
            if len({p for _, p, *_ in near}) < max(best[0], COVERAGE) * self.total[i]:
                continue
            for chain in ([x for x in near if x[0] == start], _chain(near)):
                found = self._agreeing(i, chain, value)
                if found[0] > best[0]:
                    best = found
        return best

    def _agreeing(self, i: int, chain: list, value) -> tuple[float, int]:
        forward: dict[int, int] = {}
        back: dict[int, int] = {}
        good: set[int] = set()
        changed: set[int] = set()
        for _, p, w, size in chain:
            slots = [k for k in range(size) if self.kind[i][p + k] != WORD
                     or self.initial[i][p + k] and self.value[i][p + k] != value[w + k]]
            pairs = {(int(self.value[i][p + k]), int(value[w + k])) for k in slots}
            if all(forward.get(a, b) == b and back.get(b, a) == a for a, b in pairs) \
                    and len({a for a, _ in pairs}) == len({b for _, b in pairs}) == len(pairs):
                for a, b in pairs:
                    forward[a], back[b] = b, a
                good.add(p)
                changed |= {p + k for k in slots if self.value[i][p + k] != value[w + k]}
        return len(good) / max(self.total[i], 1), len(changed)


def _chain(near: list) -> list:
    """The most windows whose places rise in the item and in the document."""
    ends: list[int] = []
    last: list[int] = []
    before: list[int] = []
    rows = sorted(near, key=lambda x: (x[1], -x[2]))
    for at, (_, _, w, _) in enumerate(rows):
        k = bisect_left(ends, w)
        before.append(last[k - 1] if k else -1)
        ends[k:k + 1], last[k:k + 1] = [w], [at]
    out, at = [], last[-1] if last else -1
    while at >= 0:
        out.append(rows[at])
        at = before[at]
    return out[::-1]


def benchmark_slices(benchmark: DataFrame, id_col: str = "item_id",
                     text_col: str = "text", most: int = SLICE_CHARS) -> list[DataFrame]:
    """The benchmark's items in slices of about ``most`` characters."""
    items = benchmark.select(F.col(id_col).cast("long").alias("item"),
                             F.col(text_col).cast("string").alias("text")).where(
        "item is not null and text is not null").distinct()
    chars = items.agg(F.sum(F.length("text")).alias("n")).first()["n"] or 0
    pieces = -(-chars // most) or 1
    return [items.where(F.pmod(F.xxhash64("item", "text"), F.lit(pieces)) == k)
            for k in range(pieces)]


def _held(shared, cache: dict) -> Benchmark:
    if "b" not in cache:
        cache["b"] = Benchmark(shared.value)
    return cache["b"]


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
                 text_col: str = "text", item_col: str = "item_id",
                 item_text_col: str = "text") -> DataFrame:
    """``doc_id, item_id, coverage, changed_slots``: a row for every document
    and item it is contaminated by.

    ``coverage`` is the share of the item's windows that the document has with
    consistent slots at one place, at least ``COVERAGE``; ``changed_slots`` counts numbers,
    names and units that differ. Items or documents that are null or have no
    word give no row, nor do items of fewer placeholders alone than a window
    has; an item with too few literals for a template is looked up as it
    stands. A word that begins a sentence with a capital is tried as a name too. A
    copy in another case is found by its words. An item shorter than a window is one
    window. A very long text is read whole, in slices; an empty table, of documents or
    of items, gives no rows. Repeated documents give repeated rows; an item id with
    several texts is judged text by text. Other columns are ignored.
    """
    out = None
    texts = docs.select(F.col(id_col).alias("doc_id"),
                        F.col(text_col).cast("string").alias("text"))
    for part in benchmark_slices(benchmark, item_col, item_text_col):
        shared = docs.sparkSession.sparkContext.broadcast(
            sorted((r["item"], r["text"]) for r in part.collect()))
        cache: dict = {}

        def run(batches: Iterator[pa.RecordBatch], shared=shared, cache=cache
                ) -> Iterator[pa.RecordBatch]:
            table = _held(shared, cache)
            for batch in textual.small(batches):
                names = batch.column("text").to_pylist()
                rows = [(first + d, table.ids[i], c, n)
                        for first, last in textual.batches(names, textual.SLICE)
                        for d, i, c, n in table.hits(names[first:last])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array([r[0] for r in rows], pa.int64())),
                     pa.array([r[1] for r in rows], pa.int64()),
                     pa.array([r[2] for r in rows], pa.float64()),
                     pa.array([r[3] for r in rows], pa.int32())],
                    ["doc_id", "item_id", "coverage", "changed_slots"])

        found = texts.mapInArrow(
            run, f"doc_id {docs.schema[id_col].dataType.simpleString()}, item_id bigint, "
                 "coverage double, changed_slots int")
        out = found if out is None else out.union(found)
    return out


def _clean(shared):
    cache: dict = {}

    @F.pandas_udf("boolean")
    def clean(texts: pd.Series) -> pd.Series:
        table, names = _held(shared, cache), texts.tolist()
        keep = np.ones(len(names), bool)
        for first, last in textual.batches(names, textual.SLICE):
            for d, *_ in table.hits(names[first:last]):
                keep[first + d] = False
        return pd.Series(keep)
    return clean


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The rows, with all their columns, that no item contaminates; null and empty
    texts stay, and an empty table gives no rows. See :func:`contaminated`."""
    for part in benchmark_slices(benchmark, item_col, item_text_col):
        shared = docs.sparkSession.sparkContext.broadcast(
            sorted((r["item"], r["text"]) for r in part.collect()))
        docs = docs.where(_clean(shared)(F.col(text_col).cast("string")))
    return docs
