"""SentencePiece encoding and decoding; giant texts by a max-plus scan.

The pieces of a text are the one sequence in which every two neighbours are
what the model makes of their joined string. Give a pair of neighbours the
weight 0 if it is such a pair and minus infinity if not: the encoding is the
path of weight 0. A giant text is cut every ``CHUNK`` characters, wherever that
falls. The state at a cut is the piece that reaches up to or over it; a chunk
yields the transfer matrix of weights between the states at its two cuts, and
matrices combine associatively by max-plus products, level by level in groups
of ``fanout`` chunks. Going down again, every chunk learns the state at either
end, and then its path is traced back without any other chunk.

Minus infinity is not stored: a matrix is the set of its entries 0, and the
product is the composition of such sets. Between two words only one state is
possible, so within a chunk only the parts before its first word and from its
last one on need the states; whole words between are encoded directly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .pieces import MARK, Pieces, pieces_of, read_model
from .textual import small

#: Characters of a chunk; texts with more are cut.
CHUNK = 32_768
#: Matrices that one product takes.
FANOUT = 256
#: State between two words, and at a text's ends.
FRESH = ""


class Lattice:
    """Paths through the pieces of a part of a marked text."""

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self.pairs: dict[tuple[str, str], bool] = {}
        self.whole: dict[str, bool] = {}

    def stands(self, piece: str) -> bool:
        """Whether the model leaves this string as one piece; a character that
        is in no piece stands alone."""
        got = self.whole.get(piece)
        if got is None:
            ids = self.pieces.ids
            got = len(piece) == 1 or (piece in ids and self.pieces.library.encode(piece)
                                      == [ids[piece]])
            self.whole[piece] = got
        return got

    def fits(self, a: str, b: str) -> bool:
        """Weight 0 (True) or minus infinity of two neighbours."""
        got = self.pairs.get((a, b))
        if got is None:
            ids = self.pieces.ids
            got = a not in ids or b not in ids or \
                self.pieces.library.encode(a + b) == [ids[a], ids[b]]
            if len(self.pairs) > 200_000:
                self.pairs.clear()
            self.pairs[a, b] = got
        return got

    def starting(self, text: str, at: int) -> list[str]:
        ids = self.pieces.ids
        return [p for n in range(1, min(self.pieces.longest, len(text) - at) + 1)
                if ((p := text[at:at + n]) in ids or n == 1) and self.stands(p)]

    def across(self, text: str, cut: int) -> list[tuple[str, int]]:
        """Pieces that begin before a cut and end at or after it, and their ends."""
        return [(p, at + len(p)) for at in range(max(0, cut - self.pieces.longest), cut)
                for p in self.starting(text, at) if at + len(p) >= cut]

    def forward(self, text: str, first: int, last: int, states: list[tuple[str, int]]
                ) -> dict[int, dict[str, int]]:
        """For every position a path may pass, its last pieces and, as bits,
        the states it may have come from. Pieces begin before ``last``; without
        states the path begins afresh at ``first``."""
        at: dict[int, dict[str, int]] = {}
        for bit, (piece, end) in enumerate(states):
            row = at.setdefault(end, {})
            row[piece] = row.get(piece, 0) | 1 << bit
        if not states:
            at[first] = {FRESH: 1}
        for here in range(first, last):
            before = at.get(here)
            if not before:
                continue
            for piece in self.starting(text, here):
                bits = 0
                for prior, mask in before.items():
                    if prior == FRESH or self.fits(prior, piece):
                        bits |= mask
                if bits:
                    row = at.setdefault(here + len(piece), {})
                    row[piece] = row.get(piece, 0) | bits
        return at

    def path(self, at: dict[int, dict[str, int]], first: int, end: int, piece: str | None
             ) -> list[str]:
        """Trace back from a piece that ends at ``end`` (None: the only one) to
        a piece that ends at ``first`` or to a fresh start there."""
        out: list[str] = []
        while end > first:
            row = at.get(end, {})
            options = [p for p in row if (piece is None or p == piece) and (
                not out or self.fits(p, out[-1]))]
            if len(options) != 1:
                raise ValueError("the pieces have no single path here")
            out.append(options[0])
            end -= len(options[0])
            piece = None
        return out[::-1]

    def ids(self, path: list[str]) -> list[int]:
        out = []
        for piece in path:
            if piece in self.pieces.ids:
                out.append(self.pieces.ids[piece])
            else:
                out += [self.pieces.byte_id[b] for b in piece.encode("utf-8")]
        return out


def _begins(text: str, at: int) -> bool:
    """Whether a word begins here: no piece reaches over the place."""
    return at == 0 or at >= len(text) or (text[at] == MARK and text[at - 1] != MARK)


class Chunk:
    """Characters ``begin`` to ``end`` of ``text``, a part of a marked text with
    enough around it for every piece that reaches in; ``head`` and ``tail`` say
    that the whole text begins or ends with the chunk."""

    def __init__(self, lattice: Lattice, text: str, begin: int, end: int,
                 head: bool, tail: bool):
        self.lattice, self.text, self.begin, self.end = lattice, text, begin, end
        self.opens = head or _begins(text, begin)
        self.closes = tail or _begins(text, end)
        # Its first and last place between words.
        self.first = begin if self.opens else next(
            (i for i in range(begin + 1, end) if _begins(text, i)), None)
        self.last = end if self.closes else next(
            (i for i in range(end - 1, begin - 1, -1) if _begins(text, i)), None)
        if self.first is None and self.closes:
            self.first = end
        if self.last is None and self.opens:
            self.last = begin

    def _states(self, cut: int) -> list[tuple[str, int]]:
        return self.lattice.across(self.text, cut)

    def _name(self, piece: str, end: int, cut: int) -> str:
        return f"{end - cut}:{piece}"

    def _read(self, state: str, cut: int) -> tuple[str, int]:
        ahead, _, piece = state.partition(":")
        return piece, cut + int(ahead)

    def matrix(self) -> list[tuple[str, str]]:
        """The entries 0 of the transfer matrix."""
        text, begin, end = self.text, self.begin, self.end
        starts = [] if self.opens else self._states(begin)
        names = [FRESH] if self.opens else [self._name(p, e, begin) for p, e in starts]
        if self.first is None or self.last is None:
            # One word fills the chunk.
            at = self.lattice.forward(text, begin, end, starts)
            return [(names[k], FRESH if self.closes else self._name(p, e, end))
                    for e, row in at.items() if e >= end and (e == end or not self.closes)
                    for p, bits in row.items() for k in range(len(names)) if bits >> k & 1]
        enter = names
        if not self.opens:
            at = self.lattice.forward(text, begin, self.first, starts)
            bits = 0
            for mask in at.get(self.first, {}).values():
                bits |= mask
            enter = [n for k, n in enumerate(names) if bits >> k & 1]
        leave = [FRESH]
        if not self.closes:
            at = self.lattice.forward(text, self.last, end, [])
            leave = [self._name(p, e, end) for e, row in at.items() if e >= end for p in row]
        return [(a, b) for a in enter for b in leave]

    def encode(self, enter: str, leave: str) -> np.ndarray:
        """Ids of the pieces that begin in the chunk."""
        lattice, text, begin, end = self.lattice, self.text, self.begin, self.end
        start = [] if enter == FRESH else [self._read(enter, begin)]
        origin = start[0][1] if start else begin
        piece, goal = (None, end) if leave == FRESH else self._read(leave, end)
        if self.first is None or self.last is None:
            at = lattice.forward(text, begin, end, start)
            return np.array(lattice.ids(lattice.path(at, origin, goal, piece)),
                            lattice.pieces.dtype)
        parts = []
        if not self.opens:
            at = lattice.forward(text, begin, self.first, start)
            parts.append(lattice.ids(lattice.path(at, origin, self.first, None)))
        parts.append(lattice.pieces.encode(text[self.first:self.last]))
        if not self.closes:
            at = lattice.forward(text, self.last, end, [])
            parts.append(lattice.ids(lattice.path(at, self.last, goal, piece)))
        return np.concatenate([np.asarray(p, lattice.pieces.dtype) for p in parts])


def marked(text: str) -> str:
    return MARK + text.replace(" ", MARK) if text else ""


def _cuts(text: str, longest: int, size: int) -> Iterator[tuple[int, str, int, int, bool, bool]]:
    """``(number, part, begin, end, head, tail)`` of a marked text's chunks."""
    n = len(text)
    for k, at in enumerate(range(0, n, size)):
        low, high = max(0, at - 2 * longest), min(n, at + size + 2 * longest)
        yield (k, text[low:high], at - low, min(at + size, n) - low, at == 0,
               at + size >= n)


def compose(matrices: list[list[tuple[str, str]]]) -> list[tuple[str, str]]:
    """Max-plus product of matrices given by their entries 0."""
    product = matrices[0]
    for matrix in matrices[1:]:
        after: dict[str, list[str]] = {}
        for a, b in matrix:
            after.setdefault(a, []).append(b)
        product = list(dict.fromkeys((a, c) for a, b in product for c in after.get(b, ())))
    return product


def states_between(matrices: list[list[tuple[str, str]]], enter: str, leave: str) -> list[str]:
    """States at all cuts from the first to the last on the path of weight 0."""
    reached = [{enter}]
    for matrix in matrices:
        reached.append({b for a, b in matrix if a in reached[-1]})
    states = [leave]
    for matrix, before in zip(reversed(matrices), reversed(reached[:-1]), strict=True):
        options = {a for a, b in matrix if b == states[-1] and a in before}
        if len(options) != 1:
            raise ValueError("the chunks have no single path")
        states.append(options.pop())
    return states[::-1]


_LATTICES: dict[bytes, Lattice] = {}


def _lattice(model: bytes) -> Lattice:
    if model not in _LATTICES:
        _LATTICES.clear()
        _LATTICES[model] = Lattice(pieces_of(model))
    return _LATTICES[model]


_MATRIX = "array<struct<enter: string, leave: string>>"
_ENTRY = pa.list_(pa.struct([("enter", pa.string()), ("leave", pa.string())]))


def _entries(matrix) -> list[tuple[str, str]]:
    return [(e["enter"], e["leave"]) for e in matrix]


def _up(fanout: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("k")
        product = compose([_entries(m) for m in group["matrix"]])
        return pd.DataFrame({"text_key": [group["text_key"].iloc[0]],
                             "k": [group["k"].iloc[0] // fanout],
                             "matrix": [[{"enter": a, "leave": b} for a, b in product]]})
    return run


def _down(group: pd.DataFrame) -> pd.DataFrame:
    group = group.sort_values("k")
    states = states_between([_entries(m) for m in group["matrix"]],
                            group["enter"].iloc[0], group["leave"].iloc[0])
    return pd.DataFrame({"text_key": group["text_key"], "k": group["k"],
                         "enter": states[:-1], "leave": states[1:]})


def scan(matrices: DataFrame, most: int, fanout: int = FANOUT) -> DataFrame:
    """``text_key, k, enter, leave``: the states at either end of every chunk,
    of matrices ``text_key, k, matrix`` of texts with at most ``most`` chunks."""
    levels = [matrices]
    depth = 1
    while fanout ** depth < most:
        depth += 1
    by_group = ["text_key", F.floor(F.col("k") / fanout).alias("g")]
    for _ in range(depth - 1):
        levels.append(levels[-1].groupBy(*by_group).applyInPandas(
            _up(fanout), f"text_key string, k bigint, matrix {_MATRIX}"))
    known = levels[-1].select("text_key", F.lit(0).cast("bigint").alias("g"),
                              F.lit(FRESH).alias("enter"), F.lit(FRESH).alias("leave")).distinct()
    for level in reversed(levels):
        met = level.withColumn("g", F.floor(F.col("k") / fanout)).join(known, ["text_key", "g"])
        known = met.groupBy("text_key", "g").applyInPandas(
            _down, "text_key string, k bigint, enter string, leave string").withColumnRenamed(
                "k", "g")
    return known.withColumnRenamed("g", "k")


def encode(docs: DataFrame, model_path: str, id_col: str = "doc_id",
           text_col: str = "text", size: int = CHUNK, fanout: int = FANOUT) -> DataFrame:
    """``doc_id, chunk, chunks, ids``: the piece ids of every text, exactly
    those of the model, a row for each chunk of ``size`` characters.

    A piece belongs to the chunk it begins in. A null text has one row with
    null ids, an empty one a row without ids. Rows that repeat are encoded
    each. Of the other columns none is looked at. Ids of a giant text are never
    brought together: its rows in chunk order are the encoding.
    """
    model = docs.sparkSession.sparkContext.broadcast(read_model(model_path))
    kind = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(F.col(id_col).alias("doc_id"),
                        F.col(text_col).cast("string").alias("text"))
    schema = f"doc_id {kind}, chunk int, chunks int, ids array<int>"
    names = ["doc_id", "chunk", "chunks", "ids"]

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pieces_of(model.value)
        for batch in small(batches):
            column = batch.column("text").to_pylist()
            for first in range(0, len(column), 500):
                got = [None if t is None else pieces.encode(marked(t)).astype(np.int32)
                       for t in column[first:first + 500]]
                n = len(got)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(first, n), pa.array([0] * n, pa.int32()),
                     pa.array([1] * n, pa.int32()), _lists(got)], names)

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = _lattice(model.value)
        for batch in small(batches):
            for key, text in zip(batch.column("text_key").to_pylist(),
                                 batch.column("text").to_pylist(), strict=True):
                for k, part, *place in _cuts(marked(text), lattice.pieces.longest, size):
                    entries = Chunk(lattice, part, *place).matrix()
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([key]), pa.array([k], pa.int64()),
                         pa.array([[{"enter": a, "leave": b} for a, b in entries]], _ENTRY)],
                        ["text_key", "k", "matrix"])

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        longest = pieces_of(model.value).longest
        for batch in small(batches):
            for i, text in enumerate(batch.column("text").to_pylist()):
                whole = marked(text)
                total = -(-len(whole) // size)
                for k, *place in _cuts(whole, longest, size):
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("doc_id").slice(i, 1), batch.column("text_key").slice(i, 1),
                         pa.array([k], pa.int64()), pa.array([total], pa.int32()),
                         *[pa.array([v]) for v in place]],
                        ["doc_id", "text_key", "k", "chunks", "part", "begin", "end", "head",
                         "tail"])

    def traced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = _lattice(model.value)
        for batch in small(batches):
            rows = batch.to_pylist()
            got = [Chunk(lattice, r["part"], r["begin"], r["end"], r["head"], r["tail"]).encode(
                r["enter"], r["leave"]).astype(np.int32) for r in rows]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([r["k"] for r in rows], pa.int32()),
                 batch.column("chunks"), _lists(got)], names)

    fits = F.col("text").isNull() | (F.length("text") + 1 <= size)
    usual = texts.where(fits).mapInArrow(short, schema)
    giants = texts.where(~fits).withColumn("text_key", F.sha2(F.col("text"), 256))
    longest = giants.agg(F.max(F.length("text")).alias("n")).first()["n"]
    if longest is None:
        return usual
    # Equal texts share their matrices.
    table = giants.select("text_key", "text").mapInArrow(
        matrices, f"text_key string, k bigint, matrix {_MATRIX}").dropDuplicates(
            ["text_key", "k"])
    ends = scan(table, -(-(longest + 1) // size), fanout)
    cut = giants.mapInArrow(parts, f"doc_id {kind}, text_key string, k bigint, chunks int, "
                                   "part string, begin bigint, end bigint, head boolean, "
                                   "tail boolean")
    return usual.union(cut.join(ends, ["text_key", "k"]).mapInArrow(traced, schema))


def _lists(rows: list[np.ndarray | None]) -> pa.Array:
    sizes = [0 if r is None else len(r) for r in rows]
    offsets = pa.array(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32))
    values = [r for r in rows if r is not None]
    flat = np.concatenate(values) if values else np.zeros(0, np.int32)
    mask = pa.array([r is None for r in rows])
    return pa.ListArray.from_arrays(offsets, pa.array(flat, pa.int32()), mask=mask)


def decode(encoded: DataFrame, model_path: str) -> DataFrame:
    """The rows of :func:`encode` with ``text``, the text of each chunk's
    pieces; in chunk order they make the whole text. Null ids give a null."""
    model = encoded.sparkSession.sparkContext.broadcast(read_model(model_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pieces_of(model.value)
        for batch in small(batches):
            out = []
            for ids, chunk in zip(batch.column("ids"), batch.column("chunk").to_pylist(),
                                  strict=True):
                text = None
                if ids.is_valid:
                    text = pieces.decode(ids.values.to_numpy())
                    # The first chunk begins with the mark of the first word.
                    text = text[1:] if chunk == 0 else text
                out.append(text)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(out, pa.string())], [*batch.schema.names, "text"])

    schema = encoded.schema.simpleString()[len("struct<"):-1]
    return encoded.mapInArrow(run, f"{schema},text:string")
