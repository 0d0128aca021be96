"""Conversation structure repair by a survivor-coalescence Viterbi search.

A conversation's rows stream by in order. For each state of the grammar
``(s?(ua)+)?`` one survivor is kept: the cheapest edits that lead there, of equal
ones the least in ASCII order. Survivors are leaves of a tree of edits that point
back and count their references. What no survivor descends from is freed, and
once all survivors share an ancestor the edits up to it are given out, so that
memory holds only what is unresolved; two tied survivors are compared over all of
their unresolved edits. A survivor that costs more than ``SLACK`` above the best
can't win any more and goes.

Inserted rows are booked with the row that follows them. Two survivors have then
edited the same rows and neither's edits begin with the other's, so that their
order is settled where they first differ. For the same reason a conversation may
be cut: each piece is searched from every state at its beginning, and costs and
orders of the pieces' survivors are joined along the conversation.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterator
from functools import lru_cache
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..storage import settle

#: Costs of edits; a row that is truncated and stays costs TRUNCATED more.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: No state is worth more than two inserted rows.
SLACK = 2 * INSERT
#: Conversations of more rows are searched in pieces of about so many.
PIECE_ROWS = 4096
#: Repaired rows, and their characters, of one output row.
CHUNK_ROWS, CHUNK_CHARS = 4096, 1 << 20
_MOST_PIECES = 10_000
_LOOK_EVERY = 64
# Fixed value: the blanks, as in [\x20\x09-\x0D].
BLANKS = " \t\n\x0b\x0c\r"

# States: nothing kept yet, after a system, user or assistant row.
_EMPTY, _SYSTEM, _USER, _ASSISTANT = range(4)
_STATES = (_EMPTY, _SYSTEM, _USER, _ASSISTANT)
_KEEP = {"s": {_EMPTY: _SYSTEM}, "u": {_EMPTY: _USER, _SYSTEM: _USER, _ASSISTANT: _USER},
         "a": {_USER: _ASSISTANT}}
#: What a rewritten or inserted row leads to, and the inserts that complete a state.
_ANY = {_EMPTY: _USER, _SYSTEM: _USER, _USER: _ASSISTANT, _ASSISTANT: _USER}
_TAIL = {_EMPTY: "", _SYSTEM: "II", _USER: "I", _ASSISTANT: ""}
_ROLE = {_USER: "user", _ASSISTANT: "assistant"}
_LEGAL = {"su", "ua", "au"}
_SOUND, _SHORT, _DOOMED = range(3)


@lru_cache(None)
def moves(kind: int, initial: str) -> tuple[tuple[int, int, int, str], ...]:
    """The best edits of one row from each state to each: (from, to, cost, edits).
    ``kind`` says whether the row is sound, truncated or must be deleted."""
    best: dict[tuple[int, int], tuple[int, str]] = {}
    more = TRUNCATED if kind == _SHORT else 0
    for start in _STATES:
        state, cost, before = start, 0, ""
        for _ in range(3):
            options = [(state, DELETE, "D")]
            if kind != _DOOMED:
                options.append((_ANY[state], REROLE + more, "R"))
                if state in _KEEP.get(initial, {}):
                    options.append((_KEEP[initial][state], more, "K"))
            for to, c, edit in options:
                found = (cost + c, before + edit)
                best[start, to] = min(best.get((start, to), found), found)
            state, cost, before = _ANY[state], cost + INSERT, before + "I"
    return tuple((start, to, *found) for (start, to), found in best.items())


class _Edit:
    """A row's edits, on top of those of the rows before. ``refs`` counts the
    edits that build on it, and the survivor that ends here."""

    __slots__ = ("before", "edits", "refs")

    def __init__(self, before, edits):
        self.before, self.edits, self.refs = before, edits, 1


def _less(a, edits_a, b, edits_b) -> bool:
    """Compare two unresolved suffixes, from where they part."""
    left, right = [edits_a], [edits_b]
    while a is not b:
        left.append(a.edits)
        right.append(b.edits)
        a, b = a.before, b.before
    return "".join(reversed(left)) < "".join(reversed(right))


class Search:
    """The survivors of a conversation, or of a piece that begins in ``state``."""

    def __init__(self, state: int = _EMPTY):
        self.root = _Edit(None, "")
        self.alive = {state: (0, self.root)}

    def push(self, kind: int, initial: str) -> None:
        """Take in the next row."""
        found: dict[int, tuple] = {}
        for start, to, cost, edits in moves(kind, initial):
            if start not in self.alive:
                continue
            base, node = self.alive[start]
            held = found.get(to)
            if held is None or base + cost < held[0] or (
                    base + cost == held[0] and _less(node, edits, held[1], held[2])):
                found[to] = (base + cost, node, edits)
        most = min(cost for cost, _, _ in found.values()) + SLACK
        old, self.alive = self.alive, {}
        for to, (cost, node, edits) in found.items():
            if cost <= most:
                node.refs += 1
                self.alive[to] = (cost, _Edit(node, edits))
        for _, node in old.values():
            while node is not None:       # nobody builds on it: free it
                node.refs -= 1
                if node.refs:
                    break
                node = node.before

    def _path(self, node) -> list:
        out = []
        while node is not self.root:
            out.append(node)
            node = node.before
        return out[::-1]

    def resolved(self) -> list[str]:
        """Edits of the rows on which all survivors agree; they are forgotten."""
        ends = {id(node) for _, node in self.alive.values()}
        out = []
        for node in self._path(next(iter(self.alive.values()))[1]):
            if self.root.refs > 1 or id(self.root) in ends:
                break
            out.append(node.edits)
            node.before = None
            self.root = node
        return out

    def finish(self) -> tuple[int, list[str], str]:
        """Cost, unresolved edits by row and inserts behind the last row, of the
        best conversation that is complete."""
        best = None
        for state, (cost, node) in self.alive.items():
            tail = _TAIL[state]
            cost += INSERT * len(tail)
            if best is None or cost < best[0] or (
                    cost == best[0] and _less(node, tail, best[1], best[2])):
                best = (cost, node, tail)
        return best[0], [n.edits for n in self._path(best[1])], best[2]

    def exits(self) -> list[tuple[int, int, str]]:
        """State, cost and unresolved edits of every survivor, in the edits' order."""
        ends = [(state, cost, "".join(n.edits for n in self._path(node)))
                for state, (cost, node) in self.alive.items()]
        return sorted(ends, key=lambda e: e[2])


class Writer:
    """Applies edits to rows and collects the repaired rows in chunks."""

    def __init__(self, state: int = _EMPTY):
        self.state, self.chunk, self.chars, self.audit = state, [], 0, []

    def _add(self, role: str, text: str) -> None:
        self.chunk.append({"role": role, "text": text})
        self.chars += len(text)

    def write(self, edits: str, row: tuple[str, str] | None) -> bool:
        """Apply the edits of a row; True if the chunk is full."""
        self.audit.append(edits)
        for edit in edits:
            if edit == "K":
                self.state = _KEEP[row[0][:1]][self.state]
                self._add(*row)
            elif edit != "D":
                self.state = _ANY[self.state]
                self._add(_ROLE[self.state], row[1] if edit == "R" else "")
        return len(self.audit) >= CHUNK_ROWS or self.chars >= CHUNK_CHARS

    def take(self) -> tuple[str, list[dict]]:
        out = "".join(self.audit), self.chunk
        self.chunk, self.chars, self.audit = [], 0, []
        return out


class _Counts:
    """Faults of the rows so far; ``seen`` holds the digests of the rows."""

    def __init__(self):
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first_turn = self.last_turn = self.first = self.last = None
        self.seen: set[bytes] = set()

    def add(self, turn, role, digest, blank, short) -> int:
        """Count a row and say what kind it is."""
        if turn is not None:
            if self.turns == 0:
                self.first_turn = turn
            self.turns += turn != self.last_turn
            self.last_turn = turn
        initial = role[:1]
        if self.first is None:
            self.first = initial
        elif self.last + initial not in _LEGAL:
            self.illegal += 1
        self.last = initial
        again = digest in self.seen
        self.seen.add(digest)
        if blank:
            self.blank += 1
            return _DOOMED
        if again:
            self.duplicate += 1
            return _DOOMED
        self.truncated += short
        return _SHORT if short else _SOUND

    def gaps(self) -> int:
        return self.last_turn - self.first_turn + 1 - self.turns if self.turns else 0


_SUMMARY = T.StructType([T.StructField(n, T.LongType()) for n in (
    "gaps", "blank", "duplicate", "truncated", "illegal", "cost")])


def _chunk_schema(conv: T.DataType) -> T.StructType:
    return (T.StructType().add("conv", conv).add("nth", T.LongType())
            .add("audit", T.StringType())
            .add("repaired", T.ArrayType(T.StructType().add("role", T.StringType())
                                         .add("text", T.StringType())))
            .add("summary", _SUMMARY))


_CHUNK_ARROW = (("nth", pa.int64()), ("audit", pa.string()),
                ("repaired", pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))),
                ("summary", pa.struct([(f.name, pa.int64()) for f in _SUMMARY])))


class _Out:
    """Chunk rows of a task."""

    def __init__(self, conv_type: pa.DataType):
        self.kind, self.rows, self.weight = conv_type, [], 0

    def add(self, conv, nth, audit, repaired, summary=None) -> None:
        self.rows.append((conv, nth, audit, repaired, summary))
        self.weight += 1 + sum(1 + len(r["text"]) // 64 for r in repaired)

    def full(self) -> bool:
        return self.weight > CHUNK_ROWS

    def batch(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows, strict=True)) or [()] * 5
        out = pa.RecordBatch.from_arrays(
            [pa.array(columns[0], self.kind), *[pa.array(c, kind) for c, (_, kind) in zip(
                columns[1:], _CHUNK_ARROW, strict=True)]],
            ["conv", *[name for name, _ in _CHUNK_ARROW]])
        self.rows, self.weight = [], 0
        return out


def _read(batch: pa.RecordBatch, *names: str) -> Iterator[tuple]:
    return zip(*[batch.column(n).to_pylist() for n in names], strict=True)


_NOTHING: Any = object()


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repair conversations that stream by in order, each of them whole."""
    conv, out = _NOTHING, None
    search = writer = counts = waiting = nth = None

    def give(edits: list[str]) -> None:
        nonlocal nth
        for e in edits:
            if writer.write(e, waiting.popleft()):
                out.add(conv, nth, *writer.take())
                nth += 1

    def close() -> None:
        cost, edits, tail = search.finish()
        give(edits)
        writer.write(tail, None)
        out.add(conv, nth, *writer.take(), {
            "gaps": counts.gaps(), "blank": counts.blank, "duplicate": counts.duplicate,
            "truncated": counts.truncated, "illegal": counts.illegal, "cost": cost})

    for batch in batches:
        out = out or _Out(batch.schema.field("conv").type)
        for c, turn, role, text, digest, blank, short in _read(
                batch, "conv", "turn", "role", "text", "digest", "blank", "short"):
            if c != conv:
                if conv is not _NOTHING:
                    close()
                conv, search, writer, counts, waiting, nth = c, Search(), Writer(), _Counts(), \
                    deque(), 0
            waiting.append((role, text))
            search.push(counts.add(turn, role, digest, blank, short), role[:1])
            if len(waiting) % _LOOK_EVERY == 0:
                give(search.resolved())
            if out.full():
                yield out.batch()
    if conv is not _NOTHING:
        close()
        yield out.batch()


# conversations in pieces

_PIECE = ("part int, exits array<struct<entry:int,state:int,cost:bigint,place:int,"
          "audit:string>>, blank bigint, duplicate bigint, truncated bigint, illegal bigint, "
          "turns bigint, first_turn bigint, last_turn bigint, first string, last string")


def _searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Search each piece from every state. Rows without a ``seq`` lead a piece:
    their digests were seen in an earlier one."""
    at: Any = _NOTHING
    searches = counts = done = None
    rows = 0
    schema = None

    def resolve() -> None:
        for i, s in enumerate(searches):
            done[i].extend(s.resolved())

    def closed() -> pa.RecordBatch:
        exits = []
        for i, s in enumerate(searches):
            known = "".join(done[i])
            for place, (state, cost, edits) in enumerate(s.exits()):
                exits.append({"entry": i, "state": state, "cost": cost, "place": place,
                              "audit": known + edits})
        c = counts
        return pa.RecordBatch.from_pylist([{
            "conv": at[0], "part": at[1], "exits": exits, "blank": c.blank,
            "duplicate": c.duplicate, "truncated": c.truncated, "illegal": c.illegal,
            "turns": c.turns, "first_turn": c.first_turn, "last_turn": c.last_turn,
            "first": c.first, "last": c.last}], schema)

    for batch in batches:
        schema = schema or pa.schema([
            ("conv", batch.schema.field("conv").type), ("part", pa.int32()),
            ("exits", pa.list_(pa.struct([("entry", pa.int32()), ("state", pa.int32()),
                                          ("cost", pa.int64()), ("place", pa.int32()),
                                          ("audit", pa.string())]))),
            *[(n, pa.int64()) for n in ("blank", "duplicate", "truncated", "illegal", "turns",
                                        "first_turn", "last_turn")],
            ("first", pa.string()), ("last", pa.string())])
        for c, part, seq, turn, role, digest, blank, short in _read(
                batch, "conv", "part", "seq", "turn", "role", "digest", "blank", "short"):
            if at is _NOTHING or (c, part) != at:
                if at is not _NOTHING:
                    yield closed()
                at, counts, rows = (c, part), _Counts(), 0
                searches = [Search(state) for state in _STATES]
                done = [[] for _ in _STATES]
            if seq is None:
                counts.seen.add(digest)
                continue
            kind = counts.add(turn, role, digest, blank, short)
            for s in searches:
                s.push(kind, role[:1])
            rows += 1
            if rows % _LOOK_EVERY == 0:
                resolve()
    if at is not _NOTHING:
        yield closed()


def joined_pieces(pieces: list[dict]) -> tuple[list[tuple[int, int]], str, dict]:
    """The state in which each of a conversation's pieces is entered and left, the
    inserts at the end, and the conversation's summary."""
    here, back = {_EMPTY: (0, 0)}, []     # state: cost and place in the edits' order
    total = dict.fromkeys(("gaps", "blank", "duplicate", "truncated", "illegal", "cost"), 0)
    turns, first_turn, last_turn, last = 0, None, None, None
    for piece in pieces:
        found: dict[int, tuple] = {}
        for e in piece["exits"]:
            if e["entry"] in here:
                cost, place = here[e["entry"]]
                now = (cost + e["cost"], place, e["place"], e["entry"])
                if e["state"] not in found or now < found[e["state"]]:
                    found[e["state"]] = now
        order = sorted(found, key=lambda s: found[s][1:3])
        back.append({s: found[s][3] for s in found})
        here = {s: (found[s][0], order.index(s)) for s in found}
        for name in ("blank", "duplicate", "truncated", "illegal"):
            total[name] += piece[name]
        if last is not None and last + piece["first"] not in _LEGAL:
            total["illegal"] += 1
        last = piece["last"]
        if piece["turns"]:
            turns += piece["turns"] - (piece["first_turn"] == last_turn)
            first_turn = piece["first_turn"] if first_turn is None else first_turn
            last_turn = piece["last_turn"]
    cost, _, state = min((here[s][0] + INSERT * len(_TAIL[s]), here[s][1], s) for s in here)
    total["cost"], total["gaps"] = cost, last_turn - first_turn + 1 - turns if turns else 0
    tail, path = _TAIL[state], []
    for before in reversed(back):
        path.append((before[state], state))
        state = before[state]
    return path[::-1], tail, total


def _written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Apply each piece's edits, which lead it in a row without ``seq``."""
    out, at = None, _NOTHING
    writer = edits = tail = summary = None
    nth = where = 0

    def close() -> None:
        if tail:
            writer.write(tail, None)
        out.add(at[0], nth, *writer.take(), summary)

    for batch in batches:
        out = out or _Out(batch.schema.field("conv").type)
        for c, part, seq, role, text, audit, entry, end, total in _read(
                batch, "conv", "part", "seq", "role", "text", "audit", "entry", "tail", "summary"):
            if seq is None:
                if at is not _NOTHING:
                    close()
                at, writer, edits, tail, summary = (c, part), Writer(entry), audit, end, total
                nth, where = part << 32, 0
                continue
            behind = where
            while edits[behind] == "I":
                behind += 1
            if writer.write(edits[where:behind + 1], (role, text)):
                out.add(c, nth, *writer.take())
                nth += 1
            where = behind + 1
            if out.full():
                yield out.batch()
    if at is not _NOTHING:
        close()
        yield out.batch()


def _repaired_pieces(rows: DataFrame, pieces: int) -> DataFrame:
    """Chunks of large conversations, in pieces dealt by ranges of their rows."""
    conv = rows.schema["conv"]
    order = ["conv", "turn", "digest", "place"]
    placed = settle(
        rows.repartitionByRange(pieces, *order).sortWithinPartitions(*order)
        .withColumn("part", F.spark_partition_id())
        .withColumn("seq", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)),
        "large-conversations")
    # Digests that an earlier piece has, a row for each piece that has them too.
    again = placed.select("conv", "digest", "part").distinct().groupBy("conv", "digest").agg(
        F.collect_set("part").alias("parts")).where(F.size("parts") > 1).select(
        "conv", "digest", F.explode(F.filter("parts", lambda p: p > F.array_min("parts")))
        .alias("part"))
    piece_schema = T.StructType([conv, *T.StructType.fromDDL(_PIECE).fields])
    dealt = placed.drop("text", "place").unionByName(again, allowMissingColumns=True).repartition(
        pieces, "conv", "part").sortWithinPartitions("conv", "part", F.col("seq").asc_nulls_first())
    found = settle(dealt.mapInArrow(_searched, piece_schema), "pieces")

    def joined(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["part"])
        path, tail, total = joined_pieces(rows)
        last = len(rows) - 1
        return pa.Table.from_pylist([{
            "conv": r["conv"], "part": r["part"], "entry": path[i][0], "state": path[i][1],
            "tail": tail if i == last else "", "summary": total if i == last else None}
            for i, r in enumerate(rows)], pa.schema([
                ("conv", table.schema.field("conv").type), ("part", pa.int32()),
                ("entry", pa.int32()), ("state", pa.int32()), ("tail", pa.string()),
                ("summary", pa.struct([(f.name, pa.int64()) for f in _SUMMARY]))]))

    # One row a piece, without its edits.
    slim = found.withColumn("exits", F.transform("exits", lambda e: e.dropFields("audit")))
    path = slim.groupBy("conv").applyInArrow(joined, T.StructType([conv]).add(
        "part", T.IntegerType()).add("entry", T.IntegerType()).add("state", T.IntegerType()).add(
        "tail", T.StringType()).add("summary", _SUMMARY))
    leads = path.alias("p").join(found.alias("f"), (
        F.col("p.conv").eqNullSafe(F.col("f.conv"))) & (F.col("p.part") == F.col("f.part"))).select(
        "p.conv", "p.part", "p.entry", "p.tail", "p.summary",
        F.filter("f.exits", lambda e: (e["entry"] == F.col("p.entry"))
                 & (e["state"] == F.col("p.state")))[0]["audit"].alias("audit"))
    dealt = placed.select("conv", "part", "seq", "role", "text").unionByName(
        leads, allowMissingColumns=True).repartition(pieces, "conv", "part").sortWithinPartitions(
        "conv", "part", F.col("seq").asc_nulls_first())
    return dealt.mapInArrow(_written, _chunk_schema(conv.dataType))


def repair_conversations(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                         role_col: str = "role", text_col: str = "text",
                         piece_rows: int = PIECE_ROWS) -> DataFrame:
    """The repaired conversations in chunks: ``conv``, ``nth`` (ascending along a
    conversation), ``audit`` (the initials of the edits: Delete, Insert, Keep,
    Rerole), ``repaired`` (an array of role and text) and, in the last chunk of a
    conversation, ``summary`` (gaps, blank, duplicate, truncated, illegal, cost).

    Rows are taken by turn, nulls first, those of one turn by a digest of role
    and text. A null role or text is one blank; a null conversation id is a
    conversation. Rows without a fault are kept for nothing, given the other role
    for 1, deleted for 2; blank rows and those whose role and text stood before
    must be deleted; a row that does not end in ``.``, ``!`` or ``?`` costs 5 more
    if it stays; an empty user or assistant row is inserted for 5. Among the
    cheapest edits the ASCII-least are taken. An empty table gives no chunks.

    A conversation of more than ``piece_rows`` rows is cut into pieces that tasks
    search on their own; no task holds more of a text than one row and what is
    unresolved.
    """
    role = F.coalesce(F.col(role_col).cast("string"), F.lit(" "))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(" "))
    body = F.rtrim(text, F.lit(BLANKS))
    shaped = rows.select(
        F.col(conv_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"),
        role.alias("role"), text.alias("text"),
        F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, F.lit(":"), text)
                      .cast("binary"))).alias("digest"),
        (body == "").alias("blank"), (~F.right(body, F.lit(1)).isin(".", "!", "?")).alias("short"))
    order = ["conv", "turn", "digest"]
    large = settle(rows.groupBy(F.col(conv_col).alias("conv")).agg(
        F.count(F.lit(1)).alias("rows")).where(F.col("rows") > piece_rows), "large")
    found = large.agg(F.sum("rows")).first()[0]
    small = shaped
    if found:
        small = shaped.alias("r").join(large.select("conv").alias("l"), F.col("r.conv").eqNullSafe(
            F.col("l.conv")), "left_anti")
    schema = _chunk_schema(shaped.schema["conv"].dataType)
    chunks = small.repartition("conv").sortWithinPartitions(*order).mapInArrow(_whole, schema)
    if found:
        big = shaped.alias("r").join(large.select("conv").alias("l"), F.col("r.conv").eqNullSafe(
            F.col("l.conv")), "left_semi").withColumn("place", F.monotonically_increasing_id())
        chunks = chunks.unionByName(_repaired_pieces(
            big, min(-(-found // piece_rows), _MOST_PIECES)))
    return settle(chunks, "repaired")


def repaired_rows(chunks: DataFrame) -> DataFrame:
    """One row for each repaired row: ``conv``, ``nth``, ``at`` (its place in the
    chunk), ``role``, ``text``."""
    return chunks.select("conv", "nth", F.posexplode("repaired").alias("at", "row")).select(
        "conv", "nth", "at", "row.role", "row.text")


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the chunks that stream by, conversation by conversation."""
    conv, digest, any_row, kind = _NOTHING, None, False, None

    def closed() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([conv], kind),
                                           pa.array([digest.hexdigest()])], ["conv", "sha256"])

    for batch in batches:
        kind = batch.schema.field("conv").type
        for c, rows, lines in _read(batch, "conv", "rows", "lines"):
            if c != conv:
                if conv is not _NOTHING:
                    yield closed()
                conv, digest, any_row = c, hashlib.sha256(), False
            if rows:
                digest.update((("\n" if any_row else "") + lines).encode())
                any_row = True
    if conv is not _NOTHING:
        yield closed()


def repair_report(chunks: DataFrame) -> DataFrame:
    """One row a conversation: ``conv``, the summary, ``audit`` and
    ``repaired_sha256`` of the ``role:text`` lines.

    The hash of a conversation of several chunks must be taken in their order;
    one task takes it, a chunk at a time.
    """
    lines = F.array_join(F.transform("repaired", lambda r: F.concat(
        r["role"], F.lit(":"), r["text"])), "\n")
    summary = [F.col(f"summary.{f.name}").alias(f.name) for f in _SUMMARY]
    single = (F.col("nth") == 0) & F.col("summary").isNotNull()
    short = chunks.where(single).select("conv", *summary, "audit",
                                        F.sha2(lines.cast("binary"), 256).alias("repaired_sha256"))
    long = chunks.where(~single)
    hashes = long.select("conv", "nth", F.size("repaired").alias("rows"), lines.alias("lines")) \
        .repartition("conv").sortWithinPartitions("conv", "nth").mapInArrow(
        _hashed, T.StructType([chunks.schema["conv"]]).add("sha256", T.StringType()))
    audits = long.groupBy("conv").agg(
        F.max("summary").alias("summary"), F.array_join(F.transform(F.array_sort(F.collect_list(
            F.struct("nth", "audit"))), lambda c: c["audit"]), "").alias("audit"))
    joined = audits.alias("a").join(hashes.alias("h"), F.col("a.conv").eqNullSafe(
        F.col("h.conv"))).select("a.conv", *summary, "a.audit",
                                 F.col("h.sha256").alias("repaired_sha256"))
    return short.unionByName(joined)


def damaged(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
            role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conv_id, turn, role, text`` with reproducible damage, by the CRC-32 of
    ``id:turn`` modulo 20: 0 drops a row, 1 empties its text, 2 takes ``.!?`` out of
    it, 3 repeats it, 4 makes its role user. Nulls are one blank in role, text
    and the hashed string."""
    def shown(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    hit = F.pmod(F.crc32(F.concat(shown(conv_col), F.lit(":"), shown(turn_col)).cast("binary")),
                 F.lit(20))
    text = shown(text_col)
    return rows.select(
        F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"),
        F.when(hit == 4, "user").otherwise(shown(role_col)).alias("role"),
        F.when(hit == 1, "").when(hit == 2, F.translate(text, ".!?", "")).otherwise(text)
        .alias("text"), hit.alias("hit")).where("hit <> 0").select(
        "conv_id", "turn", "role", "text",
        F.explode(F.sequence(F.lit(1), F.when(F.col("hit") == 3, 2).otherwise(1))).alias("copy")
    ).drop("copy")


def damage_and_repair(rows: DataFrame) -> DataFrame:
    """One row for each conversation of ``rows``, which are damaged and repaired;
    a conversation that lost all its rows has zeros and empty strings."""
    report = repair_report(repair_conversations(damaged(rows)))
    every = rows.select(F.col("conv_id")).distinct()
    empty = hashlib.sha256(b"").hexdigest()
    return every.join(report, every["conv_id"].eqNullSafe(report["conv"]), "left").select(
        "conv_id", *[F.coalesce(f.name, F.lit(0).cast("long")).alias(f.name) for f in _SUMMARY],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(empty)).alias("repaired_sha256"))
