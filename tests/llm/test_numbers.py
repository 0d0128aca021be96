"""Whitening, mixing and conversation repair: against brute force."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from logweave.llm import conversation_repair as repair
from logweave.llm import mixing, whitening
from logweave.llm.catalog import op11_whitening, op12_mixing, op13_conversation_repair

from .conftest import SMALL

# --- whitening


def brute_whitening(vectors):
    """Whitened vectors, eigenvalue shares and deviations by the library's solver."""
    x = np.floor(64 * np.array(vectors, float)).astype(np.int64) + whitening.OFFSET
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    centred = fit - sums / n
    v = centred.T @ centred / n
    e, u = np.linalg.eigh(v)
    order = np.argsort(-e)[:16]
    far = [int(((n * row.astype(object) - sums.astype(object)) ** 2).sum()) for row in x]
    return n, (x - sums / n) @ u[:, order] / np.sqrt(e[order]), e[order] / np.trace(v), far


def test_op11(spark):
    rows = spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()
    n, z, shares, far = brute_whitening([r.embedding for r in rows])
    got = defaultdict(dict)
    for r in op11_whitening(spark, SMALL).collect():
        got[r.vec_id][r.component] = r
    assert len(got) == len(rows)
    signs = np.sign([got[rows[0].vec_id][k + 1].whitened * z[0, k] for k in range(16)])
    for i, row in enumerate(rows):
        mine = [got[row.vec_id][k + 1] for k in range(16)]
        assert np.allclose([m.whitened for m in mine], z[i] * signs, atol=1e-8)
        assert {m.deviation for m in mine} == {far[i]} and {m.n for m in mine} == {n}
    one = [got[rows[0].vec_id][k + 1] for k in range(16)]
    assert np.allclose([m.explained for m in one], shares, rtol=1e-9)
    assert {m.identity_error for m in one} and one[0].identity_error < 1e-9


def test_polynomial_is_exact(spark):
    """Coefficients against exact sums of principal minors of a small matrix, with a
    zero row, so that pivots are zero."""
    a = np.array([[4, 2, 0, 1], [2, 9, 0, 3], [0, 0, 0, 0], [1, 3, 0, 5]], object)
    c = whitening.characteristic_polynomial(spark, a)
    # x^4 - 18 x^3 + 87 x^2 - 112 x: traces and minors by hand.
    minors2 = (4 * 9 - 4) + (4 * 5 - 1) + (9 * 5 - 9)
    det3 = 4 * (45 - 9) - 2 * (10 - 3) + 1 * (6 - 9)
    assert c == [0, -det3, minors2, -18, 1]


def test_roots_with_multiplicity():
    """(x - 3)^2 (x - 7) x, and neighbours that differ by one in 10**12."""
    roots = whitening.largest_roots([0, -63, 51, -13, 1], 16)
    assert [m for _, m in roots] == [1, 2]
    assert roots[0][0] == 7 << 64 and abs(roots[1][0] / (3 << 64) - 1) < 2 ** -55
    big = 10 ** 12
    pair = [big * (big + 1), -(2 * big + 1), 1]
    assert [r >> 64 for r, _ in whitening.largest_roots(pair, 2)] == [big + 1, big]


def test_equal_eigenvalues(spark):
    """A cross: the covariance is a multiple of the identity in two dimensions."""
    rows = [(i, [float(x), float(y), 0.0]) for i, (x, y) in enumerate(
        [(1, 0), (-1, 0), (0, 1), (0, -1)])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = whitening.whiten(df).collect()
    z = np.array([r.whitened for r in got])
    assert z.shape == (4, 2)               # the third has no variance
    assert np.allclose(z.T @ z / 4, np.eye(2)) and got[0].identity_error < 1e-12


def test_limbs_are_exact():
    generator = np.random.default_rng(5)
    y = generator.integers(-(1 << 49), 1 << 49, (300, 3))
    held = whitening._Scatter(3)
    held.add(y[:100])
    held.add(y[100:])
    wide = y.astype(object)
    assert held.sums == wide.sum(axis=0).tolist()
    for i in range(3):
        assert held.products(i) == (wide.T @ wide)[i, :i + 1].tolist()


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, 1.0]), (2, [0.5, 1.0]), (3, None), (4, [nan, 1.0]), (5, [inf, 1.0]),
            (6, [None, 1.0]), (None, [2.0, -1.0]), (8, [1.0, 3.0]), (9, [1.0]), (10, [4.0]),
            (11, []), (12, [1e300, 1.0])]
    df = spark.createDataFrame([(*r, 7, "x", 0.5) for r in rows],
                               "vec_id long, embedding array<double>, n int, entries string, "
                               "deviation double")
    out = whitening.whiten(df)
    assert out.columns == ["vec_id", "embedding", "entries", "n", "deviation", "whitened",
                           "explained", "identity_error"]
    got = {r.vec_id: r for r in out.collect()}
    assert set(got) == {1, 2, None, 8, 9, 10, 11, 12} and got[1].entries == "x"
    assert got[1].n == 4 and got[1].whitened == got[2].whitened
    assert got[9].n == 2 and len(got[9].whitened) == 1 and got[11].whitened == []
    assert abs(abs(got[9].whitened[0]) - 1) < 1e-12
    assert whitening.whiten(df.limit(0)).count() == 0
    single = whitening.whiten(df.where("vec_id = 1")).collect()[0]
    assert single.whitened == [] and single.n == 1 and single.deviation == 0


# --- mixing


def water(sizes, weights, total, most=3):
    """Targets by resharing the excess, one source after the other."""
    capped, left = {}, dict(weights)
    while True:
        rest = total - sum(capped.values())
        share = {s: rest * w / sum(left.values()) for s, w in left.items()}
        over = [s for s in left if share[s] > most * sizes[s]]
        if not over:
            return capped | share
        for s in over:
            capped[s] = most * sizes[s]
            del left[s]
        if not left:
            return capped


def test_op12(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    got = {r.doc_id: r for r in op12_mixing(spark, SMALL).collect()}
    size = {d.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", d.text or "")) for d in docs}
    sources = sorted({d.source for d in docs})
    total = sum(size.values())
    sizes = {s: sum(size[d.doc_id] for d in docs if d.source == s) for s in sources}
    goal = water(sizes, {s: (5, 2, 1)[i % 3] for i, s in enumerate(sources)}, total)
    longest = max(size.values())
    for s in sources:
        mine = [got[d.doc_id] for d in docs if d.source == s]
        assert all(abs(r.target - goal[s]) < 1e-6 and r.source_size == sizes[s] for r in mine)
        assert abs(sum(r.taken for r in mine) - goal[s]) <= longest / 2
    assert all(r.size == size[i] and r.taken in range(0, 3 * r.size + 1) for i, r in got.items())
    # Smaller budgets are inside of larger ones.
    assert all(r.taken_quarter <= r.taken_half <= r.taken for r in got.values())
    again = {r.doc_id: r for r in op12_mixing(spark, SMALL).collect()}
    assert got == again


def test_caps_are_reshared(spark):
    """A heavy source too small for its share, an empty one, a null one."""
    rows = [(i, "w " * n, s) for i, (n, s) in enumerate(
        [(10, "a")] * 3 + [(7, "b")] * 60 + [(5, "c")] * 40 + [(0, "d")] * 2 + [(9, None)] * 20)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix_sources(df, budgets=(0.5, 1.0)).collect()
    sizes = {"a": 30, "b": 420, "c": 200, "d": 0, None: 180}
    goal = water(sizes, {"a": 5, "b": 2, "c": 1, "d": 5, None: 2}, 830)
    for s in sizes:
        mine = [r for r in got if r.source == s]
        assert all(abs(r.target - goal[s]) < 1e-9 for r in mine)
        assert abs(sum(r.taken for r in mine) - goal[s]) <= 5
        assert abs(sum(r.taken_by_budget[0] for r in mine) - water(
            sizes, {"a": 5, "b": 2, "c": 1, "d": 5, None: 2}, 415)[s]) <= 5
    assert all(r.copies <= 3 for r in got) and {r.copies for r in got if r.source == "a"} == {3}
    repeated = mixing.repeated(mixing.mix_sources(df, budgets=(0.5, 1.0)))
    assert repeated.count() == sum(r.copies for r in got)


def test_mixing_odd_rows(spark, make, odd, monkeypatch):
    """Copies of one row beyond the hash, nulls, clashing names; also by the join
    that many sources take."""
    rows = [(3, "one two three", None)] * 200 + odd
    df = make(rows).withColumns({n: F.lit("x") for n in (
        "_size", "_source", "_none", "_h", "_r", "_row", "_plan", "taken", "target", "Copies")})
    first = mixing.mix_sources(df, weights=(1,), budgets=(0.25,))
    assert first.columns[-6:] == ["size", "source_size", "target", "copies", "taken",
                                  "taken_by_budget"]
    got = first.collect()
    assert len(got) == len(rows) and {r._size for r in got} == {"x"}
    taken, size = sum(r.taken for r in got), max(r.size for r in got)
    assert abs(taken - got[0].target) <= size / 2
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 0)
    order = lambda rows: sorted(map(repr, rows))
    assert order(mixing.mix_sources(df, weights=(1,), budgets=(0.25,)).collect()) == order(got)
    assert mixing.mix_sources(df.limit(0)).count() == 0
    equal = [(3, "one two three", None)] * 200
    some = mixing.mix_sources(make(equal), weights=(1,), budgets=(0.25,)).collect()
    assert abs(sum(r.taken for r in some) - 150) <= 3
    with pytest.raises(ValueError, match="ascend"):
        mixing.mix_sources(df, budgets=(1.0, 0.5))


def test_mixing_is_native(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    plan = mixing.mix_sources(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Sort" not in plan


# --- conversations

_NEXT = {0: 2, 1: 2, 2: 3, 3: 2}
_KEPT = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}


def brute_repair(rows):
    """All edits with up to two inserts before each row, the cheapest, then least."""
    counts = dict(gaps=0, blank=0, duplicate=0, truncated=0, illegal=0)
    turns = [t for t, _, _ in rows if t is not None]
    if turns:
        counts["gaps"] = max(turns) - min(turns) + 1 - len(set(turns))
    seen, ways, last = set(), [(0, "", 0, ())], None
    for _, role, text in rows:
        if last is not None and last + role[:1] not in ("su", "ua", "au"):
            counts["illegal"] += 1
        last = role[:1]
        body = text.strip(repair.BLANKS)
        fault = ("blank" if not body else "duplicate" if (role, text) in seen else
                 "truncated" if body[-1] not in ".!?" else None)
        seen.add((role, text))
        if fault:
            counts[fault] += 1
        more = 5 if fault == "truncated" else 0
        new = []
        for cost, audit, state, out in ways:
            for _ in range(3):
                new.append((cost + 2, audit + "D", state, out))
                if fault in (None, "truncated"):
                    to = _NEXT[state]
                    new.append((cost + 1 + more, audit + "R", to,
                                (*out, f"{'user' if to == 2 else 'assistant'}:{text}")))
                    if (role[:1], state) in _KEPT:
                        new.append((cost + more, audit + "K", _KEPT[role[:1], state],
                                    (*out, f"{role}:{text}")))
                state = _NEXT[state]
                cost, audit = cost + 5, audit + "I"
                out = (*out, f"{'user' if state == 2 else 'assistant'}:")
        least = min(c for c, *_ in new)
        ways = [w for w in new if w[0] <= least + 10]
    ends = []
    for cost, audit, state, out in ways:
        while state not in (0, 3):
            state = _NEXT[state]
            cost, audit = cost + 5, audit + "I"
            out = (*out, f"{'user' if state == 2 else 'assistant'}:")
        ends.append((cost, audit, out))
    cost, audit, out = min(ends)
    return counts | dict(cost=cost, audit=audit, repaired_sha256=hashlib.sha256(
        "\n".join(out).encode()).hexdigest())


def some_rows(generator, n):
    return [(generator.choice([None, 1, 2, 3, 5]),
             generator.choice(["user", "assistant", "system", "tool", ""]),
             generator.choice(["a.", "b.", "c", "", "d!", "e? ", " \t", "ü…"])) for _ in range(n)]


def in_order(rows):
    def digest(role, text):
        return hashlib.md5(f"{len(role)}:{role}:{text}".encode()).digest()
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, digest(r[1], r[2])))


@pytest.mark.parametrize("piece_rows", [4096, 2])
def test_repair_against_brute_force(spark, piece_rows):
    """Conversations whole and in pieces of about two rows."""
    generator = random.Random(3)
    given = {c: some_rows(generator, generator.randint(1, 6)) for c in [*range(60), None]}
    df = spark.createDataFrame([(c, *r) for c, rows in given.items() for r in rows],
                               "conv_id long, turn long, role string, text string")
    chunks = repair.repair_conversations(df, piece_rows=piece_rows)
    got = {r.conv: r.asDict() for r in repair.repair_report(chunks).collect()}
    assert len(got) == len(given)
    for c, rows in given.items():
        expected = brute_repair(in_order(rows))
        assert {k: got[c][k] for k in expected} == expected, rows
    again = defaultdict(list)
    for r in repair.repaired_rows(chunks).orderBy("nth", "at").collect():
        again[r.conv].append(f"{r.role}:{r.text}")
    for c in given:
        assert hashlib.sha256("\n".join(again[c]).encode()).hexdigest() == \
            got[c]["repaired_sha256"]


def test_op13(spark):
    given, ids = defaultdict(list), set()
    for r in spark.read.parquet(f"{SMALL}/conversations.parquet").collect():
        ids.add(r.conv_id)
        hit = zlib.crc32(f"{r.conv_id}:{r.turn}".encode()) % 20
        text = {1: "", 2: re.sub("[.!?]", "", r.text)}.get(hit, r.text)
        if hit:
            given[r.conv_id] += [(r.turn, "user" if hit == 4 else r.role, text)] * (1 + (hit == 3))
    got = {r.conv_id: r.asDict() for r in op13_conversation_repair(spark, SMALL).collect()}
    assert set(got) == ids
    for c in ids:
        expected = brute_repair(in_order(given[c]))
        assert {k: got[c][k] for k in expected} == expected


def test_search_holds_what_is_unresolved():
    """A long conversation: little of it is ever held."""
    search, held = repair.Search(), 0
    for i in range(20_000):
        search.push(0, "ua"[i % 2])
        if i % 16 == 15:
            search.resolved()
            longest = max(len(search._path(node)) for _, node in search.alive.values())
            held = max(held, longest)
    assert held <= 40 and search.finish()[0] == 0


def test_repair_odd_rows(spark):
    empty = hashlib.sha256(b"").hexdigest()
    dropped = next(i for i in range(1000) if zlib.crc32(f"{i}:1".encode()) % 20 == 0)
    sound = next(i for i in range(1000) if zlib.crc32(f"{i}:1".encode()) % 20 == 7)
    long = "word " * 300_000 + "end."
    rows = [(dropped, 1, "user", "a."), (sound, 1, "user", long), (sound, 1, "user", long),
            (None, None, None, None), (-1, None, "assistant", "b.")]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows],
                               "conv_id long, turn long, role string, text string, "
                               "digest int, conv string")
    got = {r.conv_id: r for r in repair.damage_and_repair(df).collect()}
    assert set(got) == {dropped, sound, None, -1}
    assert (got[dropped].audit, got[dropped].repaired_sha256, got[dropped].cost) == ("", empty, 0)
    assert got[sound].duplicate == 1 and got[sound].audit in ("DKI", "KDI", "DD")
    assert got[None].blank == 1 and got[None].audit == "D" and got[None].gaps == 0
    assert repair.damage_and_repair(df.limit(0)).count() == 0


def test_giant_conversation(spark):
    """One conversation with most rows: many pieces, each in a task of its own."""
    rows = [(1, i, "user" if i % 2 == 0 else "assistant", f"row {i}.") for i in range(9000)]
    rows += [(2, 0, "user", "a."), (2, 1, "assistant", "b.")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv: r for r in repair.repair_report(repair.repair_conversations(
        df, piece_rows=1000)).collect()}
    assert got[1].audit == "K" * 9000 and got[1].cost == 0 and got[1].gaps == 0
    assert got[1].repaired_sha256 == hashlib.sha256("\n".join(
        f"{r}:{t}" for _, _, r, t in rows[:9000]).encode()).hexdigest()
    assert got[2].audit == "KK"
