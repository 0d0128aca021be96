"""N-gram join, embedding links, components: against brute force."""

import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from logweave.llm import ngram_join as join
from logweave.llm import textual
from logweave.llm.catalog import ORACLE, QUERIES, op1_ngram_jaccard_join, op7_embedding_dedup
from logweave.llm.components import components
from logweave.llm.embedding_dedup import embedding_dedup

from .conftest import SMALL


def groups(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in links:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {n: find(n) for n in nodes}


def brute(texts, threshold=0.8):
    sets = {}
    for i, t in texts.items():
        w = re.findall(r"\w+", (t or "").lower())
        sets[i] = {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) > 4 else (
            {tuple(w)} if w else set())
    by = defaultdict(list)
    for i, s in sets.items():
        for g in s:
            by[g].append(i)
    common = Counter((a, b) for ids in by.values() for a in ids for b in ids if a < b)
    links = [(a, b) for (a, b), n in common.items()
             if n >= threshold * (len(sets[a]) + len(sets[b]) - n)]
    count = Counter(x for link in links for x in link)
    return {i: count[i] for i in sets}, groups(sets, links)


def test_op1_is_brute_force(spark, documents):
    texts = {r.doc_id: r.text for r in documents.collect()}
    links, group = brute(texts)
    got = op1_ngram_jaccard_join(spark, SMALL).collect()
    assert len(got) == len(texts) and sum(links.values()) > 0
    for r in got:
        assert (r.n_links, r.group_id) == (links[r.doc_id], group[r.doc_id])
        assert r.kept == (r.doc_id == r.group_id)


def test_near_copies_beyond_a_node(spark, make):
    """A group of near copies that no node takes as pairs: blocks and tiles."""
    rng = np.random.default_rng(3)
    base = [f"w{k}" for k in range(120)]
    texts = {}
    for i in range(190):
        words = list(base)
        for k in rng.choice(120, rng.integers(0, 4), replace=False):
            words[k] = f"n{i}x{k}"
        texts[i] = " ".join(words)
    texts |= {1000 + i: texts[i] for i in range(40)}
    links, group = brute(texts)
    got = join.ngram_join(make(list(texts.items()))).collect()
    off = [r for r in got if r.n_links != links[r.doc_id] or r.group_id != group[r.doc_id]]
    # The recall of a pair at the threshold is 0.998 or more.
    assert sum(abs(r.n_links - links[r.doc_id]) for r in off) <= 0.002 * sum(links.values())
    assert all(r.n_links <= links[r.doc_id] for r in got)


def test_join_odd_rows(make, odd):
    got = join.ngram_join(make(odd)).collect()
    assert len(got) == len(odd)
    story = [r for r in got if r.class_id == 1]
    assert len(story) == 4 and {r.n_links for r in story} == {3}
    assert sum(r.kept for r in story) == 1
    assert all(r.n_links == 0 and r.kept for r in got if r.doc_id in (3, 4, 5, 6))
    pair = [r for r in got if r.doc_id in (7, 8)]
    assert [(r.n_links, r.group_id) for r in pair] == [(1, 7)] * 2
    kept = join.keep_representatives(make(odd))
    assert kept.columns == make(odd).columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id) == [1, 3, 4, 5, 6, 7, 9, 10]
    assert join.ngram_join(make([])).count() == 0


def test_depth():
    assert join.start_depth(0.8, 16, 0.9995) == 4
    assert join.start_depth(0.8, 16, 0.99) == 5
    assert join.start_depth(0.01, 2, 0.99) == 1


def test_words_over_slices(monkeypatch):
    text = "Alpha beta, gamma-delta 42! " * 50
    whole = textual.words_of([text, None, "", "end"])
    monkeypatch.setattr(textual, "SLICE", 64)
    cut = textual.words_of([text, None, "", "end"])
    for a, b in zip(whole, cut, strict=True):
        assert (a == b).all()
    assert [text[s:e] for s, e in zip(whole.starts[:5], whole.ends[:5], strict=True)] == [
        "Alpha", "beta", "gamma", "delta", "42"]


def test_components(spark):
    rng = np.random.default_rng(1)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 300, (170, 2))]
    links += [(i, i + 1) for i in range(1000, 1060)] + [(2000, i) for i in range(2001, 2050)]
    apart = [link for link in links if link[0] != link[1]]
    nodes = {x for link in apart for x in link}
    want = groups(nodes, apart)
    got = components(spark.createDataFrame(links, "a long, b long").repartition(7)).collect()
    assert {r.node: r.component for r in got} == want and len(got) == len(want)


@pytest.mark.parametrize("cells", [1, 5])
def test_embedding_links(spark, cells):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(12, 16))
    rows = []
    for i in range(240):
        v = centres[i % 12] + rng.normal(size=16) * 0.2
        rows.append((i, [float(x) for x in v.astype(np.float32)], i % 2))
    rows += [(300, rows[0][1], 0), (301, rows[0][1], 1), (302, rows[0][1], None),
             (303, None, 0), (304, [0.0] * 16, 0), (305, [float("nan")] * 16, 0),
             (306, [None] + [1.0] * 15, 0), (307, rows[0][1][:8], 0), (308, [], 0),
             (0, rows[0][1], 0), (None, rows[0][1], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    df = df.selectExpr("*", "1 AS class", "2 AS cell", "3 AS kept")
    good = [(k, i, np.array(v, np.float32).astype(float), g) for k, (i, v, g) in enumerate(rows)
            if g is not None and v and len(v) == 16 and None not in v and np.isfinite(v).all()
            and any(v)]
    links = [(a, b) for x, (a, _, u, g) in enumerate(good) for b, _, v, h in good[x + 1:]
             if g == h and u @ v / np.sqrt((u @ u) * (v @ v)) >= 0.93]
    count = Counter(x for link in links for x in link)
    group = groups(range(len(rows)), links)
    got = embedding_dedup(df, cells=cells).collect()
    smallest = {}
    for k, (i, _, _) in enumerate(rows):
        if i is not None:
            smallest[group[k]] = min(i, smallest.get(group[k], i))
    want = Counter((i, count[k], smallest.get(group[k], i)) for k, (i, _, _) in enumerate(rows))
    assert Counter((r.vec_id, r.n_links, r.component_id) for r in got) == want
    assert embedding_dedup(df.limit(0)).count() == 0


def test_op7(spark):
    got = op7_embedding_dedup(spark, SMALL)
    assert got.count() == spark.read.parquet(f"{SMALL}/embeddings.parquet").count()
    assert {"vec_id", "n_links", "component_id", "kept"} <= set(got.columns)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql(spark, name):
    duck = duckdb.connect()
    for t in ("documents", "embeddings"):
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    want = duck.execute(ORACLE[name]).fetchall()
    columns = [d[0] for d in duck.description]
    got = QUERIES[name](spark, SMALL).select(*columns).collect()
    assert sorted(map(tuple, got)) == sorted(want)
