"""Sharding, training order and the pipeline."""

import zlib
from collections import Counter

import numpy as np
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from logweave.llm import sharding, training_order
from logweave.llm.catalog import (
    PIECES,
    RANKS,
    op2_histogram_sort,
    op4_training_order,
    op8_sentencepiece,
)
from logweave.llm.sharding import shard_documents, splitters
from logweave.llm.toxicity import learn_lexicon
from logweave.storage import scratch_path

from .conftest import SMALL, unharmed


def test_op2(spark, documents):
    got = op2_histogram_sort(spark, SMALL).collect()
    texts = {r.doc_id: r.text.encode() for r in documents.collect()}
    assert len(got) == len(texts)
    sizes = Counter()
    for r in got:
        assert r.size == len(texts[r.doc_id]) + 1 and r.text_crc32 == zlib.crc32(texts[r.doc_id])
        sizes[r.shard] += r.size
    assert set(sizes) == set(range(8))
    assert max(sizes.values()) - min(sizes.values()) <= 2 * max(r.size for r in got)
    for s in range(8):
        rows = sorted(r.slot for r in got if r.shard == s)
        assert rows == list(range(len(rows)))


def test_op2_sorts_the_documents(spark, documents, monkeypatch):
    """Whole rows go through the operator; the digests are of its output."""
    sorted_columns = []

    def watched(rows, *args):
        sorted_columns.append(rows.columns)
        return histogram(rows, *args)

    histogram = sharding.histogram_shards
    monkeypatch.setattr(sharding, "histogram_shards", watched)
    op2_histogram_sort(spark, SMALL)
    assert sorted_columns == [documents.columns]


def test_hot_groups_and_repeated_rows(make, odd):
    rows = [(i % 7 if i % 3 else None, "the same text") for i in range(900)]
    rows += [(10_000 + i, f"text number {i}") for i in range(1500)] + odd[:5]
    got = shard_documents(make(rows), shards=4).collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter(rows)
    sizes = Counter()
    for r in got:
        sizes[r.shard] += len((r.text or "").encode()) + 1
    assert max(sizes.values()) - min(sizes.values()) < 0.05 * sum(sizes.values()) / 4
    for s in range(4):
        slots = sorted(r.slot for r in got if r.shard == s)
        assert slots == list(range(len(slots)))


def test_groups_stay_together(make):
    rows = [(i, f"copy of {i % 400}") for i in range(2000)]
    got = shard_documents(make(rows), shards=4).collect()
    spread = Counter(t for t, _ in {(r.text, r.shard) for r in got})
    assert sum(n > 1 for n in spread.values()) <= 3


def test_few_rows_and_odd_rows(make, odd):
    for rows in ([], [(1, "a")], odd):
        got = shard_documents(make(rows)).collect()
        assert len(got) == len(rows) and unharmed(got)
        for s in range(8):
            slots = sorted(r.slot for r in got if r.shard == s)
            assert slots == list(range(len(slots)))
    assert shard_documents(make([(1, "a")])).columns[-2:] == ["shard", "slot"]


def test_splitters_count_exactly(spark):
    rng = np.random.default_rng(9)
    rows = [(int(g), int(r), int(s)) for g, r, s in zip(
        rng.integers(0, 1 << 60, 3000), rng.integers(0, 1 << 60, 3000),
        rng.integers(1, 900, 3000), strict=True)]
    rows += [(5 << 50, r, 40) for r in range(0, 1 << 60, 1 << 50)]
    total = sum(s for *_, s in rows)
    cuts = splitters(spark.createDataFrame(rows, "_g long, _r long, _size long"), 5, 0.001)
    for i, (g, r) in enumerate(cuts, 1):
        below = sum(s for a, b, s in rows if (a, b) < (g, r))
        assert abs(below - total * i / 5) <= max(0.001 * total / 5, 900)


def test_parts_of_shards_follow_the_splitters(spark, make, monkeypatch):
    """Within a shard the exchange's parts are of like size, and no rows are sampled:
    the plan has the given partitions, not ranges."""
    rows = [(i, f"text {i} " * (1 + i % 40)) for i in range(3000)]
    plans = []
    settle = sharding.settle
    monkeypatch.setattr(sharding, "settle", lambda df, *a, **k: plans.append(
        df._jdf.queryExecution().executedPlan().toString()) or settle(df, *a, **k))
    shard_documents(make(rows), shards=2).count()
    assert "rangepartitioning" not in plans[1] and "Exchange" in plans[1]
    keys = spark.createDataFrame([(i * (1 << 48), i, 1) for i in range(4000)],
                                 "_g long, _r long, _size long")
    cuts = splitters(keys, 16, 0.001, within=8)
    edges = [0, *[sum(i * (1 << 48) < g for i in range(4000)) for g, _ in cuts], 4000]
    sizes = np.diff(edges)
    assert abs(edges[8] - 2000) <= 2 and sizes.min() > 125 and sizes.max() < 375


@pytest.mark.parametrize("domain", [1, 2, 3, 10, 64, 1000, 4097])
def test_permutation(domain):
    got = training_order.permuted(np.arange(domain), domain, 5)
    assert sorted(got.tolist()) == list(range(domain))
    if domain > 100:
        assert (got != training_order.permuted(np.arange(domain), domain, 6)).mean() > 0.9
        assert abs(np.corrcoef(np.arange(domain), got)[0, 1]) < 0.2


def test_training_order_round_trip(spark, make, odd):
    rows = odd + [(100 + i, f"text {i} " * (i % 50)) for i in range(200)]
    folder = scratch_path(spark, "order")
    docs = make(rows).repartition(3).persist()
    manifest = training_order.write_training_order(docs, folder, RANKS, length=16, shards=7)
    table = sorted(manifest.collect(), key=lambda r: r.slot)
    assert [r.slot for r in table] == list(range(len(table)))
    assert len({r.shard for r in table}) == 7
    assert all(r.byte_offset % 32 == 0 for r in table)
    got = {r.slot: r.ids for r in training_order.read_sequences(
        spark, folder, manifest, 0, len(table), length=16).collect()}
    for r in table:
        assert zlib.crc32(np.array(got[r.slot], np.uint16).tobytes()) == r.crc32
    stream = [x for r in sorted(table, key=lambda r: (r.part, r.nth))
              for x in got[r.slot][:r.n_tokens]]
    ranks = training_order.read_ranks(RANKS)
    encoding = tiktoken.Encoding("t", pat_str=training_order.PATTERN, mergeable_ranks=ranks,
                                 special_tokens={})
    texts, held = Counter(), []
    for x in stream:
        if x == len(ranks):
            texts[encoding.decode(held)] += 1
            held = []
        else:
            held.append(x)
    assert not held and texts == Counter(t for _, t in rows if t is not None)
    some = training_order.read_sequences(spark, folder, manifest, 5, 9, length=16).collect()
    assert sorted(r.slot for r in some) == list(range(5, 14))
    assert all(r.ids == got[r.slot] for r in some)
    docs.unpersist()


def test_order_is_the_keys(spark, make):
    rows = make([(i, f"text {i} " * 9) for i in range(60)]).coalesce(1)
    order = [[(r.part, r.nth) for r in sorted(training_order.write_training_order(
        rows, scratch_path(spark, "order"), RANKS, length=8, key=key, shards=3).collect(),
        key=lambda r: r.slot)] for key in (1, 1, 2)]
    assert order[0] == order[1] != order[2] and sorted(order[0]) == sorted(order[2])


def test_nothing_to_write(spark, make):
    folder = scratch_path(spark, "order")
    assert training_order.write_training_order(make([]), folder, RANKS).count() == 0
    assert training_order.write_training_order(make([(1, None)]), folder, RANKS).count() == 0


def test_op4(spark):
    got = op4_training_order(spark, SMALL)
    assert got.agg(F.max("slot")).first()[0] == got.count() - 1


def test_pipeline_odd_rows(spark, make, odd):
    """Every stage but the last keeps clashing columns and clean odd rows; an empty
    table goes through."""
    docs = make(odd).drop("removed_spans")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        path = scratch_path(spark, f"odd-{name}")
        stage(spark, docs, SMALL).write.parquet(path)
        after = spark.read.parquet(path)
        rows = after.collect()
        assert after.columns == docs.columns and unharmed(rows) and rows, name
        assert {r.doc_id for r in rows} >= {1, 3, 4, 5, 6, 9, 10}
        docs = after
        assert stage(spark, docs.limit(0), SMALL).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).count() >= len(rows)


def test_pipeline(spark, documents):
    """Every stage on its own input, and the columns it returns."""
    docs, folder = documents, SMALL
    for name, stage in corpus_pipeline.STAGES[:-1]:
        path = scratch_path(spark, f"test-{name}")
        stage(spark, docs, folder).write.parquet(path)
        after = spark.read.parquet(path)
        assert after.columns == documents.columns
        before, ids = docs.count(), after.select("doc_id").distinct().count()
        assert ids == after.count() and 0.5 * before < ids <= before
        docs = after
    last = corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect()
    assert {r.doc_id for r in last} == {r.doc_id for r in docs.collect()}
    again = corpus_pipeline.run(spark, folder).collect()
    key = lambda r: (r.doc_id, r.chunk)
    assert sorted(again, key=key) == sorted(last, key=key)
    assert PIECES


@pytest.mark.parametrize("name", ["pipeline", "op8"])
def test_one_python_worker_a_task(spark, documents, name):
    """The last stage doesn't encode and decode in one task."""
    got = corpus_pipeline.STAGES[-1][1](spark, documents, SMALL) if name == "pipeline" \
        else op8_sentencepiece(spark, SMALL)
    assert got._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1


def test_lexicon_without_python_rows(spark, documents, monkeypatch):
    """Beginnings of words become a table without Python workers of their own."""
    plans, create = [], type(spark).createDataFrame

    def noted(self, *args, **kwargs):
        df = create(self, *args, **kwargs)
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return df
    monkeypatch.setattr(type(spark), "createDataFrame", noted)
    lexicon = learn_lexicon(documents, spark.read.parquet(f"{SMALL}/labels.parquet"))
    assert lexicon.weights and plans
    assert not [p for p in plans if "ExistingRDD" in p]
