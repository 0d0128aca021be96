import random

import pytest
from pyspark.sql import functions as F

from logweave.functions import AGGREGATES
from logweave.operators import (count_window, plan_spans, window_aggregate,
                                window_snapshot)
from logweave.operators.spans import WHOLE, SpanPlan, edges_of
from logweave.operators.window import window_length
from logweave.plans import Pipeline

from . import golden
from .replay import collected, replay

SETTINGS = [(1, 1), (1, 2), (3, 1), (3, 2), (3, 3), (3, 4), (5, 3), (4, 5)]


def skewed(seed, rows=400, share=0.5):
    """Rows of which one key holds ``share``, with positions of one or two
    parts and gaps between them."""
    r = random.Random(seed)
    out, at = [], 0
    for i in range(rows):
        at += r.choice([0, 0, 1, 7])
        key = "hot" if r.random() < share else f"k{r.randrange(12)}"
        out.append((key, f"v{i}", [at, i]))
    r.shuffle(out)
    return out


def test_golden_run(log_of):
    out = Pipeline.of("windowaggregate", "map").run(log_of(golden.INPUT))
    got = [r["value"] for r in out.orderBy("ord").collect()]
    assert got == golden.VALUES
    assert len(got) == 126


@pytest.mark.parametrize("size,slide,expected", [
    (3, 2, [1, 2, 3, 2, 3, 2, 3, 2]),
    (3, 3, [1, 2, 3, 1, 2, 3, 1, 2]),
    (3, 4, [1, 2, 3, 0, 1, 2, 3, 0])])
def test_lengths(spark, size, slide, expected):
    rows = spark.range(1, 9).select(window_length(F.col("id"), size, slide)
                                    .alias("l"), "id").orderBy("id").collect()
    assert [r["l"] for r in rows] == expected


@pytest.mark.parametrize("size,slide", SETTINGS)
def test_against_replay(log_of, size, slide):
    rows = skewed(size * 10 + slide)
    assert collected(count_window(log_of(rows), size, slide)) == \
        replay(rows, size, slide)


@pytest.mark.parametrize("size,slide", SETTINGS + [(40, 1), (40, 17)])
@pytest.mark.parametrize("rows_per_span", [9, 60])
def test_split_keys_against_replay(log_of, size, slide, rows_per_span):
    rows = skewed(size + slide)
    spans = plan_spans(log_of(rows), "key", rows_per_span)
    assert spans
    assert collected(count_window(spans.rows, size, slide, spans)) == \
        replay(rows, size, slide)


@pytest.mark.parametrize("size,slide", [(3, 1), (5, 3), (30, 7)])
def test_any_cut_gives_the_same_result(log_of, size, slide):
    rows = skewed(3)
    positions = sorted(o for k, _, o in rows if k == "hot")
    cuts = random.Random(size).sample(positions, 40) + positions[:3]
    span = sum((F.col("ord") >= F.array(*[F.lit(p).cast("bigint") for p in cut]))
               .cast("int") for cut in cuts)
    split = log_of(rows).withColumn("span", F.when(
        F.col("key") == "hot", span * 3).otherwise(WHOLE))
    spans = SpanPlan("key", split, edges_of(split.filter("span >= 0"), "key"))
    assert collected(count_window(split, size, slide, spans)) == \
        replay(rows, size, slide)


def test_many_large_keys(log_of):
    rows = skewed(8)
    spans = plan_spans(log_of(rows), "key", 12)
    assert spans.edges.select("key").distinct().count() > 2
    assert collected(count_window(spans.rows, 4, 3, spans)) == replay(rows, 4, 3)


def test_large_keys_are_cut_where_they_are(log_of):
    """Positions that the first number parts: no large key's rows are written again."""
    rows = [("hot" if i % 4 else f"k{i % 8}", f"v{i}", [i * i]) for i in range(160)]
    spans = plan_spans(log_of(rows), "key", 24)
    sizes = spans.rows.filter(F.col("span") != WHOLE).groupBy("key", "span").count().collect()
    assert len(sizes) >= 5 and max(r["count"] for r in sizes) <= 24
    assert not any("/spans-" in name for name in spans.rows.inputFiles())
    assert collected(count_window(spans.rows, 4, 3, spans)) == replay(rows, 4, 3)


def test_few_ranges_are_cut_into_spans(log_of, monkeypatch):
    """A span never has more rows than asked for, however few the ranges."""
    monkeypatch.setattr("logweave.operators.spans._RANGES", 2)
    rows = skewed(8)
    spans = plan_spans(log_of(rows), "key", 10)
    sizes = spans.rows.filter(F.col("span") != WHOLE).groupBy("key", "span").count()
    assert sizes.count() > 8 and sizes.agg(F.max("count")).first()[0] <= 10
    assert collected(count_window(spans.rows, 3, 2, spans)) == replay(rows, 3, 2)


def test_context_of_a_span_meets_by_place(log_of):
    """No window runs over all last rows of a large key."""
    spans = plan_spans(log_of(skewed(8)), "key", 10)
    plan = count_window(spans.rows, 3, 2, spans)._jdf.queryExecution() \
        .optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert windows and all("span#" in line for line in windows)


def test_small_keys_are_not_split(log_of):
    spans = plan_spans(log_of(skewed(1)), "key", 10_000)
    assert not spans


def test_result_does_not_depend_on_partitions(spark, log_of):
    rows = skewed(9)
    results = []
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in (1, 2, 8):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            results.append(collected(count_window(log_of(rows), 3, 2)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert results[0] == results[1] == results[2] == replay(rows, 3, 2)


@pytest.mark.parametrize("size,slide", [(3, 0), (3, 5), (0, 1), (3, -1)])
def test_bad_settings(log_of, size, slide):
    with pytest.raises(ValueError):
        count_window(log_of([("a", "b", 1)]), size, slide)


@pytest.mark.parametrize("slide", [1, 2])
def test_position_used_twice_fails(log_of, slide):
    log = log_of([("a", "x", 1), ("a", "y", 1)])
    with pytest.raises(Exception, match="position used twice"):
        window_aggregate(log, 3, slide).collect()


def test_aggregates(log_of):
    log = log_of([("a", str(v), i) for i, v in enumerate([5, 1, 4, 2])])
    expected = {"concat": ["5", "51", "514", "142"], "count": [1, 2, 3, 3],
                "sum": [5, 6, 10, 7], "max": [5, 5, 5, 4], "min": [5, 1, 1, 1]}
    for name, values in expected.items():
        out = window_aggregate(log, 3, 1, AGGREGATES[name]).orderBy("ord")
        assert [r["value"] for r in out.collect()] == values


def test_empty_window_concat(log_of):
    log = log_of([("a", c, i) for i, c in enumerate("wxyz")])
    out = window_aggregate(log, 3, 4).orderBy("ord").collect()
    assert [r["value"] for r in out] == ["w", "wx", "wxy", ""]


def test_aggregate_may_change_the_key(log_of):
    log = log_of([("a", "x", 1), ("a", "y", 2)])
    out = window_aggregate(
        log, 3, 1, lambda k, w: (F.concat(k, F.lit("!")), F.size(w)))
    assert [tuple(r) for r in out.orderBy("ord").collect()] == [
        ("a!", 1, [1]), ("a!", 2, [2])]


def test_python_aggregate(log_of):
    import pandas as pd

    @F.pandas_udf("string")
    def backwards(windows: pd.Series) -> pd.Series:
        return windows.map(lambda w: "".join(reversed(list(w))))

    log = log_of([("a", c, i) for i, c in enumerate("abcd")])
    out = window_aggregate(log, 3, 1, lambda k, w: backwards(w)).orderBy("ord")
    assert [r["value"] for r in out.collect()] == ["a", "ba", "cba", "dcb"]


@pytest.mark.parametrize("size,slide", SETTINGS + [(1200, 1), (1200, 700)])
def test_snapshot(log_of, size, slide):
    rows = skewed(5)
    expected = {}
    for (key, order), (window, _, _) in sorted(
            replay(rows, size, slide).items(), key=lambda e: e[0][1]):
        expected[key] = window
    got = {r["key"]: list(r["window"])
           for r in window_snapshot(log_of(rows), size, slide).collect()}
    assert got == expected


@pytest.mark.parametrize("rows_per_span", [None, 10])
@pytest.mark.parametrize("slide", [1, 2])
@pytest.mark.parametrize("name", ["sum", "max", "min", "count"])
def test_numbers_against_replay(log_of, name, slide, rows_per_span):
    python = {"sum": lambda w: sum(map(float, w)), "count": len,
              "max": lambda w: max(map(float, w)),
              "min": lambda w: min(map(float, w))}[name]
    rows = [(k, v[1:], o) for k, v, o in skewed(2, 120)]
    spans = plan_spans(log_of(rows), "key", rows_per_span)
    out = window_aggregate(spans.rows, 4, slide, AGGREGATES[name], spans)
    assert {(r["key"], tuple(r["ord"])): r["value"] for r in out.collect()} == {
        at: python(w) for at, (w, _, _) in replay(rows, 4, slide).items()}


def test_nulls_are_counted(log_of, spark):
    from logweave.schema import LOG_SCHEMA
    rows = [("k", v, [i]) for i, v in enumerate(["a", "b", None, "c", "d"])]
    log = spark.createDataFrame(rows, "key string, value string, ord array<bigint>")
    assert LOG_SCHEMA.names == log.columns
    got = {r["ord"][0]: list(r["window"]) for r in count_window(log, 3, 2).collect()}
    assert got == {0: ["a"], 1: ["a", "b"], 2: ["a", "b", None], 3: [None, "c"],
                   4: [None, "c", "d"]}


@pytest.mark.parametrize("column", ["window", "evicted", "prior"])
def test_repeated_position_fails_in_every_column(log_of, column):
    log = log_of([("k", "a", 1), ("k", "b", 1), ("k", "c", 2)])
    with pytest.raises(Exception, match="position used twice"):
        count_window(log, 2, 1).select(column).collect()


def test_repeated_position_fails_in_snapshot_and_offsets(log_of):
    from logweave.operators import assign_offset, assign_partition, window_snapshot
    log = log_of([("k", "a", 1), ("k", "b", 1), ("k", "c", 2)])
    with pytest.raises(Exception, match="position used twice"):
        window_snapshot(log, 3, 1).collect()
    with pytest.raises(Exception, match="position used twice"):
        assign_offset(assign_partition(log, 2)).collect()


@pytest.mark.parametrize("size,slide,rows_per_span", [
    (1, 1, None), (3, 2, 11), (3, 4, None), (3, 4, 11), (5, 3, None), (7, 2, 11), (10, 3, None),
    (12, 4, 11)])
def test_windows_from_blocks(log_of, monkeypatch, size, slide, rows_per_span):
    """Running aggregates of blocks against a replay: sums, extremes, counts, and
    one whose order matters; whole and split keys."""
    from logweave.functions import Parts, count, maximum, total
    from logweave.operators import window
    monkeypatch.setattr(window, "BLOCKS_FROM", 1)

    def opening(key, values):
        raise AssertionError("no array is needed")

    opening.parts = Parts(F.first, lambda a, b: a, lambda v: F.concat(F.lit("from "), v),
                          back=F.last)
    rows = [(k, str(i * 37 % 101), o) for i, (k, _, o) in enumerate(skewed(size + slide, 150))]
    log = log_of(rows)
    spans = plan_spans(log, "key", rows_per_span)
    if rows_per_span:
        log = spans.rows
    held = {(k, o): w for (k, o), (w, _, _) in replay(rows, size, slide).items()}
    for fn, expected in ((total, lambda w: float(sum(map(int, w)))), (count, len),
                         (maximum, lambda w: float(max(map(int, w))) if w else None),
                         (opening, lambda w: f"from {w[0]}" if w else None)):
        got = {(r["key"], tuple(r["ord"])): r["value"] for r in window_aggregate(
            log, size, slide, fn, spans).collect()}
        assert got == {at: expected(w) for at, w in held.items()}, fn


def test_wide_windows_build_no_arrays(log_of):
    from logweave.functions import total
    plan = window_aggregate(log_of(skewed(1)), 1000, 7, total)._jdf.queryExecution() \
        .executedPlan().toString()
    assert "collect_list" not in plan and plan.count("Exchange") == 1


def test_large_groups(spark):
    """Groups above a limit, with buckets that hold several; no row a key is
    shuffled."""
    from logweave.operators.spans import large_groups
    rows = spark.range(200_000).select(F.when(F.col("id") % 10 == 0, "hot").when(
        F.col("id") % 100 == 1, "warm").otherwise(F.col("id").cast("string")).alias("key"))
    found = {r["key"]: r["rows"] for r in large_groups(rows, "key", 1500).collect()}
    assert found == {"hot": 20_000, "warm": 2000}
    assert large_groups(rows, "key", 20_000) is None
    assert large_groups(rows.limit(0), "key", 1) is None


def test_cost_is_seen_in_the_plan_not_in_names(spark):
    from logweave.operators.spans import costly
    rows = spark.range(5).select(F.col("id").alias("Join Window Aggregate"))
    assert not costly(rows) and not costly(rows.filter("`Join Window Aggregate` > 1"))
    assert costly(rows.distinct()) and not costly(rows.distinct().cache())
    assert costly(rows.select(F.explode(F.array(F.lit(1)))))
    assert costly(rows.mapInArrow(lambda batches: batches, rows.schema))


def test_spans_by_bytes(log_of):
    """A few rows of 20 kB beside many short ones: no span is above the limit, and
    the windows are the same."""
    from logweave.functions import count
    rows = [("hot", "x" * 20_000 if i % 3 == 0 else f"v{i}", [i]) for i in range(600)]
    rows += [("cold", "y", [i]) for i in range(100)]
    log, limit = log_of(rows), 400_000
    plan = plan_spans(log, "key", 100_000, limit)
    assert plan and not plan_spans(log, "key", 100_000)
    split = plan.rows.filter(F.col("span") != WHOLE)
    sizes = split.groupBy("span").agg(F.sum(F.octet_length("value")).alias("bytes")).collect()
    assert len(sizes) >= 10 and max(r["bytes"] for r in sizes) <= limit
    assert split.select("key").distinct().collect()[0]["key"] == "hot"
    expected = {(k, o): len(w) for (k, o), (w, _, _) in replay(rows, 5, 3).items()}
    assert {(r["key"], tuple(r["ord"])): r["value"] for r in window_aggregate(
        plan.rows, 5, 3, count, plan).collect()} == expected
    piped = Pipeline.of(("windowaggregate", {"size": 5, "slide": 3, "fn": count})).run(
        log, bytes_per_span=limit)
    assert {(r["key"], tuple(r["ord"])): int(r["value"]) for r in piped.collect()} == expected
