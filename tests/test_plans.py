import pytest
from pyspark.sql import functions as F

from logweave.operators import count_window, window_snapshot
from logweave.plans import FUNCTIONS, Pipeline, register
from logweave.plans.stages import Stage

from . import golden

SAMPLE = """
#Thu Jun 04
pipeline.length=2
function.at.1=windowaggregate
processors.at.1=2
function.at.2=map
processors.at.2=1
replication.factor=2
"""


def values(df):
    return [r["value"] for r in df.orderBy("ord").collect()]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_properties(log_of):
    pipe = Pipeline.from_properties(SAMPLE)
    assert [s.workers for s in pipe.stages] == [2, 1]
    assert values(pipe.run(log_of(golden.INPUT))) == golden.VALUES


@pytest.mark.parametrize("workers", [True, False])
@pytest.mark.parametrize("rows_per_span", [None, 8])
def test_same_result_however_spread(log_of, workers, rows_per_span):
    out = Pipeline.from_properties(SAMPLE).run(
        log_of(golden.INPUT), rows_per_span, use_workers=workers)
    assert values(out) == golden.VALUES


@pytest.mark.parametrize("text", [
    "pipeline.length=0", "", "pipeline.length=x",
    "pipeline.length=1\nfunction.at.1=join\nprocessors.at.1=1",
    "pipeline.length=2\nfunction.at.1=map\nprocessors.at.1=1",
    "pipeline.length=1\nfunction.at.1=map",
    "pipeline.length=1\nfunction.at.1=map\nprocessors.at.1=0"])
def test_bad_definitions(text):
    with pytest.raises(ValueError):
        Pipeline.from_properties(text)


def test_bad_window_is_refused_when_built():
    with pytest.raises(ValueError):
        Pipeline.of(("windowaggregate", {"size": 2, "slide": 4}))
    with pytest.raises(ValueError):
        Pipeline(())


def test_own_stage(log_of):
    name = "exclaim"
    if name not in FUNCTIONS:
        register(name, lambda workers=None: Stage(
            name, lambda log: log.withColumn(
                "value", F.concat("value", F.lit("!"))), True, workers))
    with pytest.raises(ValueError):
        register("map", lambda: None)
    out = Pipeline.of(name, "map").run(log_of([("a", "x", 1)]))
    assert values(out) == ["X!"]


def test_all_four_stages(log_of):
    pipe = Pipeline.of("filter", "flatmap", "windowaggregate", "map")
    out = pipe.run(log_of([("Key0", "abc", 1), ("Key1", "no", 2),
                           ("Key0", "de", 3)]))
    assert values(out) == ["A", "AB", "ABC", "BCD", "CDE"]


def test_hop_is_a_stored_log(log_of, tmp_path):
    pipe = Pipeline.from_properties(SAMPLE)
    hop = pipe.materialize(log_of(golden.INPUT), 1, str(tmp_path / "hop"))
    assert {r["partition"] for r in hop.collect()} == {0}
    assert [v.upper() for v in values(hop)] == golden.VALUES
    assert values(Pipeline.of("map").run(hop)) == golden.VALUES


def test_second_window_on_the_same_key_adds_no_shuffle(log_of):
    pipe = Pipeline.of("windowaggregate", "map", "windowaggregate")
    plan = plan_of(pipe.run(log_of(golden.INPUT), split_large_keys=False))
    assert plan.count("Exchange") == 1


def test_stateless_stages_do_not_shuffle(log_of):
    plan = plan_of(Pipeline.of("filter", "flatmap", "map").run(
        log_of(golden.INPUT)))
    assert "Exchange" not in plan


def test_key_filter_moves_below_the_window(spark, tmp_path):
    path = str(tmp_path / "log")
    spark.range(10).selectExpr("cast(id % 3 as string) key", "'v' value",
                               "array(id) ord").write.parquet(path)
    out = count_window(spark.read.parquet(path), 3, 2).filter("key = '1'")
    assert "EqualTo(key,1)" in plan_of(out).split("PushedFilters")[1]


def test_snapshot_prunes_before_its_shuffle(log_of):
    plan = plan_of(window_snapshot(log_of(golden.INPUT), 3, 1))
    assert "Partial" in plan.split("WindowGroupLimit")[2]


def test_unread_window_columns_are_not_computed(log_of):
    plan = plan_of(count_window(log_of(golden.INPUT), 3, 1).select(
        "key", "n"))
    assert "collect_list" not in plan


def test_counting_the_keys_of_a_window_needs_no_window(log_of):
    out = Pipeline.of("windowaggregate", ("rekey", {
        "fn": lambda k, v: F.substring(k, 1, 1)})).run(
        log_of(golden.INPUT), split_large_keys=False)
    plan = plan_of(out.groupBy("key").count())
    assert "Window" not in plan and plan.count("Exchange") == 1


def test_values_between_stages_are_strings(log_of):
    from logweave.functions import count, total
    pipe = Pipeline.of(("windowaggregate", {"fn": count}),
                       ("windowaggregate", {"fn": total, "size": 2}),
                       "windowaggregate")
    out = pipe.run(log_of([("a", "x", 1), ("a", "y", 2), ("a", "z", 3)]))
    assert dict(out.dtypes)["value"] == "string"
    assert values(out) == ["1.0", "1.03.0", "1.03.05.0"]  # 1, 1+2, 2+3


def test_stream_with_windows_needs_the_runner(spark, log_of, tmp_path):
    from logweave.sources import stream_log
    log_of(golden.INPUT).write.parquet(str(tmp_path / "in"))
    stream = stream_log(spark, str(tmp_path / "in"), stored=False)
    with pytest.raises(ValueError):
        Pipeline.of("windowaggregate").run(stream)


def test_sliding_sum_builds_no_array(log_of):
    from logweave.functions import total
    from logweave.operators import window_aggregate
    assert "collect_list" not in plan_of(window_aggregate(
        log_of(golden.INPUT), 3, 1, total))


def test_workers_of_split_keys_and_stateless_stages(log_of):
    """Configured counts bound the tasks, whether keys are split or not."""
    rows = [("hot" if i % 3 else f"k{i % 7}", f"v{i}", i) for i in range(120)]
    pipe = Pipeline.of(("windowaggregate", {"size": 4, "slide": 3, "workers": 3}),
                       ("map", {"workers": 2}))
    plain = Pipeline.of(("windowaggregate", {"size": 4, "slide": 3}), "map")
    expected = sorted(map(tuple, plain.run(log_of(rows)).select(
        "key", "value", F.get("ord", F.lit(0))).collect()))
    for limit in (None, 20):
        out = pipe.run(log_of(rows), rows_per_span=limit, use_workers=True)
        assert "Coalesce 2" in out._jdf.queryExecution().executedPlan().toString()
        assert ", 3), REPARTITION_BY_NUM" in out._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(tuple, out.select("key", "value", F.get("ord", F.lit(0)))
                          .collect())) == expected


def test_workers_take_a_bounded_number_of_rows(log_of):
    """More rows than the workers sort at a time: keys in rounds, each in as many tasks
    as there are workers, with the rows and types of one round."""
    rows = [(f"k{i % 37}", f"v{i}", i) for i in range(500)]
    pipe = Pipeline.of(("windowaggregate", {"size": 4, "slide": 3, "workers": 2}), "map")
    once = pipe.run(log_of(rows), use_workers=True)
    many = pipe.run(log_of(rows), use_workers=True, rows_per_worker=50)
    assert "REPARTITION_BY_NUM" in once._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in many._jdf.queryExecution().executedPlan().toString()
    shown = lambda df: sorted(map(tuple, df.select(
        "key", "value", F.get("ord", F.lit(0))).collect()))
    assert shown(many) == shown(once) and many.dtypes == once.dtypes
    assert pipe.run(log_of(rows[:0]), use_workers=True, rows_per_worker=50).count() == 0
    rounds = {p.rpartition("/round=")[2].split("/")[0] for p in many.inputFiles()}
    assert rounds == {"0", "1", "2", "3", "4"}


def test_properties_syntax():
    from logweave.plans.pipeline import parse_properties
    text = """
        # a comment
      ! another
    pipeline.length = 2
    function.at.1:filter
    function.at.2 window\\
        aggregate
    path=a\\=b\\ c\\u0041\\\\
    a\\:b : c=d
    empty
    """
    assert parse_properties(text) == {
        "pipeline.length": "2", "function.at.1": "filter", "function.at.2": "windowaggregate",
        "path": "a=b cA\\", "a:b": "c=d", "empty": ""}
