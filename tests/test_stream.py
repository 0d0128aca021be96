import random

import pytest
from pyspark.sql import functions as F

from logweave.operators import committed_offsets, consumer_lag
from logweave.catalog import QUERIES
from logweave.plans import Pipeline
from logweave.sources import (append_in_order, committed_positions, lines_prepared,
                              printed_lines, read_committed, read_log, read_partition,
                              running_positions, stream_lag, stream_lines, stream_log,
                              stream_positions, stream_text_sink, text_sink, tokenize_lines,
                              write_log)
from logweave.streaming import Hop, run_stream, state_snapshot, window_state

from . import golden
from .replay import replay

TWO = Pipeline.of(
    "windowaggregate",
    ("rekey", {"fn": lambda k, v: F.substring(k, 1, 2)}),
    ("windowaggregate", {"size": 3, "slide": 2}))


class Feed:
    """A folder that receives parts of a log, and a stream over it."""

    def __init__(self, spark, log_of, tmp_path, pipeline, **options):
        self.spark, self.log_of, self.options = spark, log_of, options
        self.pipeline = pipeline
        self.source, self.out, self.checkpoint = (
            str(tmp_path / n) for n in ("in", "out", "checkpoint"))

    def add(self, rows):
        self.log_of(rows).coalesce(1).write.mode("append").parquet(self.source)

    def run(self, **more):
        source = stream_log(self.spark, self.source, stored=False,
                            maxFilesPerTrigger=1)
        run_stream(self.pipeline, source, self.out, self.checkpoint,
                   **{**self.options, **more}).awaitTermination()

    def rows(self):
        return sorted((list(r["ord"]), r["key"], r["value"])
                      for r in read_committed(self.spark, self.out).collect())


def batch_rows(df):
    return sorted((list(r["ord"]), r["key"], r["value"]) for r in df.collect())


def sample(count=200, seed=4):
    r = random.Random(seed)
    return [("hot" if r.random() < .5 else f"k{r.randrange(20)}", f"v{i}", i)
            for i in range(count)]


def test_golden_run(spark, log_of, tmp_path):
    feed = Feed(spark, log_of, tmp_path, Pipeline.of("windowaggregate", "map"))
    feed.add(golden.INPUT[:50])
    feed.add(golden.INPUT[50:])
    feed.run()
    assert [v for _, _, v in feed.rows()] == golden.VALUES


def test_restart_and_failures(spark, log_of, tmp_path):
    """Two windows; a failure after the output of one batch was written, a
    restart, and more input: as in batch, nothing missing or twice."""
    rows = sample()
    feed = Feed(spark, log_of, tmp_path, TWO)
    for at in range(0, 120, 60):
        feed.add(rows[at:at + 60])

    def fail(batch):
        raise RuntimeError("stopped on purpose")

    with pytest.raises(Exception, match="stopped on purpose"):
        feed.run(after_output=fail)
    feed.run()
    feed.add(rows[120:])
    feed.run()
    assert feed.rows() == batch_rows(TWO.run(log_of(rows)))


def test_split_keys_and_state(spark, log_of, tmp_path):
    """Large keys inside micro-batches; the state holds the last records."""
    rows = sample(240)
    pipe = Pipeline.of(("windowaggregate", {"size": 5, "slide": 3}))
    feed = Feed(spark, log_of, tmp_path, pipe, rows_per_span=6)
    for at in range(0, 240, 48):
        feed.add(rows[at:at + 48])
    feed.run()
    windows = replay([(k, v, [o]) for k, v, o in rows], 5, 3)
    assert feed.rows() == sorted(
        (list(o), k, "".join(w)) for (k, o), (w, _, _) in windows.items())

    latest = {k: w for (k, _), (w, _, _) in windows.items()}
    got = {r["key"]: list(r["window"])
           for r in state_snapshot(spark, pipe, feed.checkpoint, 1).collect()}
    assert got == latest
    state = {r["key"]: r for r in window_state(spark, feed.checkpoint, 1).collect()}
    counts = {k: sum(key == k for key, _, _ in rows) for k in latest}
    assert {k: r["n"] for k, r in state.items()} == counts
    assert all(len(r["last"]) == min(5, counts[k]) for k, r in state.items())
    with pytest.raises(ValueError, match="no window"):
        state_snapshot(spark, Pipeline.of("map"), feed.checkpoint, 1)


def test_keys_share_a_bucket_of_state(spark, log_of, tmp_path, monkeypatch):
    """Many keys take few calls of the stateful step; some keys come in every
    micro-batch, some in one."""
    monkeypatch.setattr("logweave.streaming.state.BUCKETS", 4)
    rows = [(f"k{i % 40 if i % 3 else i}", f"v{i}", i) for i in range(300)]
    pipe = Pipeline.of(("windowaggregate", {"size": 4, "slide": 3}))
    feed = Feed(spark, log_of, tmp_path, pipe)
    for at in range(0, 300, 100):
        feed.add(rows[at:at + 100])
    feed.run()
    assert feed.rows() == batch_rows(pipe.run(log_of(rows)))
    kept = {r["key"]: (r["n"], [(list(x["ord"]), x["value"]) for x in r["last"]])
            for r in window_state(spark, feed.checkpoint, 1).collect()}
    for key in {k for k, _, _ in rows}:
        own = [([o], v) for k, v, o in rows if k == key]
        assert kept.pop(key) == (len(own), own[-4:])
    assert not kept
    stored = spark.read.format("statestore").load(f"{feed.checkpoint}/stage=1").count()
    assert stored == 4


def test_state_of_a_failed_batch_is_rolled_back(spark, log_of, tmp_path):
    """A failure before any output: the repeated batch finds the state of the
    batch before it."""
    rows = sample(90)
    pipe = Pipeline.of("windowaggregate", ("map", {"fn": lambda k, v: F.when(
        v.contains("v40"), F.raise_error(F.lit("stopped on purpose"))).otherwise(v)}))
    feed = Feed(spark, log_of, tmp_path, pipe)
    feed.add(rows[:30])
    feed.add(rows[30:60])
    with pytest.raises(Exception, match="stopped on purpose"):
        feed.run()
    feed.pipeline = Pipeline.of("windowaggregate", ("map", {"fn": lambda k, v: v}))
    feed.run()
    feed.add(rows[60:])
    feed.run()
    assert feed.rows() == batch_rows(Pipeline.of("windowaggregate").run(log_of(rows)))


def test_session_keeps_its_settings(spark, log_of, tmp_path):
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    feed = Feed(spark, log_of, tmp_path, Pipeline.of("windowaggregate"))
    feed.add(golden.INPUT[:5])
    feed.run()
    assert spark.conf.get(name) == before
    assert list((tmp_path / "checkpoint/stage=1/state").glob("**/*.zip")) or list(
        (tmp_path / "checkpoint/stage=1/state").glob("**/*.changelog"))


def test_queries_side_by_side(spark, log_of, tmp_path):
    """Two windows with a trigger that goes on: two queries run until stopped."""
    import time
    rows = sample(80)
    feed = Feed(spark, log_of, tmp_path, TWO)
    feed.add(rows[:40])
    run = run_stream(TWO, stream_log(spark, feed.source, stored=False), feed.out,
                     feed.checkpoint, trigger={"processingTime": "200 milliseconds"})
    try:
        assert len(run.queries) == 2 and run.isActive
        feed.add(rows[40:])
        expected = batch_rows(TWO.run(log_of(rows)))
        for _ in range(300):
            if len(feed.rows()) == len(expected):
                break
            time.sleep(0.2)
    finally:
        run.stop()
    assert feed.rows() == expected and not run.isActive


def test_hop_is_a_log(spark, log_of, tmp_path):
    """Offsets go on over micro-batches, also where one fails and is repeated."""
    hop = str(tmp_path / "hop")
    rows = sample(150)
    feed = Feed(spark, log_of, tmp_path, Pipeline.of("windowaggregate", "map"),
                hops={1: Hop(hop, 4)}, rows_per_span=20)
    for at in range(0, 150, 50):
        feed.add(rows[at:at + 50])

    def fail(batch):
        if batch == 1:
            raise RuntimeError("stopped on purpose")

    with pytest.raises(Exception, match="stopped on purpose"):
        feed.run(after_output=fail)
    feed.run()
    log = read_log(spark, hop)
    found = log.collect()
    assert len(found) == 150
    for p in range(4):
        part = sorted((r["offset"], list(r["ord"])) for r in found if r["partition"] == p)
        assert [o for o, _ in part] == list(range(len(part)))
        assert [o for _, o in part] == sorted(o for _, o in part)
        assert read_partition(spark, hop, p).count() == len(part)
    lag = consumer_lag(log, committed_offsets(log.filter("offset < 3"))).collect()
    assert all(r["lag"] == r["end_offset"] - min(3, r["end_offset"]) for r in lag)
    # A further stream on it, pinned to a partition.
    out = str(tmp_path / "pinned")
    run_stream(Pipeline.of("map"), stream_positions(spark, hop, [2]).drop(
        "partition", "offset"), out, str(tmp_path / "c2")).awaitTermination()
    assert sorted(list(r["ord"]) for r in read_committed(spark, out).collect()) == sorted(
        list(r["ord"]) for r in found if r["partition"] == 2)


def test_positions_and_lag(spark, log_of, tmp_path):
    rows, path = sample(120), str(tmp_path / "log")
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "c")
    assert stream_lag(spark, path, {}).count() == 0

    def run():
        run_stream(Pipeline.of("map"), stream_positions(spark, path).drop(
            "partition", "offset"), out, checkpoint).awaitTermination()

    def lag():
        at = committed_positions(spark, f"{checkpoint}/to=1")
        return {r["partition"]: (r["end_offset"], r["lag"])
                for r in stream_lag(spark, path, at).collect()}

    write_log(log_of(rows[:50]), path, 3)
    assert sum(n for _, n in lag().values()) == 50
    run()
    assert sum(n for _, n in lag().values()) == 0
    write_log(log_of(rows[50:]), path, 3, mode="append")
    assert sum(n for _, n in lag().values()) == 70
    run()
    assert read_committed(spark, out).count() == 120
    run()                             # nothing new: no row twice
    assert read_committed(spark, out).count() == 120
    assert sum(e for e, _ in lag().values()) == 120


def test_positions_while_running(spark, log_of, tmp_path):
    import time
    path = str(tmp_path / "log")
    write_log(log_of(sample(40)), path, 2)
    run = run_stream(Pipeline.of("map"), stream_positions(spark, path).drop(
        "partition", "offset"), str(tmp_path / "out"), str(tmp_path / "c"),
        trigger={"processingTime": "100 milliseconds"})
    try:
        for _ in range(300):
            at = running_positions(run.queries[0])
            if sum(at.values()) == 40:
                break
            time.sleep(0.1)
        assert {r["lag"] for r in stream_lag(spark, path, at).collect()} == {0}
    finally:
        run.stop()


def test_stream_sink(spark, log_of, tmp_path):
    """As the batch sink prints it, with a micro-batch that fails between."""
    rows = sample(90)
    path, sink, checkpoint = (str(tmp_path / n) for n in ("log", "sink", "c"))
    for at in range(0, 90, 30):
        write_log(log_of(rows[at:at + 30]), path, 2, mode="append")
        log = stream_positions(spark, path)
        if at == 30:
            failing = log.withColumn("value", F.when(
                F.col("partition") == 1, F.raise_error(F.lit("stopped on purpose")))
                .otherwise(F.col("value")))
            with pytest.raises(Exception, match="stopped on purpose"):
                stream_text_sink(failing, sink, checkpoint).awaitTermination()
            assert printed_lines(spark, sink).count() == 31
        stream_text_sink(log, sink, checkpoint).awaitTermination()
    batch = str(tmp_path / "batch")
    text_sink(read_log(spark, path), batch)
    expected = sorted(r[0] for r in spark.read.text(
        [f"{batch}/header", f"{batch}/records"]).collect())
    assert sorted(r[0] for r in printed_lines(spark, sink).collect()) == expected
    # In name order a micro-batch's files follow the log.
    for folder in sorted((tmp_path / "sink/records").glob("batch=*")):
        lines = [line.split("\t")[:2] for file in sorted(folder.glob("part-*"))
                 for line in file.read_text().splitlines()]
        at = [(int(p.split()[1][:-1]), int(o.split()[1][:-1])) for p, o in lines]
        assert at == sorted(at)


def test_sink_commit_is_repeatable(spark, tmp_path):
    """A commit that comes again, or after it failed half-way, adds nothing."""
    from logweave.sources.text_stream import _Writer, _Written
    root = tmp_path / "sink"
    (root / "_pending").mkdir(parents=True)

    def written(task, text):
        file = root / f"_pending/{task}-{text}"
        file.write_text(f"{text}\n")
        return _Written(task, str(file))

    writer = _Writer(str(root))
    (root / "records/batch=0000000000").mkdir(parents=True)
    (root / "records/batch=0000000000/part-00007").write_text("half\n")
    writer.commit([written(0, "a"), None, written(2, "b"), _Written(3, None)], 0)
    writer.commit([written(0, "a"), written(2, "b")], 0)
    assert [r[0] for r in printed_lines(spark, str(root)).orderBy("line").collect()] == [
        "SINK RECORDS", "a", "b"]
    assert not list((root / "_pending").iterdir())


def test_late_record_fails(spark, log_of, tmp_path):
    feed = Feed(spark, log_of, tmp_path, Pipeline.of("windowaggregate"))
    feed.add([("a", "x", 5), ("b", "y", 6)])
    feed.run()
    feed.add([("a", "z", 4)])
    with pytest.raises(Exception, match="out of order"):
        feed.run()


def test_repeated_position_fails(spark, log_of, tmp_path):
    feed = Feed(spark, log_of, tmp_path, Pipeline.of("windowaggregate"))
    feed.add([("a", "x", 5)])
    feed.run()
    feed.add([("a", "z", 5)])
    with pytest.raises(Exception, match="position used twice"):
        feed.run()


def test_hops(spark, log_of, tmp_path):
    hop = str(tmp_path / "hop")
    feed = Feed(spark, log_of, tmp_path, Pipeline.of("windowaggregate", "map"),
                hops={1: hop})
    feed.add(golden.INPUT)
    feed.run()
    seen = read_committed(spark, hop).orderBy("ord").collect()
    assert [r["value"].upper() for r in seen] == golden.VALUES


def test_stateless_pipeline(spark, log_of, tmp_path):
    feed = Feed(spark, log_of, tmp_path, Pipeline.of("filter", "map"))
    feed.add(golden.INPUT[:60])
    feed.run()
    feed.add(golden.INPUT[60:])
    feed.run()
    assert len(feed.rows()) == golden.ODD


def test_rows_without_batches_are_refused(spark, log_of, tmp_path):
    log_of(golden.INPUT).write.parquet(str(tmp_path / "plain"))
    with pytest.raises(ValueError, match="not written in batches"):
        read_committed(spark, str(tmp_path / "plain"))


def test_nulls_are_counted_in_a_stream(spark, log_of, tmp_path):
    maybe = lambda k, v: F.when(v != "v2", v)
    pipe = Pipeline.of(("map", {"fn": maybe}), ("windowaggregate", {"size": 2, "slide": 1}))
    rows = [("a", f"v{i}", i) for i in range(6)]
    feed = Feed(spark, log_of, tmp_path, pipe)
    feed.add(rows[:3])
    feed.add(rows[3:])
    feed.run()
    assert [v for _, _, v in feed.rows()] == ["v0", "v0v1", "v1", "v3", "v3v4", "v4v5"]


def test_null_keys_fail(spark, log_of, tmp_path):
    pipe = Pipeline.of(("rekey", {"fn": lambda k, v: F.when(v != "v1", k)}), "windowaggregate")
    rows = [("a", f"v{i}", i) for i in range(3)]
    with pytest.raises(Exception, match="null key"):
        pipe.run(log_of(rows)).collect()
    feed = Feed(spark, log_of, tmp_path, pipe)
    feed.add(rows)
    with pytest.raises(Exception, match="null key"):
        feed.run()


def test_second_stream_sees_a_batch_once(spark, log_of, tmp_path):
    """A batch that failed after its output: the output stays as it is."""
    feed = Feed(spark, log_of, tmp_path, Pipeline.of("map"))
    feed.add(golden.INPUT[:9])

    def fail(batch):
        raise RuntimeError("stopped on purpose")

    with pytest.raises(Exception, match="stopped on purpose"):
        feed.run(after_output=fail)
    files = sorted(p.name for p in (tmp_path / "out").glob("batch=*/*.parquet"))
    feed.run()
    assert files == sorted(p.name for p in (tmp_path / "out").glob("batch=*/*.parquet"))
    assert len(feed.rows()) == 9


def test_snapshot_of_pairs(spark, log_of, tmp_path):
    pair = lambda k, w: (F.upper(k), F.array_join(w, ""))
    pipe = Pipeline.of(("windowaggregate", {"size": 2, "slide": 1, "fn": pair}))
    feed = Feed(spark, log_of, tmp_path, pipe)
    feed.add([("a", "x", 1), ("a", "y", 2), ("a", "z", 3)])
    feed.run()
    row = state_snapshot(spark, pipe, feed.checkpoint, 1).collect()[0]
    assert (row["key"], row["new_key"], row["value"]) == ("a", "A", "yz")


def test_text_stream(spark, tmp_path):
    (tmp_path / "text").mkdir()
    (tmp_path / "text/a.txt").write_text("a b c\nd e f\n")

    def to_log(lines):
        return tokenize_lines(lines).select(F.lit("k").alias("key"), "value",
                                            "ord")

    def run():
        run_stream(Pipeline.of("windowaggregate", "map"),
                   stream_lines(spark, str(tmp_path / "text")),
                   str(tmp_path / "out"), str(tmp_path / "checkpoint"),
                   prepare=lines_prepared(to_log)).awaitTermination()

    run()
    import time
    time.sleep(1.1)
    (tmp_path / "text/0.txt").write_text("g\n\nh")
    run()
    out = read_committed(spark, str(tmp_path / "out")).orderBy("ord").collect()
    assert [r["value"] for r in out] == [
        "A", "AB", "ABC", "BCD", "CDE", "DEF", "EFG", "FG", "GH"]


def test_nothing_committed_yet(spark, tmp_path):
    assert read_committed(spark, str(tmp_path / "none")).count() == 0


def test_console_and_other_sinks_take_the_stream(spark, log_of, tmp_path):
    log_of(golden.INPUT).write.parquet(str(tmp_path / "in"))
    stream = stream_log(spark, str(tmp_path / "in"), stored=False)
    query = (Pipeline.of("filter").run(stream).writeStream.format("memory")
             .queryName("seen").trigger(availableNow=True)
             .option("checkpointLocation", str(tmp_path / "c")).start())
    query.awaitTermination()
    assert spark.table("seen").count() == golden.ODD


@pytest.mark.parametrize("slide", [1, 2])
def test_sums_in_a_stream(spark, log_of, tmp_path, slide):
    from logweave.functions import total
    rows = [(k, v[1:], o) for k, v, o in sample(90)]
    pipe = Pipeline.of("flatmap", ("windowaggregate", {
        "size": 4, "slide": slide, "fn": total}))
    feed = Feed(spark, log_of, tmp_path, pipe, rows_per_span=15)
    feed.add(rows[:40])
    feed.add(rows[40:])
    feed.run()
    assert feed.rows() == batch_rows(pipe.run(log_of(rows)))


def test_batch_that_a_filter_empties(spark, log_of, tmp_path):
    pipe = Pipeline.of("filter", "windowaggregate", "map")
    feed = Feed(spark, log_of, tmp_path, pipe)
    feed.add([("Key1", "x", 1)])
    feed.add([("Key0", "a", 2), ("Key0", "b", 3)])
    feed.add([("Key1", "y", 4)])
    feed.add([("Key0", "c", 5)])
    feed.run()
    assert [v for _, _, v in feed.rows()] == ["A", "AB", "ABC"]


def test_files_in_order(spark, log_of, tmp_path):
    """Rows in any order, in many tasks, and keys that share their positions: each file
    holds what follows the file before it, and a stream can take one at a time."""
    rows = [(f"k{i % 5}", f"v{i}", i // 5) for i in range(400)]
    pipe = Pipeline.of(("windowaggregate", {"size": 4, "slide": 3}))
    feed = Feed(spark, log_of, tmp_path, pipe)
    for part in (rows[:300], rows[300:]):
        mixed = random.Random(2).sample(part, len(part))
        append_in_order(log_of(mixed).repartition(7), feed.source, rows_per_file=100)
    append_in_order(log_of([("k1", "last", 80)]), feed.source)
    files = sorted((tmp_path / "in").glob("*.parquet"), key=lambda f: f.stat().st_mtime_ns)
    held = [[(list(r["ord"]), r["key"]) for r in spark.read.parquet(str(f)).collect()]
            for f in files]
    assert len(files) == 3 + 1 + 1 and max(map(len, held)) < 200
    assert sum(map(sorted, held), []) == sorted(
        [([o], k) for k, _, o in rows] + [([80], "k1")])
    feed.run()
    assert feed.rows() == batch_rows(pipe.run(log_of(rows + [("k1", "last", 80)])))
    assert len(list((tmp_path / "out").glob("batch=*"))) == len(files)


def test_bounded_trigger_over_a_table_of_many_files(spark, log_of, tmp_path):
    """Rows of each key in every file of the table, in no order."""
    rows = random.Random(3).sample(range(240), 240)
    table = spark.createDataFrame([(i, i % 7, f"e{i}") for i in rows],
                                  "event_id long, user_id long, event_type string")
    table.repartition(4).write.parquet(str(tmp_path / "events.parquet"))
    out = QUERIES["stream_bounded_trigger"](spark, str(tmp_path))
    windows = replay([(str(i % 7), f"e{i}", [i]) for i in range(240)], 5, 3)
    assert sorted((r["seq"], r["key"], r["value"]) for r in out.collect()) == sorted(
        (o[0], k, "".join(w)) for (k, o), (w, _, _) in windows.items())


def test_files_of_one_age(spark, tmp_path):
    """Text files with equal times, one for each micro-batch."""
    import os
    (tmp_path / "text").mkdir()
    for name in "dbac":
        (tmp_path / f"text/{name}.txt").write_text(f"{name}1 {name}2\n")
        os.utime(tmp_path / f"text/{name}.txt", (1_700_000_000, 1_700_000_000))

    def to_log(lines):
        return tokenize_lines(lines).select(F.lit("k").alias("key"), "value", "ord")

    run_stream(Pipeline.of("windowaggregate"),
               stream_lines(spark, str(tmp_path / "text"), maxFilesPerTrigger=1),
               str(tmp_path / "out"), str(tmp_path / "checkpoint"),
               prepare=lines_prepared(to_log)).awaitTermination()
    out = read_committed(spark, str(tmp_path / "out")).orderBy("ord").collect()
    assert len(out) == 8 and {len(r["value"]) for r in out[2:]} == {6}
