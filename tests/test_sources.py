import random

import pytest

from pyspark.sql import functions as F

from logweave.operators import (assign_offset, assign_partition, catch_up,
                                committed_offsets, consumer_lag,
                                format_sink_record, plan_spans,
                                window_aggregate)
from logweave.sources import (log_from_topic, observe_stage, read_lines,
                              read_log, read_partition, text_sink,
                              tokenize_lines, tokenize_text, write_log)

from . import golden
from .replay import replay

# Blank lines, tabs, blanks in a row and at the end of a line.
PROSE = "Snow fell\ton the pass.\n\nTwo mules  went up, \none came back   \n\n\n at dusk"


def test_words_of_a_text_file(spark, tmp_path):
    path = tmp_path / "in.txt"
    path.write_text(PROSE)
    out = tokenize_lines(read_lines(spark, str(path))).orderBy("ord").collect()
    assert [r["value"] for r in out] == [
        "Snow", "fell", "on", "the", "pass.", "", "Two", "mules", "", "went", "up,",
        "one", "came", "back", "", "", "", "at", "dusk"]


def test_lines_keep_file_order_over_many_splits(spark, tmp_path):
    words = [f"w{i}" for i in range(5000)]
    path = tmp_path / "long.txt"
    path.write_text("\n".join(words))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2048")
    try:
        lines = read_lines(spark, str(path))
        assert lines.rdd.getNumPartitions() > 4
        out = lines.orderBy("ord").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [r["line"] for r in out] == words


def test_words_of_a_column(spark):
    df = spark.createDataFrame(
        [(7, "a b\n\n c"), (8, ""), (9, None)], "id long, text string")
    out = tokenize_text(df, "text", "id", keep=["id"]).orderBy("ord").collect()
    assert [(r["id"], r["value"], list(r["ord"])) for r in out] == [
        (7, "a", [7, 0, 0]), (7, "b", [7, 0, 1]), (7, "", [7, 1, 0]),
        (7, "", [7, 2, 0]), (7, "c", [7, 2, 1])]


def numbered(rows, n):
    """Expected (partition, offset) per position."""
    from .test_strings import expected_hash
    seen, out = {}, {}
    for k, v, o in sorted(rows, key=lambda r: r[2]):
        p = expected_hash(k) % n
        out[o] = (p, seen.get(p, 0))
        seen[p] = seen.get(p, 0) + 1
    return out


def stored(df):
    return {r["ord"][0]: (r["partition"], r["offset"]) for r in df.collect()}


def keyed(count, seed=1):
    r = random.Random(seed)
    return [(f"k{r.randrange(9)}" if r.random() < .5 else "hot", f"v{i}", i)
            for i in range(count)]


def test_offsets_are_dense(log_of):
    rows = keyed(300)
    placed = assign_partition(log_of(rows), 4)
    assert stored(assign_offset(placed)) == numbered(rows, 4)


def test_offsets_of_split_partitions(log_of):
    rows = keyed(300)
    spans = plan_spans(assign_partition(log_of(rows), 4), "partition", 20)
    assert spans
    assert stored(assign_offset(spans.rows, spans)) == numbered(rows, 4)


def test_log_round_trip(spark, log_of, tmp_path):
    rows = keyed(200)
    path = str(tmp_path / "log")
    write_log(log_of(rows), path, 4, rows_per_span=30)
    log = read_log(spark, path)
    assert stored(log) == numbered(rows, 4)
    parts = [read_partition(spark, path, p) for p in range(4)]
    assert sum(p.count() for p in parts) == 200
    plan = parts[1]._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(partition" in plan


def test_append_continues_offsets(spark, log_of, tmp_path):
    rows = keyed(240)
    path = str(tmp_path / "log")
    write_log(log_of(rows[:100]), path, 4)
    write_log(log_of(rows[100:]), path, 4, mode="append")
    assert stored(read_log(spark, path)) == numbered(rows, 4)


def test_overwrite_replaces(spark, log_of, tmp_path):
    path = str(tmp_path / "log")
    write_log(log_of(keyed(50)), path, 2)
    write_log(log_of(keyed(20)), path, 3)
    assert read_log(spark, path).count() == 20


def test_sink_lines(spark, log_of, tmp_path):
    placed = assign_offset(assign_partition(log_of(golden.INPUT), 1))
    line = format_sink_record(placed).orderBy("offset").first()["line"]
    key, value, _ = golden.INPUT[0]
    assert line == f"Partition: 0.\tOffset: 0.\tKey: {key}.\tValue: {value}"

    path = str(tmp_path / "sink")
    text_sink(placed, path)
    assert [r["value"] for r in spark.read.text(path + "/header").collect()] \
        == ["SINK RECORDS"]
    lines = [r["value"] for r in spark.read.text(path + "/records").collect()]
    assert len(lines) == 126


def test_ordered_sink_files_follow_the_offsets(log_of, tmp_path):
    path = tmp_path / "sink"
    text_sink(assign_offset(assign_partition(log_of(keyed(400)), 3)), str(path))
    read = []
    for part in sorted((path / "records").glob("part-*")):
        for line in part.read_text().splitlines():
            p, o = line.split("\t")[:2]
            read.append((int(p.split()[1][:-1]), int(o.split()[1][:-1])))
    assert read == sorted(read) and len(read) == 400


def test_counters(log_of):
    log, seen = observe_stage(log_of(golden.INPUT), "in")
    log.write.format("noop").mode("overwrite").save()
    assert seen.get["records"] == 126 and seen.get["last_ord"] == [125]


def test_topic_rows(spark):
    df = spark.createDataFrame(
        [(b"k", b"v", 0, 12), (None, b"v", 0, 13)],
        "key binary, value binary, partition int, offset long")
    out = log_from_topic(df).collect()
    assert [tuple(r) for r in out] == [("k", "v", [12])]


def test_progress(log_of):
    log = assign_offset(assign_partition(log_of(keyed(300)), 4))
    read = log.filter(F.col("partition") < 3).filter("offset < 10")
    got = {r["partition"]: (r["end_offset"], r["next_offset"], r["lag"])
           for r in consumer_lag(log, committed_offsets(read)).collect()}
    ends = {r["partition"]: r["next_offset"]
            for r in committed_offsets(log).collect()}
    for p, end in ends.items():
        done = min(10, end) if p < 3 else 0
        assert got[p] == (end, done, end - done)


def test_catch_up(log_of):
    rows = keyed(300)
    log = log_of(rows)
    emitted = log_of([r for r in rows if r[2] < 150])
    expected = {(k, o): "".join(w) for (k, o), (w, _, _) in replay(
        [(k, v, [o]) for k, v, o in rows], 3, 2).items() if o[0] >= 150}

    def got(df):
        return {(r["key"], tuple(r["ord"])): r["value"] for r in df.collect()}

    assert got(catch_up(log, emitted, 3, 2)) == expected
    spans = plan_spans(log, "key", 25)
    assert spans
    assert got(catch_up(spans.rows, emitted, 3, 2, spans=spans)) == expected
    rest = got(window_aggregate(log, 3, 2))
    assert {k: rest[k] for k in expected} == expected


def test_empty_input(spark, log_of, tmp_path):
    from logweave.operators import window_snapshot
    from logweave.plans import Pipeline

    empty = log_of([])
    assert Pipeline.of("filter", "flatmap", "windowaggregate", "map").run(
        empty).count() == 0
    assert window_snapshot(empty, 3).count() == 0
    path = str(tmp_path / "log")
    write_log(empty, path, 4)
    assert read_log(spark, path).count() == 0
    write_log(log_of(keyed(30)), path, 4, mode="append")
    assert stored(read_log(spark, path)) == numbered(keyed(30), 4)
    write_log(empty, path, 4, mode="append")
    assert read_log(spark, path).count() == 30


def test_log_keeps_its_partitions(log_of, spark, tmp_path):
    path = str(tmp_path / "log")
    write_log(log_of(golden.INPUT[:60]), path, 4)
    with pytest.raises(ValueError, match="4 partitions"):
        write_log(log_of(golden.INPUT[60:]), path, 3, mode="append")
    for _ in range(2):
        write_log(log_of(golden.INPUT[60:]), path, 4, mode="append", append_id="second")
    rows = read_log(spark, path).collect()
    assert len(rows) == len(golden.INPUT)
    for p in range(4):
        offsets = sorted(r["offset"] for r in rows if r["partition"] == p)
        assert offsets == list(range(len(offsets)))


@pytest.mark.parametrize("point", ["rows", "note", "rename"])
def test_append_that_fails_and_is_repeated(log_of, spark, tmp_path, monkeypatch, point):
    """A failure before the rows are whole, between rows and note, and before both
    become visible; then the same append again, twice."""
    from logweave.sources import log as module
    rows, path = keyed(240), str(tmp_path / "log")
    write_log(log_of(rows[:100]), path, 4)
    before = stored(read_log(spark, path))
    more = log_of(rows[100:])

    def stop(*_, **__):
        raise RuntimeError("stopped on purpose")

    with monkeypatch.context() as patch:
        if point == "note":
            patch.setattr(module, "write_text", stop)
        elif point == "rename":
            patch.setattr("logweave.storage._file_system", _without_rename(
                __import__("logweave.storage").storage._file_system))
        failing = more if point != "rows" else more.withColumn("value", F.when(
            F.col("value") == "v200", F.raise_error(F.lit("stopped on purpose")))
            .otherwise(F.col("value")))
        with pytest.raises(Exception, match="stopped on purpose"):
            write_log(failing, path, 4, mode="append", append_id="more")
    assert stored(read_log(spark, path)) == before
    for _ in range(2):
        write_log(more, path, 4, mode="append", append_id="more")
    assert stored(read_log(spark, path)) == numbered(rows, 4)
    assert read_log(spark, path).count() == 240


def _without_rename(real):
    class Files:
        def __init__(self, fs):
            self.fs = fs

        def __getattr__(self, name):
            if name == "rename":
                raise RuntimeError("stopped on purpose")
            return getattr(self.fs, name)

    def opened(spark, path):
        fs, jpath = real(spark, path)
        return Files(fs), jpath
    return opened


def test_log_as_a_stream(log_of, spark, tmp_path):
    """The file stream reads a stored log's batches with their partition."""
    from logweave.sources import stream_log
    rows, path = keyed(100), str(tmp_path / "log")
    write_log(log_of(rows[:60]), path, 4)
    write_log(log_of(rows[60:]), path, 4, mode="append")
    query = (stream_log(spark, path).writeStream.format("memory").queryName("as_stream")
             .trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "c")).start())
    query.awaitTermination()
    assert stored(spark.table("as_stream")) == numbered(rows, 4)
