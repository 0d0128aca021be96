"""Streaming queries. The table is split by position into parts that arrive
one after the other; the query stops after each and resumes from its
checkpoint with the next."""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, functions as F

from ..plans import Pipeline
from ..operators import committed_offsets, consumer_lag
from ..sources import (append_in_order, committed_positions, lines_prepared, printed_lines,
                       read_committed, read_log, read_partition, stream_lag, stream_lines,
                       stream_log, stream_positions, stream_text_sink, tokenize_lines,
                       write_log)
from ..storage import scratch_path
from ..streaming import Hop, StreamCounters, run_stream, state_snapshot
from .tables import (at, events, flat, lines_by_name, named_lines, orders, share_of,
                     table)

STREAMS = {}


def query(fn):
    STREAMS[fn.__name__] = fn
    return fn


def _parts(log: DataFrame, count: int) -> list[DataFrame]:
    """Consecutive parts of a log by the first element of the position."""
    first = F.get("ord", F.lit(0))
    low, high = log.agg(F.min(first), F.max(first)).first()
    if low is None:
        return [log]
    edges = [low + (high + 1 - low) * i // count for i in range(count + 1)]
    return [log.filter((first >= a) & (first < b))
            for a, b in zip(edges, edges[1:])]


def _played(spark, log: DataFrame, pipe: Pipeline, parts: int, **options):
    """Output and checkpoint folders of a stream that has seen all parts."""
    source, out, checkpoint = (scratch_path(spark, label) for label in (
        "stream-in", "stream-out", "stream-checkpoint"))
    for part in _parts(log, parts):
        part.write.mode("append").parquet(source)
        run_stream(pipe, stream_log(spark, source, stored=False), out,
                   checkpoint, **options).awaitTermination()
    return out, checkpoint


@query
def stream_window(spark, sf):
    out, _ = _played(spark, events(spark, sf),
                     Pipeline.of("windowaggregate", "map"), 3)
    return flat(read_committed(spark, out), "seq")


@query
def stream_stages(spark, sf):
    """Filter, characters, window, upper case."""
    pipe = Pipeline.of("filter", "flatmap",
                       ("windowaggregate", {"size": 4, "slide": 2}), "map")
    out, _ = _played(spark, events(spark, sf), pipe, 2)
    return flat(read_committed(spark, out), "seq", "pos")


@query
def stream_two_windows(spark, sf):
    """Two windows with a new key between them."""
    pipe = Pipeline.of(
        "windowaggregate", ("rekey", {"fn": lambda k, v: F.substring(k, 1, 1)}),
        ("windowaggregate", {"size": 3, "slide": 2}))
    out, _ = _played(spark, events(spark, sf), pipe, 2)
    return flat(read_committed(spark, out), "seq")


@query
def stream_large_keys(spark, sf):
    """Few keys, split within each micro-batch."""
    log = events(spark, sf, key="event_type", value="user_id")
    out, _ = _played(spark, log,
                     Pipeline.of(("windowaggregate", {"size": 4, "slide": 3})),
                     2, rows_per_span=share_of(log, 30))
    return flat(read_committed(spark, out), "seq")


@query
def stream_compacted(spark, sf):
    """State that goes through five micro-batches."""
    out, _ = _played(spark, events(spark, sf),
                     Pipeline.of(("windowaggregate", {"size": 5, "slide": 3})), 5)
    return flat(read_committed(spark, out), "seq")


@query
def stream_stateless(spark, sf):
    """Without windows."""
    out, _ = _played(spark, events(spark, sf), Pipeline.of("filter", "map"), 2)
    return flat(read_committed(spark, out), "seq")


@query
def stream_bounded_trigger(spark, sf):
    """One file a micro-batch, whatever is there."""
    source, out, checkpoint = (scratch_path(spark, label) for label in (
        "bounded-in", "bounded-out", "bounded-checkpoint"))
    for part in _parts(events(spark, sf), 3):
        append_in_order(part, source)
    run_stream(Pipeline.of(("windowaggregate", {"size": 5, "slide": 3})),
               stream_log(spark, source, stored=False, maxFilesPerTrigger=1), out,
               checkpoint).awaitTermination()
    return flat(read_committed(spark, out), "seq")


def _fail_once(number: int):
    """Fails after the output of a micro-batch is written, the first time."""
    state = {"failed": False}

    def after_output(batch: int) -> None:
        if batch == number and not state["failed"]:
            state["failed"] = True
            raise RuntimeError("stopped after the output was written")
    return after_output


def _run(pipe, source, out, checkpoint, **options) -> bool:
    """Run to the end; False if the stream failed."""
    stream = run_stream(pipe, source, out, checkpoint, **options)
    try:
        stream.awaitTermination()
    except StreamingQueryException:
        return False
    return True


@query
def stream_failure(spark, sf):
    """The second micro-batch fails after its output, and is run again."""
    source, out, checkpoint = (scratch_path(spark, label) for label in (
        "failing-in", "failing-out", "failing-checkpoint"))
    pipe = Pipeline.of("windowaggregate", "map")
    fail, ended = _fail_once(1), []
    for part in _parts(events(spark, sf), 3):
        part.write.mode("append").parquet(source)
        ended.append(_run(pipe, stream_log(spark, source, stored=False), out, checkpoint,
                          after_output=fail))
    if ended != [True, False, True]:
        raise AssertionError(f"runs ended as {ended}")
    return flat(read_committed(spark, out), "seq")


@query
def stream_chain(spark, sf):
    """A second stream on the output of a first that fails after writing it:
    it runs before and after the first is restarted."""
    source, hop, out, first, second = (scratch_path(spark, label) for label in (
        "chain-in", "chain-hop", "chain-out", "chain-first", "chain-second"))
    fail = _fail_once(1)
    for part in _parts(events(spark, sf), 2):
        part.write.mode("append").parquet(source)
        for _ in range(2):
            _run(Pipeline.of("windowaggregate"), stream_log(spark, source, stored=False), hop,
                 first, after_output=fail)
            _run(Pipeline.of(("windowaggregate", {"size": 3, "slide": 2})),
                 stream_log(spark, hop, stored=False), out, second)
    return flat(read_committed(spark, out), "seq")


@query
def stream_workers(spark, sf):
    """Worker counts bound a stage's tasks; the result is the same."""
    pipe = Pipeline.of(("windowaggregate", {"size": 5, "slide": 3, "workers": 2}))
    out, _ = _played(spark, events(spark, sf), pipe, 2, use_workers=True)
    return flat(read_committed(spark, out), "seq")


def _turn_files(spark, sf, count: int) -> str:
    """The conversations' lines as text files, each line after its name."""
    source = scratch_path(spark, "files-in")
    named_lines(table(spark, sf, "conversations"), "text", "conv_id", "turn").repartition(
        count, "value").write.text(source)
    return source


@query
def stream_text_window(spark, sf):
    """A window over the words of each line of text files, one file a
    micro-batch."""
    out, checkpoint = (scratch_path(spark, label) for label in ("files-out", "files-checkpoint"))

    def to_log(lines):
        return tokenize_lines(lines_by_name(lines), keep=["name"]).select(
            F.col("name").alias("key"), "value", "ord")

    run_stream(Pipeline.of(("windowaggregate", {"size": 3, "slide": 2}), "map"),
               stream_lines(spark, _turn_files(spark, sf, 3), maxFilesPerTrigger=1), out,
               checkpoint, prepare=lines_prepared(to_log)).awaitTermination()
    return read_committed(spark, out).select("key", "value", at(5, "word"))


@query
def stream_hop(spark, sf):
    """The separately stored output of the first stage."""
    hop = scratch_path(spark, "stream-hop")
    _played(spark, events(spark, sf), Pipeline.of("windowaggregate", "map"), 2,
            hops={1: hop})
    return flat(read_committed(spark, hop), "seq")


def _hop_log(spark, sf) -> str:
    """The first stage's output as a log of eight partitions, written in three
    micro-batches, of which the second fails after its output and is repeated."""
    source, hop, out, checkpoint = (scratch_path(spark, label) for label in (
        "hop-in", "hop-log", "hop-out", "hop-checkpoint"))
    fail = _fail_once(1)
    for part in _parts(events(spark, sf), 3):
        part.write.mode("append").parquet(source)
        for _ in range(2):
            _run(Pipeline.of("windowaggregate", "map"),
                 stream_log(spark, source, stored=False), out, checkpoint,
                 hops={1: Hop(hop, 8)}, after_output=fail)
    return hop


@query
def stream_hop_partition(spark, sf):
    """One partition of a stream's hop, with its offsets."""
    return read_partition(spark, _hop_log(spark, sf), 3).select(
        "key", "value", at(0, "seq"), "partition", "offset")


@query
def stream_hop_lag(spark, sf):
    """Lag of a reader of a stream's hop that is past each partition's first
    quarter."""
    log = read_log(spark, _hop_log(spark, sf))
    ends = committed_offsets(log).withColumnRenamed("next_offset", "end")
    read = log.join(ends, "partition").filter(F.col("offset") * 4 < F.col("end"))
    return consumer_lag(log, committed_offsets(read))


@query
def stream_pinned(spark, sf):
    """A stream over one partition of a stored log that grows, by positions."""
    path, out, checkpoint = (scratch_path(spark, label) for label in (
        "pinned-log", "pinned-out", "pinned-checkpoint"))
    for i, part in enumerate(_parts(events(spark, sf), 2)):
        write_log(part, path, 8, mode="append", append_id=f"part {i}")
        run_stream(Pipeline.of("windowaggregate", "map"),
                   stream_positions(spark, path, [3]).drop("partition", "offset"), out,
                   checkpoint).awaitTermination()
    return flat(read_committed(spark, out), "seq")


@query
def stream_position_lag(spark, sf):
    """What a stream has committed, and its lag, when the log has grown by a second
    append since."""
    path, out, checkpoint = (scratch_path(spark, label) for label in (
        "lag-log", "lag-out", "lag-checkpoint"))
    write_log(events(spark, sf), path, 8)
    run_stream(Pipeline.of("filter"), stream_positions(spark, path).drop(
        "partition", "offset"), out, checkpoint).awaitTermination()
    write_log(orders(spark, sf), path, 8, mode="append")
    return stream_lag(spark, path, committed_positions(spark, f"{checkpoint}/to=1"))


@query
def stream_sink_lines(spark, sf):
    """Lines printed as a log grows; the second micro-batch fails in its tasks and
    is run again."""
    path, sink, checkpoint = (scratch_path(spark, label) for label in (
        "sink-log", "sink-lines", "sink-checkpoint"))
    parts = _parts(events(spark, sf), 3)
    ended = []
    for i, part in enumerate(parts):
        write_log(part, path, 8, mode="append", append_id=f"part {i}")
        for failing in ([True, False] if i == 1 else [False]):
            log = stream_positions(spark, path)
            if failing:
                log = log.withColumn("value", F.when(
                    F.col("partition") % 2 == 1, F.raise_error(F.lit("stopped on purpose")))
                    .otherwise(F.col("value")))
            try:
                stream_text_sink(log, sink, checkpoint).awaitTermination()
            except StreamingQueryException:
                ended.append(i)
    if len(parts) > 1 and ended != [1]:
        raise AssertionError(f"failed in {ended}")
    return printed_lines(spark, sink)


@query
def stream_snapshot(spark, sf):
    """Current window of every key from the state of the stream."""
    pipe = Pipeline.of(("windowaggregate", {"size": 5, "slide": 3}))
    _, checkpoint = _played(spark, events(spark, sf), pipe, 3)
    return state_snapshot(spark, pipe, checkpoint, 1).select(
        "key", "n", F.array_join("window", "|").alias("window"), "value")


@query
def stream_text(spark, sf):
    """Text files as they arrive: lines and words, also the empty ones."""
    out, checkpoint = (scratch_path(spark, label) for label in ("text-out", "text-checkpoint"))

    def to_log(lines):
        return tokenize_lines(lines_by_name(lines), keep=["name"]).select(
            F.col("name").alias("key"), "value", "ord")

    run_stream(Pipeline.of("map"), stream_lines(spark, _turn_files(spark, sf, 2)), out,
               checkpoint, prepare=lines_prepared(to_log)).awaitTermination()
    return read_committed(spark, out).select("key", "value", at(5, "word"))


@query
def stream_counters(spark, sf):
    """Records that each stage of a stream gave out, over all micro-batches, one of
    which fails after its output and is repeated."""
    source, out, checkpoint = (scratch_path(spark, label) for label in (
        "counted-in", "counted-out", "counted-checkpoint"))
    pipe = Pipeline.of("filter", "flatmap", ("windowaggregate", {"size": 4, "slide": 2}), "map")
    counters, fail = StreamCounters(), _fail_once(1)
    for part in _parts(events(spark, sf), 2):
        part.write.mode("append").parquet(source)
        for _ in range(2):
            _run(pipe, stream_log(spark, source, stored=False), out, checkpoint,
                 counters=counters, after_output=fail)
    return counters.stages(spark).groupBy("stage").agg(F.sum("records").alias("records"))


@query
def stream_rebuilt(spark, sf):
    """A stream whose checkpoint is lost after two of three parts: a new one reads
    all of the log and gives out what is missing."""
    source, out, lost, new = (scratch_path(spark, label) for label in (
        "rebuilt-in", "rebuilt-out", "rebuilt-lost", "rebuilt-new"))
    pipe = Pipeline.of("windowaggregate", "map")
    for i, part in enumerate(_parts(events(spark, sf), 4)):
        part.write.mode("append").parquet(source)
        run_stream(pipe, stream_log(spark, source, stored=False), out, lost if i < 2 else new,
                   rebuild=True).awaitTermination()
    return flat(read_committed(spark, out), "seq")
