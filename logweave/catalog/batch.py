"""Batch queries: ``(spark, table folder) -> DataFrame``."""

from __future__ import annotations

import pyarrow as pa
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, functions as F

from ..functions import AGGREGATES, java_hash
from ..operators import (assign_key, assign_offset, assign_partition, catch_up,
                         committed_offsets, consumer_lag, count_window,
                         filter_odd_hash, filter_records, flatmap_chars,
                         flatmap_entries, format_sink_record, map_entries,
                         map_records, map_upper, plan_spans, rekey,
                         window_aggregate, window_snapshot)
from ..plans import Pipeline
from ..schema import keyed_log
from ..sources import (read_lines, read_log, read_partition, text_sink,
                       tokenize_lines, tokenize_text, write_log)
from ..storage import scratch_path
from .tables import (at, conversations, events, flat, lines_by_name, named_lines, orders,
                     share_of, table, words)

PARTITIONS = 8
BATCH = {}


def query(fn):
    BATCH[fn.__name__] = fn
    return fn


def joined(column: str):
    return F.array_join(column, "|").alias(column)


# sources and sinks

def _stored(spark, sf) -> str:
    path = scratch_path(spark, "events-log")
    write_log(events(spark, sf), path, PARTITIONS)
    return path


def _stored_columns(df: DataFrame) -> DataFrame:
    return df.select("key", "value", at(0, "seq"), "partition", "offset")


@query
def read_log_events(spark, sf):
    return _stored_columns(read_log(spark, _stored(spark, sf)))


@query
def read_partition_events(spark, sf):
    return _stored_columns(read_partition(spark, _stored(spark, sf), 3))


@query
def append_log(spark, sf):
    """Two writes into one log; the offsets of the second go on."""
    path = scratch_path(spark, "appended-log")
    write_log(events(spark, sf), path, PARTITIONS)
    write_log(orders(spark, sf), path, PARTITIONS, mode="append")
    return _stored_columns(read_log(spark, path))


@query
def append_retried(spark, sf):
    """An append whose tasks fail while it is written, then is repeated twice under
    its name."""
    path = scratch_path(spark, "retried-log")
    write_log(events(spark, sf), path, PARTITIONS)
    more = orders(spark, sf)
    failing = more.withColumn("value", F.when(
        F.get("ord", F.lit(0)) % 2 == 1, F.raise_error(F.lit("stopped on purpose")))
        .otherwise(F.col("value")))
    for log in (failing, more, more):
        try:
            write_log(log, path, PARTITIONS, mode="append", append_id="orders")
        except PySparkException:
            if log is not failing:
                raise
    return _stored_columns(read_log(spark, path))


@query
def tokenize_documents(spark, sf):
    tokens = tokenize_text(table(spark, sf, "documents"), "text", "doc_id")
    return tokens.select("value", at(0, "doc_id"), at(1, "line"), at(2, "word"))


@query
def read_text_lines(spark, sf):
    """Texts through text files: written as lines with their names, read back, split
    into words, also the empty ones."""
    path = scratch_path(spark, "text")
    named_lines(table(spark, sf, "documents"), "text", "doc_id").write.text(path)
    tokens = tokenize_lines(lines_by_name(read_lines(spark, path)), keep=["name"])
    part = lambda i: F.split_part("name", F.lit("/"), F.lit(i)).cast("bigint")
    return tokens.select("value", part(1).alias("doc_id"), part(2).alias("line"), at(4, "word"))


@query
def assign_key_events(spark, sf):
    keyed = assign_key(table(spark, sf, "events"), "event_id")
    return flat(keyed_log(keyed, "key", "event_type", "event_id"), "seq")


@query
def assign_partition_events(spark, sf):
    out = assign_partition(events(spark, sf), PARTITIONS)
    return out.select("key", "value", at(0, "seq"), "partition")


def _with_offsets(spark, sf, **kw) -> DataFrame:
    placed = assign_partition(events(spark, sf, **kw), PARTITIONS)
    spans = plan_spans(placed, "partition")
    return assign_offset(spans.rows, spans)


@query
def assign_offset_events(spark, sf):
    return _stored_columns(_with_offsets(spark, sf))


@query
def format_sink_records(spark, sf):
    return format_sink_record(_with_offsets(spark, sf)).select("line")


@query
def text_sink_lines(spark, sf):
    path = scratch_path(spark, "sink")
    text_sink(_with_offsets(spark, sf), path)
    return spark.read.text([f"{path}/header", f"{path}/records"]).select(
        F.col("value").alias("line"))


# stateless operators

@query
def map_value(spark, sf):
    return flat(map_records(events(spark, sf), lambda k, v: F.concat(
        v, F.lit("@"), k)), "seq")


@query
def map_upper_documents(spark, sf):
    log = keyed_log(table(spark, sf, "documents"), "doc_id", "text", "doc_id")
    return map_upper(log).select("key", "value")


@query
def map_multi(spark, sf):
    """No, one or two records per event."""
    def entries(key, value):
        return F.when(value == "error", F.expr("map()").cast(
            "map<string,string>")).when(
            value == "purchase", F.create_map(
                key, value, F.concat(F.lit("copy-"), key), F.upper(value))
        ).otherwise(F.create_map(key, value))

    return flat(map_entries(events(spark, sf), entries), "seq", "pos")


@query
def map_multi_last_wins(spark, sf):
    """Entries with one key: the last one stays."""
    def entries(key, value):
        def pair(k, v):
            return F.struct(k.alias("key"), v.alias("value"))
        return F.array(pair(key, value), pair(value, key),
                       pair(key, F.upper(value)))

    return map_entries(events(spark, sf), entries).select(
        "key", "value", at(0, "seq"))


@query
def rekey_events(spark, sf):
    return flat(rekey(events(spark, sf), lambda k, v: F.concat(
        v, F.lit("/"), F.length(k).cast("string"))), "seq")


@query
def filter_predicate(spark, sf):
    return flat(filter_records(events(spark, sf), lambda k, v: (
        v != "error") & (F.length(k) > 1)), "seq")


@query
def filter_odd_hash_events(spark, sf):
    return flat(filter_odd_hash(events(spark, sf)), "seq")


@query
def filter_odd_hash_types(spark, sf):
    """Keys with positive and negative hashes."""
    return flat(filter_odd_hash(events(spark, sf, key="event_type",
                                       value="user_id")), "seq")


@query
def flatmap_table_events(spark, sf):
    """A Python table function: the halves of the type, and the user under it."""
    class Halves:
        def eval(self, key, value):
            if value == "error":
                return
            middle = len(value) // 2
            yield key, value[:middle]
            yield key, value[middle:]
            yield value, key

    return flat(Pipeline.of(("flatmaptable", {"fn": Halves})).run(events(spark, sf)),
                "seq", "pos")


@query
def map_arrow_events(spark, sf):
    """An Arrow function that returns a map, whose entries become records."""
    @F.arrow_udf("map<string,string>")
    def entries(key: pa.Array, value: pa.Array) -> pa.Array:
        pairs = [[(k, v), (f"{k}+", v.upper())] if v != "error" else []
                 for k, v in zip(key.to_pylist(), value.to_pylist())]
        return pa.array(pairs, pa.map_(pa.string(), pa.string()))

    return flat(Pipeline.of(("mapentries", {"fn": lambda k, v: entries(k, v)})).run(
        events(spark, sf)), "seq", "pos")


@query
def window_arrow_aggregate(spark, sf):
    """An Arrow function as the window's aggregate: its longest value, the last of
    equal ones."""
    @F.arrow_udf("string")
    def longest(window: pa.Array) -> pa.Array:
        return pa.array([max(enumerate(w), key=lambda v: (len(v[1]), v[0]))[1]
                         for w in window.to_pylist()])

    return flat(_windowed(events(spark, sf), 4, 2, lambda key, window: longest(window)), "seq")


@query
def java_hash_props(spark, sf):
    return events(spark, sf, key="props").select(
        "key", at(0, "seq"), java_hash(F.col("key")).alias("hash"))


@query
def flatmap_chars_events(spark, sf):
    return flat(flatmap_chars(events(spark, sf)), "seq", "pos")


@query
def flatmap_multi(spark, sf):
    """Characters under the user, and the whole type under the type."""
    def lists(key, value):
        return F.create_map(key, F.split(value, ""), value, F.array(value))

    return flat(flatmap_entries(events(spark, sf), lists), "seq", "entry", "pos")


@query
def flatmap_multi_last_wins(spark, sf):
    """Lists under keys that repeat in an array of entries: the last stays."""
    def entries(key, value):
        entry = lambda k, *v: F.struct(k.alias("key"), F.array(*v).alias("value"))
        return F.array(entry(value, key), entry(value, value, key))
    out = flatmap_entries(events(spark, sf), entries)
    return flat(out, "seq", "entry", "pos")


# count windows

def _windowed(log, size, slide, fn=AGGREGATES["concat"], rows_per_span=None):
    spans = plan_spans(log, "key", rows_per_span)
    return window_aggregate(spans.rows, size, slide, fn, spans)


@query
def window_concat_3_1(spark, sf):
    return flat(_windowed(events(spark, sf), 3, 1), "seq")


@query
def window_concat_5_3(spark, sf):
    return flat(_windowed(events(spark, sf), 5, 3), "seq")


@query
def window_tumbling(spark, sf):
    return flat(_windowed(events(spark, sf), 4, 4), "seq")


@query
def window_empty(spark, sf):
    return flat(_windowed(events(spark, sf), 3, 4), "seq")


@query
def window_wide(spark, sf):
    return flat(_windowed(events(spark, sf), 25, 10), "seq")


@query
def window_orders(spark, sf):
    return flat(_windowed(orders(spark, sf), 3, 1), "seq")


@query
def window_conversations(spark, sf):
    return flat(_windowed(conversations(spark, sf), 2, 1), "seq")


@query
def window_large_keys(spark, sf):
    """Five keys hold everything, so each is split into spans."""
    log = events(spark, sf, key="event_type", value="user_id")
    return flat(_windowed(log, 4, 3, rows_per_span=share_of(log, 20)), "seq")


def _measure(name, size, slide):
    def fn(spark, sf):
        out = _windowed(events(spark, sf, value="value"), size, slide,
                        AGGREGATES[name])
        return out.select("key", F.round(F.col("value").cast("double"), 4)
                          .alias("value"), at(0, "seq"))
    return fn


BATCH["window_sum"] = _measure("sum", 5, 3)
BATCH["window_sum_sliding"] = _measure("sum", 6, 1)
BATCH["window_max"] = _measure("max", 5, 1)
BATCH["window_min"] = _measure("min", 4, 2)


BATCH["window_wide_sum"] = _measure("sum", 1000, 1)
BATCH["window_wide_sum_sliding"] = _measure("sum", 700, 240)
BATCH["window_wide_max"] = _measure("max", 100, 30)


@query
def window_wide_count(spark, sf):
    """A window that is empty now and then, over keys that are split."""
    log = events(spark, sf, key="event_type", value="user_id")
    out = _windowed(log, 99, 100, AGGREGATES["count"], share_of(log, 20))
    return out.select("key", F.col("value").cast("bigint"), at(0, "seq"))


@query
def window_count(spark, sf):
    out = _windowed(events(spark, sf), 4, 3, AGGREGATES["count"])
    return out.select("key", F.col("value").cast("bigint"), at(0, "seq"))


def _framed(spark, sf, size, slide):
    spans = plan_spans(events(spark, sf))
    return count_window(spans.rows, size, slide, spans)


@query
def count_window_columns(spark, sf):
    return _framed(spark, sf, 5, 3).select(
        "key", at(0, "seq"), "n", joined("window"), joined("evicted"),
        joined("prior"))


@query
def evicted_values(spark, sf):
    return _framed(spark, sf, 3, 2).select("key", at(0, "seq"),
                                           joined("evicted"))


@query
def prior_window(spark, sf):
    return _framed(spark, sf, 3, 1).select("key", at(0, "seq"), joined("prior"))


@query
def window_snapshot_events(spark, sf):
    return window_snapshot(events(spark, sf), 5, 3).select(
        "key", "n", joined("window"), "value")


@query
def rekey_window(spark, sf):
    log = rekey(events(spark, sf), lambda k, v: F.concat(
        v, F.lit("-"), F.substring(k, 1, 1)))
    return flat(_windowed(log, 3, 1), "seq")


# whole pipelines

@query
def stages_demo(spark, sf):
    return flat(Pipeline.of("windowaggregate", "map").run(events(spark, sf)),
                "seq")


@query
def stages_properties(spark, sf):
    pipe = Pipeline.from_properties("""
        # window, then characters, then upper case
        pipeline.length=3
        replication.factor=2
        function.at.1=windowaggregate
        processors.at.1=2
        function.at.2=flatmap
        processors.at.2=3
        function.at.3=map
        processors.at.3=1
    """)
    return flat(pipe.run(events(spark, sf)), "seq", "pos")


@query
def stages_four(spark, sf):
    pipe = Pipeline.of("filter", "flatmap",
                       ("windowaggregate", {"size": 4, "slide": 2}), "map")
    return flat(pipe.run(events(spark, sf)), "seq", "pos")


@query
def stages_two_windows(spark, sf):
    pipe = Pipeline.of(
        "windowaggregate", ("rekey", {"fn": lambda k, v: F.substring(k, 1, 1)}),
        ("windowaggregate", {"size": 3, "slide": 2}))
    return flat(pipe.run(events(spark, sf)), "seq")


@query
def stages_text(spark, sf):
    return flat(Pipeline.of("windowaggregate", "map").run(words(spark, sf)),
                "doc_id", "line", "word")


@query
def definitions_refused(spark, sf):
    """Pipelines defined by the names of the regions: which are refused, and why."""
    rows = []
    for r in table(spark, sf, "region").orderBy("r_regionkey").collect():
        key, name = r["r_regionkey"], r["r_name"].lower()
        for length, function in ((key, "map"), (1, name), (1, None), (1, "map")):
            given = [f"pipeline.length={length}", "processors.at.1=1"]
            if function:
                given.append(f"function.at.1={function}")
            try:
                Pipeline.from_properties("\n".join(given))
                why = None
            except ValueError as e:
                why = str(e).partition(",")[0]
            rows.append((key, length, function, why))
    return spark.createDataFrame(rows, "region long, length long, function string, why string")


@query
def stage_counters(spark, sf):
    """How many records each stage of a pipeline gave out."""
    pipe = Pipeline.of("filter", "flatmap",
                       ("windowaggregate", {"size": 4, "slide": 2}), "map")
    counters = {}
    pipe.run(events(spark, sf), counters=counters).write.parquet(
        scratch_path(spark, "counted"))
    return spark.createDataFrame(
        [(at, seen.get["records"]) for at, seen in counters.items()],
        "stage int, records long")


@query
def stages_workers(spark, sf):
    """Configured worker counts bound the window's tasks, not its result."""
    pipe = Pipeline.of("filter", "flatmap",
                       ("windowaggregate", {"size": 4, "slide": 2, "workers": 3}), "map")
    return flat(pipe.run(events(spark, sf), use_workers=True), "seq", "pos")


@query
def stages_empty_windows(spark, sf):
    """The greatest of windows that are empty now and then (null), windowed
    again: an empty window's null is one of the records of the next."""
    def shown(key, window):
        top = F.array_max(F.transform(window, lambda v: v.cast("double")))
        return F.concat(F.coalesce(top.cast("string"), F.lit("none")), F.lit("/"),
                        F.size(window).cast("string"))
    pipe = Pipeline.of(
        ("windowaggregate", {"size": 3, "slide": 4, "fn": AGGREGATES["max"]}),
        ("windowaggregate", {"size": 3, "slide": 2, "fn": shown}))
    return flat(pipe.run(events(spark, sf, value="value")), "seq")


@query
def window_rekeyed_large(spark, sf):
    """An aggregate that gives all records one key: the next window splits it."""
    pipe = Pipeline.of(
        ("windowaggregate", {"fn": lambda k, w: (F.lit("all"), F.array_join(w, ""))}),
        ("windowaggregate", {"size": 4, "slide": 3}))
    log = events(spark, sf)
    return flat(pipe.run(log, rows_per_span=share_of(log, 20)), "seq")


@query
def sink_overwritten(spark, sf):
    """A sink that is started again holds only the new run's lines."""
    path = scratch_path(spark, "sink-twice")
    text_sink(_with_offsets(spark, sf, value="props"), path)
    text_sink(_with_offsets(spark, sf), path)
    return spark.read.text([f"{path}/header", f"{path}/records"]).select(
        F.col("value").alias("line"))


@query
def stage_hop(spark, sf):
    """The stored output of the first of two stages."""
    pipe = Pipeline.of("windowaggregate", ("map", {"workers": 4}))
    return _stored_columns(pipe.materialize(
        events(spark, sf), 1, scratch_path(spark, "hop")))


# progress

def _purchases(log: DataFrame) -> DataFrame:
    return log.filter(F.col("value") == "purchase")


@query
def catch_up_events(spark, sf):
    """Already given out: what precedes each user's last purchase."""
    spans = plan_spans(events(spark, sf))
    return flat(catch_up(spans.rows, _purchases(spans.rows), 3, 1,
                         spans=spans), "seq")


@query
def committed_offsets_events(spark, sf):
    return committed_offsets(_with_offsets(spark, sf))


@query
def consumer_lag_events(spark, sf):
    """A reader that is past the last purchase of each partition."""
    log = _with_offsets(spark, sf)
    return consumer_lag(log, committed_offsets(_purchases(log)))
