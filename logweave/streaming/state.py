"""What a window keeps between micro-batches, in Spark's own keyed state.

A key's state is its number of records and the last ``size`` of them; keys are
kept together in buckets by their hash, as a call of the stateful step costs some
milliseconds however few records it is for. Spark versions the state with the
micro-batches, writes only the buckets that a micro-batch touched, and rolls it
back with a batch that failed. The stateful step hands each micro-batch's records
on as they come and puts the kept records before them; it holds the kept records
of a bucket. Windows are computed from both by the batch operators.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.window import snapshot_of, unique_positions, window_length
from ..plans.pipeline import Pipeline
from ..plans.stages import WindowStage

#: Buckets of keys. A checkpoint keeps the number that it began with.
BUCKETS = 4096

_STATE = ("keys array<string>, counts array<bigint>, ords array<array<array<bigint>>>, "
          "values array<array<string>>")
_WITH_CONTEXT = "key string, value string, ord array<bigint>, n bigint"

#: State in RocksDB, whose commits write what changed.
_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


@contextmanager
def state_settings(spark: SparkSession):
    """Settings that a stateful query takes over when it starts; afterwards the
    session has its own again."""
    before = {name: spark.conf.get(name, None) for name in _SETTINGS}
    for name, value in _SETTINGS.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def _step(size: int):
    def step(bucket: tuple, records: Iterator[pd.DataFrame], state: GroupState
             ) -> Iterator[pd.DataFrame]:
        kept: dict[str, tuple[int, list]] = {}
        if state.exists:
            for key, n, ords, values in zip(*state.get, strict=True):
                kept[key] = n, list(zip(map(tuple, ords), values, strict=True))
        met: set[str] = set()
        for some in records:
            keys, ords, values = (some[c].tolist() for c in ("key", "ord", "value"))
            here = defaultdict(list)
            for key, ord_, value in zip(keys, ords, values, strict=True):
                here[key].append((tuple(ord_), value))
            numbers = [0] * len(keys)
            for key, new in here.items():
                n, last = kept.get(key, (0, []))
                if key not in met:        # its kept records lead, with their numbers
                    met.add(key)
                    keys += [key] * len(last)
                    ords += [list(o) for o, _ in last]
                    values += [v for _, v in last]
                    numbers += range(n - len(last) + 1, n + 1)
                kept[key] = n + len(new), heapq.nlargest(size, last + new, key=_place)[::-1]
            yield pd.DataFrame({"key": keys, "value": values, "ord": ords, "n": numbers})
        state.update((list(kept), [n for n, _ in kept.values()],
                      [[[int(x) for x in o] for o, _ in last] for _, last in kept.values()],
                      [[v for _, v in last] for _, last in kept.values()]))
    return step


def _place(record: tuple) -> tuple:
    return record[0]


def with_context(log: DataFrame, size: int) -> DataFrame:
    """A streaming keyed log, and for the keys of each micro-batch the last
    ``size`` records before it. Those have their number ``n``, the others 0."""
    bucket = F.pmod(F.xxhash64("key"), F.lit(BUCKETS)).alias("bucket")
    return log.select("key", "value", "ord", bucket).groupBy("bucket").applyInPandasWithState(
        _step(size), _WITH_CONTEXT, _STATE, "append", GroupStateTimeout.NoTimeout)


def window_state(spark: SparkSession, checkpoint: str, stage: int) -> DataFrame:
    """``key, n, last``: the state of a stream's window stage (1-based) after its
    last finished micro-batch, by Spark's state reader."""
    found = spark.read.format("statestore").load(f"{checkpoint}/stage={stage}")
    kept = F.col("value.groupState")
    keys = found.select(F.explode(F.arrays_zip(
        kept["keys"].alias("key"), kept["counts"].alias("n"), kept["ords"].alias("ords"),
        kept["values"].alias("values"))).alias("kept")).select("kept.*")
    return keys.select("key", "n", F.arrays_zip(
        F.col("ords").alias("ord"), F.col("values").alias("value")).alias("last"))


def state_snapshot(spark: SparkSession, pipeline: Pipeline, checkpoint: str,
                   stage: int) -> DataFrame:
    """Current window and aggregate of every key of a stream's window stage."""
    window = pipeline.stages[stage - 1]
    if not isinstance(window, WindowStage):
        raise ValueError(f"stage {stage} is no window")
    length = window_length(F.col("n"), window.size, window.slide)
    last = F.slice("last.value", F.size("last") - length + 1, length)
    return snapshot_of(window_state(spark, checkpoint, stage).select(
        "key", "n", unique_positions(last).alias("window")), window.fn)
