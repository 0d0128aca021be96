"""Linear pipelines: one definition for batch and stream."""

from __future__ import annotations

import re
from dataclasses import dataclass, replace
from typing import Iterable

from pyspark.sql import DataFrame, Observation, functions as F

from ..operators.spans import SpanPlan, plan_spans
from ..schema import require_log
from ..sources.log import read_log, write_log
from ..sources.sink import observe_stage
from ..storage import scratch_path
from .stages import Stage, WindowStage, make_stage


def _positive(name: str, text: str | None) -> int:
    if text is None:
        raise ValueError(f"missing {name}")
    try:
        number = int(text)
    except ValueError:
        number = 0
    if number < 1:
        raise ValueError(f"{name} must be a positive integer, got {text!r}")
    return number


def parse_properties(text: str) -> dict[str, str]:
    """Names and values of a properties file: parted by ``=``, ``:`` or blanks; ``#``
    and ``!`` start a comment line, a backslash at its end continues a line, and
    elsewhere stands before a letter that is meant as it is, or n, t, r, f, uXXXX."""
    lines, open_line = [], ""
    for line in text.splitlines():
        line = open_line + line.lstrip(" \t\f")
        if not open_line and line[:1] in ("#", "!"):
            continue
        ending = len(line) - len(line.rstrip("\\"))
        open_line = line[:-1] if ending % 2 else ""
        if not ending % 2:
            lines.append(line)
    lines.append(open_line)
    found = {}
    for line in lines:
        parted = _PROPERTY.match(line)
        if parted and parted[0]:
            found[_unescaped(parted[1])] = _unescaped(line[parted.end():].rstrip(" \t\f"))
    return found


_PROPERTY = re.compile(r"((?:\\.|[^\\=: \t\f])*)[ \t\f]*[=:]?[ \t\f]*")
_ESCAPE = re.compile(r"\\(?:u([0-9a-fA-F]{4})|(.))")


def _unescaped(text: str) -> str:
    special = {"n": "\n", "t": "\t", "r": "\r", "f": "\f"}
    return _ESCAPE.sub(lambda m: chr(int(m[1], 16)) if m[1] else special.get(m[2], m[2]), text)


#: Rows that a task of a window with configured workers sorts at a time, about.
ROWS_PER_WORKER = 4_000_000


def _by_workers(log: DataFrame, stage: WindowStage, spans: SpanPlan | None,
                rows_per_worker: int) -> DataFrame:
    """The window stage in as many tasks as it has workers, which take a share of the
    keys at a time: however many rows there are, a task sorts a bounded number. No
    stage since the check of the keys has added rows."""
    rounds = 1 if spans is None else -(-spans.rows.count() // (stage.workers * rows_per_worker))
    if rounds <= 1:
        return stage.apply(log.repartition(stage.workers, "key"), spans)
    path = scratch_path(log.sparkSession, "rounds")
    # Not the hash that deals the keys to the workers, so that these have equal shares.
    at = F.pmod(F.xxhash64(F.lit("round"), "key"), F.lit(rounds)).cast("int")
    log.withColumn("round", at).write.partitionBy("round").parquet(f"{path}/in")
    shares = log.sparkSession.read.schema(log.select(
        "*", F.lit(0).alias("round")).schema).parquet(f"{path}/in")
    for k in range(rounds):
        share = shares.filter(F.col("round") == k).drop("round")
        stage.apply(share.repartition(stage.workers, "key"), spans).write.parquet(
            f"{path}/out/round={k}")
    return log.sparkSession.read.parquet(f"{path}/out").drop("round")


@dataclass(frozen=True)
class Pipeline:
    stages: tuple[Stage | WindowStage, ...]

    def __post_init__(self):
        if not self.stages:
            raise ValueError("a pipeline has at least one stage")

    @classmethod
    def of(cls, *stages: str | Stage | WindowStage | tuple) -> "Pipeline":
        """Stages as objects, as names, or as (name, options)."""
        made = []
        for s in stages:
            if isinstance(s, str):
                s = make_stage(s)
            elif isinstance(s, tuple):
                s = make_stage(s[0], **s[1])
            made.append(s)
        return cls(tuple(made))

    @classmethod
    def from_properties(cls, text: str) -> "Pipeline":
        """Read ``pipeline.length``, ``function.at.i``, ``processors.at.i``."""
        given = parse_properties(text)
        length = _positive("pipeline.length", given.get("pipeline.length"))
        stages = []
        for i in range(1, length + 1):
            name = given.get(f"function.at.{i}")
            if name is None:
                raise ValueError(f"missing function.at.{i}")
            count = f"processors.at.{i}"
            stages.append(make_stage(
                name, workers=_positive(count, given.get(count))))
        return cls(tuple(stages))

    def run(self, log: DataFrame, rows_per_span: int | None = None,
            split_large_keys: bool = True,
            use_workers: bool = False,
            counters: dict[int, Observation] | None = None,
            bytes_per_span: int | None = None,
            rows_per_worker: int = ROWS_PER_WORKER) -> DataFrame:
        """Apply all stages.

        The result is lazy, but key sizes are looked up in jobs of their own,
        which first store what takes more than a scan to make: each stage runs
        once, whatever the number of windows. ``split_large_keys=False`` runs
        no job.

        Neighbouring stateless stages fuse, and windows on one key share a
        shuffle. Before a window, keys are checked for size unless an earlier
        check still holds or ``split_large_keys`` is off; ``bytes_per_span`` has their
        values' sizes count as well. ``use_workers`` makes
        a window stage use its configured number of partitions, also for split keys,
        and a stateless one no more than that; by default Spark sizes them at run
        time. Where these would have more than about ``rows_per_worker`` rows each, the
        keys are taken in rounds, one after the other, whose results are stored;
        with ``split_large_keys=False``, as no job runs, all keys are taken at once. ``counters`` is filled with an observation
        for every stage (1-based), whose ``records`` and ``last_ord`` are there
        when a job over the stage has ended.
        """
        log = require_log(log)
        if log.isStreaming and any(isinstance(s, WindowStage)
                                   for s in self.stages):
            raise ValueError("a stream with windows runs through run_stream")
        checked: SpanPlan | None = None
        for at, stage in enumerate(self.stages, 1):
            if isinstance(stage, WindowStage):
                if not split_large_keys:
                    spans = None
                elif checked is not None and not checked:
                    spans = checked
                else:
                    spans = checked = plan_spans(
                        log, "key", rows_per_span, bytes_per_span)
                    log = spans.rows
                if not (use_workers and stage.workers):
                    log = stage.apply(log, spans)
                elif spans:
                    log = stage.apply(log, replace(spans, workers=stage.workers))
                else:
                    log = _by_workers(log, stage, spans, rows_per_worker)
                if stage.rekeys:
                    checked = None
            else:
                if use_workers and stage.workers:
                    log = log.coalesce(stage.workers)
                log = stage.apply(log)
                if not stage.shrinking:
                    checked = None
            if counters is not None:
                log, counters[at] = observe_stage(log, f"stage {at}")
        return log

    def materialize(self, log: DataFrame, upto: int, path: str,
                    partitions: int | None = None,
                    rows_per_span: int | None = None) -> DataFrame:
        """Run the first ``upto`` stages into a stored log, and read it back.

        The log has the next stage's worker count as partitions, one after the
        last stage, unless ``partitions`` says otherwise.
        """
        if not 1 <= upto <= len(self.stages):
            raise ValueError(f"no stage {upto}")
        if partitions is None:
            following = self.stages[upto:upto + 1]
            partitions = (following[0].workers or 1) if following else 1
        out = Pipeline(self.stages[:upto]).run(log, rows_per_span)
        write_log(out, path, partitions, rows_per_span=rows_per_span)
        return read_log(log.sparkSession, path)
