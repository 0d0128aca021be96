"""Running a pipeline over a stream.

Spark keeps one keyed state in a query, so a pipeline runs as a chain of queries
with a log between them, one query for each window. A query's stateless stages
before its window are part of the streaming plan; from the window on, a
micro-batch goes through the batch operators, together with the records that
the state holds. Outputs of micro-batch ``b`` are written aside and renamed to
``batch=<b>``. A batch that is run again after a failure leaves output alone that
it had finished: each record counts once, at the sink and in every stream that
reads it.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.spans import plan_spans
from ..operators.window import fresh_frames
from ..plans.pipeline import Pipeline
from ..plans.stages import Stage, WindowStage
from ..schema import require_log
from ..sources.log import log_note, publish_batch, read_committed, stream_log
from ..storage import make_folder, publish, published, read_text, write_text
from .counters import StreamCounters, counted
from .state import state_settings, with_context


@dataclass(frozen=True)
class Hop:
    """Where a stage's output is stored, as a log of so many partitions; by
    default as many as the next stage has workers, one after the last stage."""

    path: str
    partitions: int | None = None


@dataclass(frozen=True)
class _Part:
    """One query of the chain: its stages by number, and where its output goes."""

    stages: tuple[tuple[int, Stage | WindowStage], ...]
    targets: tuple[Hop | str, ...]
    name: str

    @property
    def window(self) -> int | None:
        return next((i for i, (_, s) in enumerate(self.stages)
                     if isinstance(s, WindowStage)), None)


def _parts(pipeline: Pipeline, out: str, checkpoint: str, prepared: bool,
           hops: dict[int, Hop]) -> list[_Part]:
    """Cut the pipeline behind stages whose output is a hop, before a second
    window, and before any window whose input a micro-batch must prepare."""
    parts: list[_Part] = []
    here: list[tuple[int, Stage | WindowStage]] = []
    unprepared = prepared

    def close(*targets: Hop | str) -> None:
        nonlocal unprepared
        window = next((at for at, s in here if isinstance(s, WindowStage)), None)
        name = f"stage={window}" if window else f"to={here[-1][0] if here else 0}"
        parts.append(_Part(tuple(here), targets, name))
        here.clear()
        unprepared = False

    for at, stage in enumerate(pipeline.stages, 1):
        if isinstance(stage, WindowStage) and (
                unprepared or any(isinstance(s, WindowStage) for _, s in here)):
            close(f"{checkpoint}/hop={at - 1}")
        here.append((at, stage))
        if at in hops and at < len(pipeline.stages):
            close(hops[at])
    end = hops.get(len(pipeline.stages))
    close(*([end] if end else []), out)
    return parts


class StreamRun:
    """The queries of a running pipeline."""

    def __init__(self, spark: SparkSession, starts: list[Callable[[], StreamingQuery]],
                 together: bool, counters: StreamCounters | None = None):
        self._spark, self._counters = spark, counters
        self._waiting = list(starts)
        self.queries: list[StreamingQuery] = []
        if counters:
            spark.streams.addListener(counters)
        while self._waiting and (together or not self.queries):
            self._next()

    def _next(self) -> None:
        self.queries.append(self._waiting.pop(0)())
        if self._counters:
            self._counters.watch(self.queries[-1])

    def awaitTermination(self) -> None:
        """Wait for all queries; one that takes what is there and ends is followed
        by the next. A failure of one is raised, and stops the others."""
        done = 0
        try:
            while done < len(self.queries):
                self.queries[done].awaitTermination()
                done += 1
                if done == len(self.queries) and self._waiting:
                    self._next()
        except BaseException:
            self.stop()
            raise
        self._uncount()

    def stop(self) -> None:
        self._waiting.clear()
        for query in self.queries:
            query.stop()
        self._uncount()

    def _uncount(self) -> None:
        if self._counters:
            self._counters.settled()
            self._spark.streams.removeListener(self._counters)
            self._counters = None

    def exception(self):
        """The failure of the first query that has one."""
        return next((e for q in self.queries if (e := q.exception())), None)

    @property
    def isActive(self) -> bool:
        return bool(self._waiting) or any(q.isActive for q in self.queries)


def run_stream(pipeline: Pipeline, source: DataFrame, out: str,
               checkpoint: str,
               prepare: Callable[[DataFrame, int], DataFrame] | None = None,
               hops: dict[int, str | Hop] | None = None,
               trigger: dict | None = None,
               rows_per_span: int | None = None,
               after_output: Callable[[int], None] | None = None,
               use_workers: bool = False,
               counters: StreamCounters | None = None,
               rebuild: bool = False
               ) -> StreamRun:
    """Start ``pipeline`` on a streaming DataFrame.

    ``prepare`` turns a micro-batch and its number into a keyed log; without it
    the source must be one. Output goes to ``out/batch=<id>`` when the batch is
    finished, and is read with ``read_committed`` or by a further stream with
    ``stream_log(stored=False)``. ``hops`` names folders for the output of single
    stages (1-based), each a stored log with partitions and offsets that
    ``read_log``, ``read_partition`` and ``stream_log`` read; the following stages
    read it too. ``after_output`` is called with a batch's number when a query has
    written it, before Spark commits it. ``use_workers`` makes a window stage use its
    configured number of partitions. ``counters`` collects what each stage gives out.

    ``rebuild`` is for a stream that lost its checkpoint: on a new one it takes the
    source from the beginning, which brings the windows' state back, and gives out
    only records that are not in the output yet.

    With the default trigger each query of the chain takes what is there and
    ends, and the next follows in ``awaitTermination``; with any other they run
    side by side.
    """
    options = trigger or {"availableNow": True}
    spark = source.sparkSession
    stored = {}
    for at, hop in (hops or {}).items():
        hop = hop if isinstance(hop, Hop) else Hop(hop)
        following = pipeline.stages[at:at + 1]
        workers = (following[0].workers or 1) if following else 1
        stored[at] = replace(hop, partitions=hop.partitions or workers)
    parts = _parts(pipeline, out, checkpoint, prepare is not None, stored)

    def start(part: _Part, before: _Part | None) -> StreamingQuery:
        log, first = source, prepare
        if before is not None:
            hop, first = before.targets[0], None
            path = hop.path if isinstance(hop, Hop) else hop
            make_folder(spark, path)
            log = stream_log(spark, path, stored=isinstance(hop, Hop))
        return _start(part, log, first, f"{checkpoint}/{part.name}", options, rows_per_span,
                      after_output, use_workers, counters, rebuild)

    starts = [lambda p=p, b=b: start(p, b)
              for p, b in zip(parts, [None, *parts[:-1]], strict=True)]
    return StreamRun(spark, starts, not {"availableNow", "once"} & set(options), counters)


def _start(part: _Part, source: DataFrame, prepare, checkpoint: str, trigger: dict,
           rows_per_span: int | None, after_output, use_workers: bool,
           counters: StreamCounters | None, rebuild: bool) -> StreamingQuery:
    spark = source.sparkSession
    at = part.window
    if at is not None:
        for nth, stage in part.stages[:at]:
            source = stage.apply(source)
            if counters:
                source = counted(source, nth)
        source = with_context(require_log(source), part.stages[at][1].size)
    first = _first_batch(spark, checkpoint, part, rebuild)

    def process(batch: DataFrame, number: int) -> None:
        if at is None:
            log = require_log(prepare(batch, number) if prepare else batch)
            rest, held = part.stages, []
        else:
            held = [batch.persist(StorageLevel.MEMORY_AND_DISK)]
            log, rest = batch, part.stages[at:]
        seen: dict[int, Observation] = {}
        for nth, stage in rest:
            log = _windows(log, stage, rows_per_span, use_workers) \
                if isinstance(stage, WindowStage) else stage.apply(log)
            if counters:
                seen[nth] = Observation(f"stage {nth}")
                log = counted(log, nth, seen[nth])
        if len(part.targets) > 1:
            held.append(log.persist(StorageLevel.MEMORY_AND_DISK))
            log = held[-1]
        try:
            new = [_save(log, target, first + number, first, rows_per_span)
                   for target in part.targets]
            if not any(new) and (seen or at is not None):
                # An earlier attempt has written it all; its state and its counts
                # are made again.
                log.write.format("noop").mode("overwrite").save()
            for nth, observed in seen.items():
                counters.record(nth, number, observed.get["records"])
            if after_output:
                after_output(number)
        finally:
            for kept in held:
                kept.unpersist()

    with state_settings(spark):
        return (source.writeStream.foreachBatch(process)
                .option("checkpointLocation", checkpoint)
                .trigger(**trigger).start())


def _first_batch(spark: SparkSession, checkpoint: str, part: _Part, rebuild: bool) -> int:
    """The number under which a query's first micro-batch is published: 0, or with
    a new checkpoint beside old output, the next one. It stays with the checkpoint."""
    note = f"{checkpoint}-first.txt"
    kept = read_text(spark, note)
    if kept is not None:
        return int(kept)
    first = 0
    if rebuild:
        for target in part.targets:
            done = published(spark, target.path if isinstance(target, Hop) else target)
            first = max(first, done[-1] + 1 if done else 0)
        write_text(spark, note, str(first))
    return first


def _windows(batch: DataFrame, stage: WindowStage, rows_per_span: int | None,
             use_workers: bool) -> DataFrame:
    """The window stage over a micro-batch and the context rows within it."""
    spans = plan_spans(batch.filter("n = 0").drop("n"), "key", rows_per_span)
    if use_workers and stage.workers:
        spans = replace(spans, workers=stage.workers) if spans else replace(
            spans, rows=spans.rows.repartition(stage.workers, "key"))
    return stage.emit(fresh_frames(spans.rows, stage.size, stage.slide, spans,
                                   batch.filter("n > 0"), stage.fn))


def _save(log: DataFrame, target: Hop | str, number: int, first: int,
          rows_per_span: int | None) -> bool:
    """Publish a micro-batch's output, without what batches before ``first`` have."""
    spark: SparkSession = log.sparkSession
    path = target.path if isinstance(target, Hop) else target
    rows = log.select("key", "value", "ord")
    if first:
        earlier = read_committed(spark, path).filter(f"batch < {first}").select("key", "ord")
        rows = rows.join(earlier, ["key", "ord"], "left_anti").select("key", "value", "ord")
    if isinstance(target, Hop):
        return publish_batch(rows, path, number, target.partitions,
                             log_note(spark, path, before=number), rows_per_span=rows_per_span)
    return publish(spark, path, f"batch={number}", lambda hidden: rows.write.parquet(hidden))
