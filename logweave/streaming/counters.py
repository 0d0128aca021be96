"""Counters of a running stream: what each stage gave out in each micro-batch."""

from __future__ import annotations

import re
import threading

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

_STAGE = re.compile(r"stage (\d+)$")


def counted(log: DataFrame, stage: int, seen: Observation | None = None) -> DataFrame:
    """Count the records and find the last position that pass a stage; in a
    streaming plan the numbers come with the query's progress."""
    return log.observe(seen or f"stage {stage}", F.count(F.lit(1)).alias("records"),
                       F.max("ord").alias("last_ord"))


class StreamCounters(StreamingQueryListener):
    """Pass one to ``run_stream``: collects the counts of every stage and the input
    rows of every query, by micro-batch. A batch that is repeated counts once."""

    def __init__(self):
        self._lock = threading.Lock()
        self._stages: dict[tuple[int, int], int] = {}
        self._inputs: dict[tuple[str, int], int] = {}
        self._ours: dict[str, threading.Event] = {}

    def watch(self, query: StreamingQuery) -> None:
        with self._lock:
            self._ours.setdefault(str(query.runId), threading.Event())

    def _event(self, run_id) -> threading.Event:
        with self._lock:
            return self._ours.setdefault(str(run_id), threading.Event())

    def record(self, stage: int, batch: int, records: int) -> None:
        with self._lock:
            self._stages[stage, batch] = records

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        with self._lock:
            self._inputs[str(progress.id), progress.batchId] = progress.numInputRows
        for name, row in (progress.observedMetrics or {}).items():
            found = _STAGE.match(name)
            if found:
                self.record(int(found[1]), progress.batchId, row["records"])

    def onQueryTerminated(self, event) -> None:
        self._event(event.runId).set()

    def settled(self, timeout: float = 30) -> None:
        """Wait until the events of the ended queries have come in."""
        for event in list(self._ours.values()):
            event.wait(timeout)

    def stages(self, spark: SparkSession) -> DataFrame:
        """``stage, batch, records``."""
        with self._lock:
            rows = [(s, b, n) for (s, b), n in sorted(self._stages.items())]
        return spark.createDataFrame(rows, "stage int, batch long, records long")

    def inputs(self, spark: SparkSession) -> DataFrame:
        """``query, batch, rows``: what each query of the chain took in."""
        with self._lock:
            rows = [(q, b, n) for (q, b), n in sorted(self._inputs.items())]
        return spark.createDataFrame(rows, "query string, batch long, rows long")
