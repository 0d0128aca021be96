"""Keyed record pipelines on Spark: map, filter, flatmap and count windows over
(key, value) records, in batch and in streams."""

from .plans import FUNCTIONS, Pipeline, Stage, WindowStage, register
from .schema import LOG_SCHEMA, STORED_SCHEMA, keyed_log, rejects

__all__ = ["FUNCTIONS", "LOG_SCHEMA", "Pipeline", "STORED_SCHEMA", "Stage",
           "WindowStage", "keyed_log", "register", "rejects"]
