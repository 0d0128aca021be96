"""Queries over the shared test tables, one per operator, and their SQL."""

from .batch import BATCH, stages_demo
from .oracle import ORACLE
from .streams import STREAMS

QUERIES = {**BATCH, **STREAMS}

__all__ = ["ORACLE", "QUERIES", "stages_demo"]
