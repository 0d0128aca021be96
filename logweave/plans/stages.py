"""Pipeline stages and the names they go by."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import DataFrame, functions as F

from ..functions.aggregates import concat
from ..functions.strings import characters, odd_hash
from ..operators import stateless
from ..operators.spans import SpanPlan
from ..operators.window import apply_aggregate, check_window, window_aggregate


def _strings(log: DataFrame) -> DataFrame:
    """Between stages a record is a string key and a string value. A null
    key, which belongs to no partition, fails whoever reads the record."""
    value = F.when(F.col("key").isNull(), F.raise_error(F.lit(
        "a stage gave a record a null key"))).otherwise(F.col("value").cast("string"))
    return log.select(F.col("key").cast("string"), value.alias("value"), "ord")


@dataclass(frozen=True)
class Stage:
    """A stateless step.

    ``shrinking`` says that it never adds records to a key, so that a key found
    small before it is small after it.
    """

    name: str
    step: Callable[[DataFrame], DataFrame]
    shrinking: bool = False
    workers: int | None = None

    def apply(self, log: DataFrame) -> DataFrame:
        return _strings(self.step(log))


@dataclass(frozen=True)
class WindowStage:
    name: str
    size: int = 3
    slide: int = 1
    fn: Callable = field(default=concat)
    workers: int | None = None
    shrinking: bool = True

    def __post_init__(self):
        check_window(self.size, self.slide)

    @property
    def rekeys(self) -> bool:
        """Does the aggregate return a (key, value) pair?"""
        return isinstance(self.fn(F.lit("k"), F.array(F.lit("v"))), tuple)

    def apply(self, log: DataFrame, spans: SpanPlan | None = None) -> DataFrame:
        return _strings(window_aggregate(log, self.size, self.slide, self.fn,
                                         spans))

    def emit(self, framed: DataFrame) -> DataFrame:
        """The stage's output from window columns already computed."""
        return _strings(apply_aggregate(framed, self.fn))


def _map(fn: Callable | None = None, workers: int | None = None) -> Stage:
    if fn is None:
        return Stage("map", stateless.map_upper, True, workers)
    return Stage("map", lambda log: stateless.map_records(log, fn), False,
                 workers)


def _filter(fn: Callable | None = None, workers: int | None = None) -> Stage:
    predicate = fn or (lambda key, value: odd_hash(key))
    return Stage("filter", lambda log: stateless.filter_records(log, predicate),
                 True, workers)


def _flatmap(fn: Callable | None = None, workers: int | None = None) -> Stage:
    items = fn or (lambda key, value: characters(value))
    return Stage("flatmap", lambda log: stateless.flatmap_records(log, items),
                 False, workers)


def _rekey(fn: Callable, workers: int | None = None) -> Stage:
    return Stage("rekey", lambda log: stateless.rekey(log, fn), False, workers)


def _map_entries(fn: Callable, workers: int | None = None) -> Stage:
    return Stage("mapentries", lambda log: stateless.map_entries(log, fn),
                 False, workers)


def _flatmap_entries(fn: Callable, workers: int | None = None) -> Stage:
    return Stage("flatmapentries",
                 lambda log: stateless.flatmap_entries(log, fn), False, workers)


def _flatmap_table(fn: type, workers: int | None = None) -> Stage:
    return Stage("flatmaptable", lambda log: stateless.flatmap_table(log, fn), False, workers)


def _window(fn: Callable | None = None, size: int = 3, slide: int = 1,
            workers: int | None = None) -> WindowStage:
    return WindowStage("windowaggregate", size, slide, fn or concat, workers)


#: Name -> factory. The first four have a built-in function and can be named in
#: a properties file; the others need one given.
FUNCTIONS: dict[str, Callable] = {
    "map": _map,
    "filter": _filter,
    "flatmap": _flatmap,
    "windowaggregate": _window,
    "rekey": _rekey,
    "mapentries": _map_entries,
    "flatmapentries": _flatmap_entries,
    "flatmaptable": _flatmap_table,
}


def register(name: str, factory: Callable) -> None:
    """Make a stage available by name."""
    if name in FUNCTIONS:
        raise ValueError(f"stage name taken: {name}")
    FUNCTIONS[name] = factory


def make_stage(name: str, **options) -> Stage | WindowStage:
    if name not in FUNCTIONS:
        raise ValueError(f"unknown function {name!r}, "
                         f"known: {', '.join(sorted(FUNCTIONS))}")
    return FUNCTIONS[name](**options)
