"""Window aggregates: ``(key, window array) -> Column``.

Any callable of this shape works; these are the stock ones. ``concat`` is the
default aggregate of a window stage. A function may have an attribute
``sliding``, the same aggregate as ``value -> Column``: with slide 1 it then runs
over the frame itself and no array is built. An attribute ``parts`` says how the
aggregate is put together from parts of the window: wide windows are then
computed from running aggregates of blocks, a constant number of steps a record
whatever the window's size and slide.

A null value is a value of its window: it is counted, and left out of sums,
extremes and concatenations. The extreme of a window without a number is null.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import Column, functions as F


@dataclass(frozen=True)
class Parts:
    """An associative aggregate.

    ``part`` is a Spark aggregate over records in their order, ``join`` puts an
    earlier and a later part together, and ``finish`` turns the whole into the
    value (default: as it is). ``empty`` is the value of a window without records
    (default: null). ``back`` is ``part`` over records in reverse, needed where the
    order matters.
    """

    part: Callable[[Column], Column]
    join: Callable[[Column, Column], Column]
    finish: Callable[[Column], Column] = lambda whole: whole
    empty: Callable[[], Column] = lambda: F.lit(None)
    back: Callable[[Column], Column] | None = None


def concat(key: Column, window: Column) -> Column:
    return F.array_join(window, "")


def count(key: Column, window: Column) -> Column:
    return F.size(window).cast("bigint")


def total(key: Column, window: Column) -> Column:
    return F.aggregate(window, F.lit(0.0), lambda acc, v: acc + F.coalesce(
        v.cast("double"), F.lit(0.0)))


def maximum(key: Column, window: Column) -> Column:
    return F.array_max(F.transform(window, lambda v: v.cast("double")))


def minimum(key: Column, window: Column) -> Column:
    return F.array_min(F.transform(window, lambda v: v.cast("double")))


count.sliding = lambda v: F.count(F.lit(1))
total.sliding = lambda v: F.sum(F.coalesce(v.cast("double"), F.lit(0.0)))
maximum.sliding = lambda v: F.max(v.cast("double"))
minimum.sliding = lambda v: F.min(v.cast("double"))

count.parts = Parts(count.sliding, lambda a, b: a + b, empty=lambda: F.lit(0))
total.parts = Parts(total.sliding, lambda a, b: a + b, empty=lambda: F.lit(0.0))
maximum.parts = Parts(maximum.sliding, F.greatest)
minimum.parts = Parts(minimum.sliding, F.least)

AGGREGATES = {"concat": concat, "count": count, "sum": total,
              "max": maximum, "min": minimum}
