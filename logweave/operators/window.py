"""The count-based sliding window, per key.

Rule, for window size ``w`` and slide ``s``: a record is appended to its key's
window; if the window already held ``w`` records, the first ``s`` of the
``w + 1`` are dropped. Every record yields the window as it then stands. The
n-th record of a key therefore sees the last ``len(n)`` values, where

    len(n) = n                               for n <= w
             w + 1 - s + (n - w - 1) mod s   otherwise

which needs the record's number and the ``w`` records before it, and nothing
else.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.aggregates import Parts, concat
from ..schema import require_log
from .spans import SpanPlan, in_first_span, numbered


#: Windows from this size on are put together from blocks, where the aggregate
#: has parts; below it, the few values of a frame are cheaper than the blocks' sorts.
BLOCKS_FROM = 64


def check_window(size: int, slide: int) -> None:
    if not (isinstance(size, int) and isinstance(slide, int)):
        raise ValueError("window size and slide are integers")
    if size < 1 or not 1 <= slide <= size + 1:
        raise ValueError(
            f"need size >= 1 and 1 <= slide <= size + 1, got {size}, {slide}")


def window_length(n: Column, size: int, slide: int) -> Column:
    """Length of the window after the n-th record."""
    return F.when(n <= size, n).otherwise(
        F.lit(size + 1 - slide) + (n - size - 1) % slide).cast("int")


def _back(recent: Column, steps: Column, length: Column) -> Column:
    """``length`` values, starting ``steps`` before the end. Context rows, whose
    own windows nobody reads, may not have that many."""
    start = F.greatest(F.size(recent) - steps + 1, F.lit(1))
    return F.slice(recent, start, length)


def frames(log: DataFrame, size: int, slide: int = 1,
           spans: SpanPlan | None = None,
           carry: DataFrame | None = None,
           fn: Callable | None = None) -> DataFrame:
    """Window columns for the log and its context rows.

    ``spans`` comes from ``plan_spans``, whose ``rows`` are then the log.
    ``carry`` holds earlier records (key, value, ord, n) of the same keys, the
    last ``size`` of each. Adds ``n``, ``window``, ``evicted``, ``prior``,
    ``fresh`` (false on context rows) and ``span`` if keys are split. Where ``fn``
    can run over the frame itself, its result is ``direct``. Columns nobody reads
    are pruned by Spark.
    """
    check_window(size, slide)
    split = ["span"] if spans else []
    rows = require_log(log).select("key", "value", "ord", *split)
    if carry is not None:
        earlier = carry.select("key", "value", "ord", F.col("n").alias("n0"))
        if spans:
            earlier = in_first_span(earlier, spans)
        rows = rows.unionByName(earlier, allowMissingColumns=True)
    rows, spec = numbered(rows, "key", spans, reach=size)

    n = F.col("n")

    def values(first: int, last: int) -> Column:
        # In structs, as a list of values would leave out nulls.
        return F.collect_list(F.struct("value")).over(
            spec.rowsBetween(first, last)).getField("value")

    if slide == 1:                    # the frame itself is the window
        window = values(-(size - 1), 0)
        prior = values(-size, -1)
        evicted = F.when(n > size, F.array(
            F.lag("value", size).over(spec))).otherwise(_none("value", rows))
    else:
        recent = values(-size, 0)
        now = window_length(n, size, slide)
        before = window_length(n - 1, size, slide)
        window = _back(recent, now, now)
        prior = _back(recent, before + 1, before)
        evicted = F.when(now == before + 1, _none("value", rows)).otherwise(
            _back(recent, before + 1, before + 1 - now))

    fresh = F.col("n0").isNull()
    repeated = F.lag("ord").over(spec) == F.col("ord")
    faulty = F.coalesce(repeated, F.lit(False))
    if carry is not None:             # a late record sorts before its context
        faulty = faulty | F.coalesce(fresh & ~F.lead(fresh).over(spec),
                                     F.lit(False))

    def checked(column: Column) -> Column:
        # In the columns rather than a filter: a reader of keys alone, such as
        # a count per key, then needs no window at all.
        return F.when(faulty, F.raise_error(F.concat(
            F.lit("record out of order, or position used twice, for key "),
            F.col("key")))).otherwise(column)

    out = [checked(n).alias("n"), checked(window).alias("window"),
           checked(evicted).alias("evicted"), checked(prior).alias("prior"),
           fresh.alias("fresh")]
    if hasattr(fn, "parts") and size >= BLOCKS_FROM:
        rows, direct = _from_blocks(rows, spec, ["key", *split], size, slide, fn.parts)
        out.append(checked(direct).alias("direct"))
    elif slide == 1 and hasattr(fn, "sliding"):
        out.append(checked(fn.sliding(F.col("value")).over(
            spec.rowsBetween(-(size - 1), 0))).alias("direct"))
    return rows.select("key", "value", "ord", *split, *out)


def _from_blocks(rows: DataFrame, spec, keys: list[str], size: int, slide: int,
                 parts: Parts) -> tuple[DataFrame, Column]:
    """The aggregate of each record's window, from running aggregates of blocks.

    Windows begin at the first record or at one behind a multiple of ``slide``. In
    blocks of ``size // slide`` slides, a window that does not begin where its last
    record's block does begins in the block before. So it is the records from its
    beginning to the end of that block, joined with those of its own block so far.
    The former are known at the window's beginning, a fixed number of records
    before the slide's first one: one of two numbers, as windows of a slide may
    begin at two places. From there the value is carried through the slide.
    """
    n = F.col("n")
    block = slide * max(size // slide, 1)
    here = Window.partitionBy(*keys, "in_block")
    upto = Window.unboundedPreceding
    value = F.col("value")
    rows = rows.withColumn("in_block", F.floor((n - 1) / block))
    rows = rows.withColumn("so_far", parts.part(value).over(
        here.orderBy("ord").rowsBetween(upto, 0))).withColumn(
        "onwards", (parts.back or parts.part)(value).over(
            here.orderBy(F.col("ord").desc()).rowsBetween(upto, 0)))

    def slides_back(place: int) -> int:
        return -((place - size - 1) // slide) - 1

    opens = (n - 1) % slide == 0
    many, few = slides_back(1), slides_back(slide)

    def from_beginning(slides: int) -> Column:
        # In a struct, as a part may be null.
        found = F.lag(F.struct("onwards"), slides * slide).over(spec) if slides \
            else F.struct("onwards")
        return F.last(F.when(opens, found), ignorenulls=True).over(spec.rowsBetween(upto, 0))

    begin = n - window_length(n, size, slide) + 1
    rows = rows.withColumn("by_many", from_beginning(many)).withColumn(
        "by_few", from_beginning(max(few, 0)))
    first = F.when(F.floor((n - 1) / slide) - F.floor((begin - 1) / slide) == many,
                   F.col("by_many.onwards")).otherwise(F.col("by_few.onwards"))
    whole = F.when(begin > F.col("in_block") * block, F.col("so_far")).otherwise(
        parts.join(first, F.col("so_far")))
    return rows, F.when(begin > n, parts.empty()).otherwise(parts.finish(whole))


def _none(column: str, rows: DataFrame) -> Column:
    return F.array().cast(f"array<{rows.schema[column].dataType.simpleString()}>")


def count_window(log: DataFrame, size: int, slide: int = 1,
                 spans: SpanPlan | None = None,
                 carry: DataFrame | None = None) -> DataFrame:
    """One row per record: its number ``n`` within the key, the ``window``
    after it, the values it ``evicted`` and the ``prior`` window."""
    return fresh_frames(log, size, slide, spans, carry).drop("span")


def fresh_frames(log: DataFrame, size: int, slide: int = 1,
                 spans: SpanPlan | None = None,
                 carry: DataFrame | None = None,
                 fn: Callable | None = None) -> DataFrame:
    """Window columns without the context rows; ``span`` if keys are split."""
    out = frames(log, size, slide, spans, carry, fn=fn)
    if spans or carry is not None:
        out = out.filter("fresh")
    return out.drop("fresh")


def window_aggregate(log: DataFrame, size: int = 3, slide: int = 1,
                     fn: Callable = concat, spans: SpanPlan | None = None,
                     carry: DataFrame | None = None) -> DataFrame:
    """One aggregate per record over its window, partial windows included.

    ``fn(key, window)`` returns the new value, or a (key, value) pair.
    """
    framed = fresh_frames(log, size, slide, spans, carry, fn)
    return apply_aggregate(framed, fn).drop("span")


def apply_aggregate(framed: DataFrame, fn: Callable) -> DataFrame:
    """The aggregate of each row's window; keeps ``span``."""
    result = F.col("direct") if "direct" in framed.columns else fn(
        F.col("key"), F.col("window"))
    key, value = result if isinstance(result, tuple) else (F.col("key"), result)
    split = ["span"] if "span" in framed.columns else []
    return framed.select(key.alias("key"), value.alias("value"), "ord", *split)


def evicted_values(log: DataFrame, size: int, slide: int = 1,
                   spans: SpanPlan | None = None) -> DataFrame:
    return count_window(log, size, slide, spans).select("key", "ord", "evicted")


def prior_window(log: DataFrame, size: int, slide: int = 1,
                 spans: SpanPlan | None = None) -> DataFrame:
    return count_window(log, size, slide, spans).select("key", "ord", "prior")


def unique_positions(column: Column) -> Column:
    """``column``, or an error if ``last`` has a position twice."""
    ords = F.col("last.ord")
    return F.when(F.size(F.array_distinct(ords)) < F.size(ords), F.raise_error(F.concat(
        F.lit("position used twice, for key "), F.col("key")))).otherwise(column)


def window_snapshot(log: DataFrame, size: int, slide: int = 1,
                    fn: Callable = concat) -> DataFrame:
    """The current window and aggregate of every key.

    Only a count and the last ``size`` records per key are needed. Both are
    reduced before the shuffle, so large keys need no splitting.
    """
    check_window(size, slide)
    log = require_log(log).select("key", "value", "ord")
    counts = log.groupBy("key").agg(F.count(F.lit(1)).alias("n"))

    # First among shares of a key, so that no task sees a whole large key.
    tails = log.withColumn("salt", F.pmod(F.xxhash64("ord"), F.lit(256)))
    for among in (["key", "salt"], ["key"]):
        back = Window.partitionBy(*among).orderBy(F.desc("ord"))
        tails = (tails.withColumn("back", F.row_number().over(back))
                 .filter(F.col("back") <= size))
    tails = tails.groupBy("key").agg(
        F.sort_array(F.collect_list(F.struct("ord", "value"))).alias("last"))
    length = window_length(F.col("n"), size, slide)
    framed = counts.join(tails, "key").select("key", "n", unique_positions(
        _back(F.col("last.value"), length, length)).alias("window"))
    return snapshot_of(framed, fn)


def snapshot_of(framed: DataFrame, fn: Callable) -> DataFrame:
    """The aggregate of each key's window; a (key, value) pair gives a further
    column ``new_key``."""
    result = fn(F.col("key"), F.col("window"))
    if isinstance(result, tuple):
        return framed.select("key", "n", "window", result[1].alias("value"),
                             result[0].alias("new_key"))
    return framed.select("key", "n", "window", result.alias("value"))
