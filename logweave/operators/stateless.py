"""Per-record operators: map, filter, flatmap and their built-in instances.

Functions take the key and value columns and return columns, so neighbouring
stages fuse into one code-generated span. A pandas UDF fits the same shape when
built-in functions cannot say it.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.strings import characters, odd_hash

_KEY, _VALUE = "key", "value"


def _call(fn: Callable):
    return fn(F.col(_KEY), F.col(_VALUE))


def _extended(*positions: str) -> Column:
    """The record's position followed by its place within its parent."""
    return F.concat("ord", F.array(*[F.col(p).cast("bigint")
                                     for p in positions])).alias("ord")


def map_records(log: DataFrame, fn: Callable) -> DataFrame:
    """One record to one. ``fn`` returns the new value, or (key, value)."""
    result = _call(fn)
    key, value = result if isinstance(result, tuple) else (F.col(_KEY), result)
    return log.select(key.alias(_KEY), value.alias(_VALUE), "ord")


def map_upper(log: DataFrame) -> DataFrame:
    return map_records(log, lambda key, value: F.upper(value))


def rekey(log: DataFrame, fn: Callable) -> DataFrame:
    """Give each record a new key; what follows is grouped by it."""
    return log.select(_call(fn).cast("string").alias(_KEY), _VALUE, "ord")


def map_entries(log: DataFrame, fn: Callable) -> DataFrame:
    """One record to the entries of a map, none for an empty map.

    ``fn`` returns a map column, or an array of (key, value) structs in which
    the last entry of a key wins. Entries leave in the order of the map. A map
    column must not repeat a key; where keys may be equal, give an array.
    """
    entries = _call(fn)
    if dict(log.select(entries.alias("e")).dtypes)["e"].startswith("map"):
        split = log.select("ord", F.posexplode(entries).alias("pos", "k", "v"))
    else:
        split = log.select("ord", F.posexplode(_last_wins(entries)).alias(
            "pos", "e")).select("ord", "pos", F.col("e.key").alias("k"),
                                F.col("e.value").alias("v"))
    return split.select(F.col("k").alias(_KEY), F.col("v").alias(_VALUE),
                        _extended("pos"))


def _last_wins(entries: Column) -> Column:
    keys = F.transform(entries, lambda e: e["key"])
    return F.filter(entries, lambda e, i: ~F.array_contains(
        F.slice(keys, i + 2, F.size(entries)), e["key"]))


def filter_records(log: DataFrame, predicate: Callable) -> DataFrame:
    """Keep the records for which ``predicate`` holds."""
    return log.filter(_call(predicate))


def filter_odd_hash(log: DataFrame) -> DataFrame:
    return filter_records(log, lambda key, value: odd_hash(key))


def flatmap_records(log: DataFrame, fn: Callable) -> DataFrame:
    """One record to a list of records under its key, in list order."""
    return (log.select(_KEY, "ord", F.posexplode(_call(fn)).alias("pos", "item"))
            .select(_KEY, F.col("item").alias(_VALUE), _extended("pos")))


def flatmap_entries(log: DataFrame, fn: Callable) -> DataFrame:
    """One record to the lists of a map, each under its own key.

    ``fn`` returns a map column, or an array of (key, value) structs whose values
    are lists; there the last list of a key wins. A map column must not repeat a
    key: Spark refuses to build one that does.
    """
    lists = _call(fn)
    if dict(log.select(lists.alias("e")).dtypes)["e"].startswith("map"):
        split = log.select("ord", F.posexplode(lists).alias("at", "k", "items"))
    else:
        split = log.select("ord", F.posexplode(_last_wins(lists)).alias("at", "e")).select(
            "ord", "at", F.col("e.key").alias("k"), F.col("e.value").alias("items"))
    return (split
            .select("ord", "at", "k", F.posexplode("items").alias("pos", "item"))
            .select(F.col("k").alias(_KEY), F.col("item").alias(_VALUE),
                    _extended("at", "pos")))


def flatmap_table(log: DataFrame, handler: type) -> DataFrame:
    """One record to the rows of a Python table function, by a lateral join.

    ``handler`` is a class whose ``eval(self, key, value)`` yields (key, value)
    pairs, in order; it may have ``terminate`` as well. A record for which nothing
    is yielded goes.
    """
    class Numbered:
        def __init__(self):
            self.inner = handler()

        def eval(self, key: str, value: str):
            for at, (k, v) in enumerate(self.inner.eval(key, value) or ()):
                yield k, v, at

    table = F.udtf(Numbered, returnType="new_key string, new_value string, pos int")
    return log.lateralJoin(table(F.col(_KEY).outer(), F.col(_VALUE).outer())).select(
        F.col("new_key").alias(_KEY), F.col("new_value").alias(_VALUE), _extended("pos"))


def flatmap_chars(log: DataFrame) -> DataFrame:
    return flatmap_records(log, lambda key, value: characters(value))
