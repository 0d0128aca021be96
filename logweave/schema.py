"""The keyed log: the one table shape every operator takes and returns."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F, types as T

ORD_TYPE = T.ArrayType(T.LongType(), containsNull=False)

#: key, value and the position of the record. ``ord`` compares element by
#: element and is unique within a key; one-to-many operators append to it.
LOG_SCHEMA = T.StructType([
    T.StructField("key", T.StringType(), False),
    T.StructField("value", T.StringType(), False),
    T.StructField("ord", ORD_TYPE, False),
])

#: A keyed log after partition and offset assignment.
STORED_SCHEMA = T.StructType(LOG_SCHEMA.fields + [
    T.StructField("offset", T.LongType(), False),
    T.StructField("partition", T.IntegerType(), False),
])


def _column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _parts(order) -> list[Column]:
    order = order if isinstance(order, (list, tuple)) else [order]
    return [_column(o).cast("bigint") for o in order]


def _present(*columns: Column) -> Column:
    return reduce(and_, [c.isNotNull() for c in columns])


def _shaped(df: DataFrame, key, value, order: Column) -> DataFrame:
    return df.select(
        _column(key).cast("string").alias("key"),
        _column(value).cast("string").alias("value"),
        order.cast("array<bigint>").alias("ord"))


def keyed_log(df: DataFrame, key, value, order) -> DataFrame:
    """View any DataFrame as a keyed log.

    ``order`` is one integer column or a list of them. Rows with a null key,
    value or position are not part of the log; see :func:`rejects`.
    """
    parts = _parts(order)
    kept = df.filter(_present(_column(key), _column(value), *parts))
    return _shaped(kept, key, value, F.array(*parts))


def rejects(df: DataFrame, key, value, order) -> DataFrame:
    """The rows :func:`keyed_log` leaves out."""
    parts = _parts(order)
    left = df.filter(~_present(_column(key), _column(value), *parts))
    return _shaped(left, key, value, F.when(_present(*parts), F.array(*parts)))


def require_log(df: DataFrame) -> DataFrame:
    """Fail early when a DataFrame lacks the keyed-log columns."""
    types = dict(df.dtypes)
    for name, kind in (("key", "string"), ("ord", "array<bigint>")):
        if types.get(name) != kind:
            raise ValueError(
                f"keyed log needs column {name} {kind}, found {types.get(name)}")
    if "value" not in types:
        raise ValueError("keyed log needs column value")
    return df
