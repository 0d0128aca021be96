import pandas as pd
from pyspark.sql import functions as F

from logweave.operators import (assign_key, filter_odd_hash, filter_records,
                                flatmap_chars, flatmap_entries,
                                flatmap_records, map_entries, map_records,
                                map_upper, rekey)
from logweave.schema import keyed_log, rejects, require_log

from . import golden


def rows(df):
    return [(r["key"], r["value"], list(r["ord"]))
            for r in df.orderBy("ord").collect()]


def test_map_upper(log_of):
    assert rows(map_upper(log_of([("k", "straße", 1), ("k", "", 2)]))) == [
        ("k", "STRASSE", [1]), ("k", "", [2])]


def test_map_may_return_a_pair(log_of):
    out = map_records(log_of([("a", "b", 1)]), lambda k, v: (v, k))
    assert rows(out) == [("b", "a", [1])]


def test_map_with_a_pandas_udf(log_of):
    @F.pandas_udf("string")
    def backwards(v: pd.Series) -> pd.Series:
        return v.str[::-1]

    out = map_records(log_of([("a", "xyz", 1)]), lambda k, v: backwards(v))
    assert rows(out) == [("a", "zyx", [1])]


def test_map_entries(log_of):
    out = map_entries(log_of([("a", "x", 1), ("b", "none", 2)]), lambda k, v: (
        F.when(v != "none", F.create_map(k, v, v, k))
        .otherwise(F.expr("map()").cast("map<string,string>"))))
    assert rows(out) == [("a", "x", [1, 0]), ("x", "a", [1, 1])]


def test_map_entries_last_of_a_key_wins(log_of):
    def pair(k, v):
        return F.struct(k.alias("key"), v.alias("value"))

    out = map_entries(log_of([("a", "x", 1)]), lambda k, v: F.array(
        pair(k, v), pair(F.lit("o"), v), pair(k, F.lit("last"))))
    assert sorted((k, v) for k, v, _ in rows(out)) == [("a", "last"), ("o", "x")]


def test_map_entries_from_a_python_udf(log_of):
    @F.udf("map<string,string>")
    def both(k, v):
        return {k: v, k + k: v + v}

    out = map_entries(log_of([("a", "x", 1)]), both)
    assert sorted((k, v) for k, v, _ in rows(out)) == [("a", "x"), ("aa", "xx")]


def test_filter(log_of):
    log = log_of([("a", "x", 1), ("b", "y", 2)])
    assert rows(filter_records(log, lambda k, v: v == "y")) == [("b", "y", [2])]


def test_filter_odd_hash_on_the_sample(log_of):
    kept = rows(filter_odd_hash(log_of(golden.INPUT)))
    assert len(kept) == golden.ODD
    assert {k for k, _, _ in kept} == {"Key0", "Key2", "Key4"}


def test_flatmap_chars(log_of):
    out = flatmap_chars(log_of([("a", "xy", 1), ("a", "", 2), ("b", "z", 3)]))
    assert rows(out) == [("a", "x", [1, 0]), ("a", "y", [1, 1]),
                         ("b", "z", [3, 0])]


def test_flatmap_records_keeps_list_order(log_of):
    out = flatmap_records(log_of([("a", "3,1,2", 7)]),
                          lambda k, v: F.split(v, ","))
    assert rows(out) == [("a", "3", [7, 0]), ("a", "1", [7, 1]),
                         ("a", "2", [7, 2])]


def test_flatmap_entries(log_of):
    out = flatmap_entries(log_of([("a", "xy", 1)]), lambda k, v: F.create_map(
        k, F.split(v, ""), F.lit("whole"), F.array(v)))
    assert rows(out) == [("a", "x", [1, 0, 0]), ("a", "y", [1, 0, 1]),
                         ("whole", "xy", [1, 1, 0])]


def test_rekey(log_of):
    out = rekey(log_of([("a", "x", 1)]), lambda k, v: F.concat(k, v))
    assert rows(out) == [("ax", "x", [1])]


def test_assign_key_repeats(spark):
    df = spark.range(12)
    first = assign_key(df, "id", 5).orderBy("id").collect()
    again = assign_key(df.repartition(7), "id", 5).orderBy("id").collect()
    assert first == again
    assert [r["key"] for r in first][:6] == [
        "Key0", "Key1", "Key2", "Key3", "Key4", "Key0"]


def test_nulls_are_rejected(spark):
    df = spark.createDataFrame(
        [("a", "x", 1), (None, "x", 2), ("a", None, 3), ("a", "y", None)],
        "k string, v string, o long")
    assert rows(keyed_log(df, "k", "v", "o")) == [("a", "x", [1])]
    assert rejects(df, "k", "v", "o").count() == 3


def test_wrong_shape_is_refused(spark):
    import pytest
    with pytest.raises(ValueError):
        require_log(spark.range(3))
    with pytest.raises(ValueError):
        require_log(spark.range(3).selectExpr("'a' key", "'b' value", "id ord"))
