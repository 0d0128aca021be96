import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from logweave.functions import (characters, java_hash, java_split, odd_hash,
                                text_lines)

SPACE = " \t\n\x0b\f\r"


def evaluate(spark, values, fn):
    df = spark.createDataFrame(list(enumerate(values)), "i int, s string")
    rows = df.select("i", fn(F.col("s")).alias("r")).orderBy("i").collect()
    return [list(r["r"]) if isinstance(r["r"], list) else r["r"] for r in rows]


def expected_hash(s):
    units = s.encode("utf-16-be", "surrogatepass")
    h = 0
    for i in range(0, len(units), 2):
        h = (h * 31 + units[i] * 256 + units[i + 1]) % 2 ** 32
    return h - 2 ** 32 if h >= 2 ** 31 else h


def expected_words(line):
    if line == "":
        return [""]
    for c in SPACE:
        line = line.replace(c, " ")
    words = line.split(" ")
    while words and words[-1] == "":
        words.pop()
    return words


def expected_lines(text):
    lines = text.replace("\r\n", "\n").replace("\r", "\n").split("\n")
    return lines[:-1] if lines[-1] == "" else lines


def test_known_hashes(spark):
    assert evaluate(spark, ["", "Key0", "Key1", "purchase", "signup"],
                    java_hash) == [0, 2335185, 2335186, 1743324417, -902467304]


def test_odd_negative_hash_is_dropped(spark):
    found = [s for s in (f"{c}ignup{i}" for i in range(60) for c in "abcsxyz!")
             if expected_hash(s) < 0 and expected_hash(s) % 2]
    assert found
    assert evaluate(spark, found, odd_hash) == [False] * len(found)
    assert evaluate(spark, ["Key0", "Key1", "purchase"], odd_hash) == [
        True, False, True]


text = st.text(st.characters(exclude_categories=["Cs"]), max_size=30)
spaced = st.text(st.sampled_from("ab" + SPACE + "  é"), max_size=20)


@settings(max_examples=5, deadline=None)
@given(st.lists(text, min_size=40, max_size=80))
def test_hash_of_any_text(spark, values):
    assert evaluate(spark, values, java_hash) == [
        expected_hash(v) for v in values]


@settings(max_examples=5, deadline=None)
@given(st.lists(spaced, min_size=60, max_size=120))
def test_words_of_any_line(spark, values):
    assert evaluate(spark, values, java_split) == [
        expected_words(v) for v in values]


@settings(max_examples=5, deadline=None)
@given(st.lists(spaced, min_size=60, max_size=120))
def test_lines_of_any_text(spark, values):
    assert evaluate(spark, values, text_lines) == [
        expected_lines(v) for v in values]


@pytest.mark.parametrize("line,words", [
    ("", [""]), ("  ", []), (" a", ["", "a"]), ("a  b ", ["a", "", "b"]),
    ("a\tb\x0bc\fd", ["a", "b", "c", "d"])])
def test_words(spark, line, words):
    assert evaluate(spark, [line], java_split) == [words]


@pytest.mark.parametrize("content,lines", [
    ("x\n", ["x"]), ("x\n\ny", ["x", "", "y"]), ("", []), ("\n", [""]),
    ("x\n\n", ["x", ""]), ("a\r\nb\rc", ["a", "b", "c"]), ("\r\n", [""])])
def test_lines(spark, content, lines):
    assert evaluate(spark, [content], text_lines) == [lines]


def test_characters(spark):
    assert evaluate(spark, ["", "abc", "é😀"], characters) == [
        [], ["a", "b", "c"], ["é", "😀"]]
