"""String functions with Java semantics, as plain Spark columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_UINT32 = (1 << 32) - 1

# The characters of the Java regex class \s.
JAVA_WHITESPACE = " \t\n\x0b\f\r"


def _empty() -> Column:
    return F.array().cast("array<string>")


def java_hash(s: Column) -> Column:
    """32-bit ``31 * h + unit`` hash over UTF-16 units, as a signed INT.

    The fold runs over code points; those outside the basic plane contribute
    their two surrogate units.
    """
    def step(h: Column, ch: Column) -> Column:
        cp = F.ascii(ch)
        high = F.lit(0xD800) + F.shiftright(cp - 0x10000, 10)
        low = F.lit(0xDC00) + (cp - 0x10000).bitwiseAND(0x3FF)
        return F.when(cp < 0x10000, h * 31 + cp).otherwise(
            (h * 31 + high) * 31 + low).bitwiseAND(F.lit(_UINT32))

    unsigned = F.aggregate(F.split(s, ""), F.lit(0).cast("bigint"), step)
    # Into the signed range by arithmetic, so that the fold appears once.
    half = 1 << 31
    return ((unsigned + half).bitwiseAND(F.lit(_UINT32)) - half).cast("int")


def odd_hash(s: Column) -> Column:
    """True where the truncating remainder of the hash by two is +1.

    A negative odd hash leaves -1, which does not pass.
    """
    return java_hash(s) % 2 == 1


def _has_any(s: Column, chars: str) -> Column:
    found = F.contains(s, F.lit(chars[0]))
    for ch in chars[1:]:
        found = found | F.contains(s, F.lit(ch))
    return found


def text_lines(text: Column) -> Column:
    """Lines of a text: CR, LF or CRLF ends a line, and the last terminator
    opens no further line.

    Splitting at one plain character is much faster than at a pattern, so the
    pattern is kept for texts that hold a CR.
    """
    pieces = F.when(_has_any(text, "\r"), F.split(text, r"\r\n|\r|\n")).otherwise(
        F.split(text, "\n"))
    # One-element transform: names the pieces, so that the split runs once.
    return F.get(F.transform(F.array(pieces), lambda p: F.slice(
        p, 1, F.size(p) - F.when(F.element_at(p, -1) == "", 1).otherwise(0))), 0)


def java_split(line: Column) -> Column:
    r"""Split at every single whitespace character, keeping leading and inner
    empty strings and dropping trailing ones. An empty line is one empty word;
    a blank line has none."""
    body = F.rtrim(line, F.lit(JAVA_WHITESPACE))
    return (F.when(line == "", F.array(F.lit("")))
            .when(body == "", _empty())
            .when(_has_any(line, JAVA_WHITESPACE[1:]), F.split(body, r"\s"))
            .otherwise(F.split(body, " ")))


def characters(value: Column) -> Column:
    """Code points of a string, in order; none for the empty string."""
    return F.when(value == "", _empty()).otherwise(F.split(value, ""))


def sink_line(partition: Column, offset: Column, key: Column,
              value: Column) -> Column:
    """The printed form of a stored record."""
    return F.concat(
        F.lit("Partition: "), partition.cast("string"),
        F.lit(".\tOffset: "), offset.cast("string"),
        F.lit(".\tKey: "), key,
        F.lit(".\tValue: "), value.cast("string"))
