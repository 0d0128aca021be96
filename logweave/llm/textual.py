"""Vectorised text helpers that run inside tasks.

Texts are handled as arrays of code points, a bounded number of characters at
a time, so that memory depends on neither the batch nor the longest text. A
word is a maximal run of letters, digits and marks, in lower case.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np

#: Characters handled at once.
SLICE = 1 << 18
_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)

LETTER, DIGIT, MARK, UPPER, SPACE = 1, 2, 4, 8, 16
WORD = LETTER | DIGIT | MARK


@lru_cache(1)
def char_classes() -> np.ndarray:
    """Bits of every code point: letter, digit, mark, upper case, space."""
    out = np.zeros(sys.maxunicode + 1, np.uint8)
    for c in range(sys.maxunicode + 1):
        kind = unicodedata.category(chr(c))
        if kind[0] == "L":
            out[c] = LETTER | (UPPER if kind in ("Lu", "Lt") else 0)
        elif kind[0] == "N":
            out[c] = DIGIT
        elif kind[0] == "M":
            out[c] = MARK
        elif kind[0] == "Z" or c in (9, 10, 11, 12, 13):
            out[c] = SPACE
    return out


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


@lru_cache(1)
def _powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    inverse = _U(pow(int(_BASE), -1, 1 << 64))
    up = np.full(SLICE + 1, _BASE, _U)
    down = np.full(SLICE + 1, inverse, _U)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=_U), np.cumprod(down, dtype=_U)


@lru_cache(1)
def _code_values() -> np.ndarray:
    return mix(np.arange(1, sys.maxunicode + 2, dtype=_U) * _BASE)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def lowered(text: str) -> str:
    """Lower case with as many characters as the text has."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower()[0] for c in text)


def range_hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each code-point range of a slice, by prefix sums."""
    up, down = _powers()
    total = np.zeros(len(codes) + 1, _U)
    np.cumsum(_code_values()[codes] * up[:len(codes)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts]
               + (ends - starts).astype(_U))


def slices(text: str) -> Iterator[tuple[int, int]]:
    """Cut a text into pieces of at most SLICE characters, between words where
    it has any break in the second half of a piece."""
    at, n, flags = 0, len(text), None
    while n - at > SLICE:
        flags = char_classes()[code_points(text[at:at + SLICE])] & WORD
        gaps = np.flatnonzero(flags[SLICE // 2:] == 0)
        cut = at + (SLICE // 2 + int(gaps[-1]) + 1 if len(gaps) else SLICE)
        yield at, cut
        at = cut
    yield at, n


class Words(NamedTuple):
    """Words of one or more texts: hash, first and one-past-last character
    (from the beginning of the text), and the text they are in."""

    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    text: np.ndarray


def _edges(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    step = np.diff(np.concatenate(([0], inside.astype(np.int8), [0])))
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def words_of(texts: list[str | None]) -> Words:
    """All words of a list of texts; short texts share a pass."""
    parts: list[Words] = []
    group: list[tuple[int, int, str]] = []
    held = 0

    def flush():
        nonlocal held
        if not group:
            return
        joined = "\n".join(piece for _, _, piece in group)
        codes = code_points(joined)
        starts, ends = _edges(char_classes()[codes] & WORD != 0)
        at = np.cumsum([0] + [len(piece) + 1 for _, _, piece in group])
        which = np.searchsorted(at, starts, "right") - 1
        shift = np.array([offset for _, offset, _ in group], np.int64) - at[:-1]
        parts.append(Words(range_hashes(codes, starts, ends),
                           starts + shift[which], ends + shift[which],
                           np.array([i for i, _, _ in group], np.int64)[which]))
        group.clear()
        held = 0

    for i, text in enumerate(texts):
        if not text:
            continue
        low = lowered(text)
        for start, end in slices(low):
            if held + end - start + 1 > SLICE:
                flush()
            group.append((i, start, low[start:end]))
            held += end - start + 1
    flush()
    if not parts:
        none = np.zeros(0, np.int64)
        return Words(none.astype(_U), none, none, none)
    return Words(*(np.concatenate(column) for column in zip(*parts, strict=True)))


def bounds(text: np.ndarray, n: int) -> np.ndarray:
    """Where the words of text i begin, for i of 0 to n."""
    return np.searchsorted(text, np.arange(n + 1))


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash for every ``size`` successive entries; none if there are fewer."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, _U)
    out = np.zeros(n, _U)
    for k in range(size):
        out = out * _BASE + hashes[k:k + n]
    return mix(out)


def small(batches: Iterator, rows: int = 1000) -> Iterator:
    """Arrow batches cut into shorter ones, so that few texts are Python strings
    at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def batches(texts: list[str | None], most: int = 4 * SLICE) -> Iterator[tuple[int, int]]:
    """Runs of successive texts with about ``most`` characters."""
    first, held = 0, 0
    for i, text in enumerate(texts):
        held += len(text or "")
        if held >= most:
            yield first, i + 1
            first, held = i + 1, 0
    if first < len(texts):
        yield first, len(texts)
