"""Working columns beside a user's columns, whatever these are called."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def packed(df: DataFrame) -> Column:
    """All columns as one struct: no other name can clash with those inside."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns])


def unpacked(row: str, columns: Sequence[str], replaced: Sequence[str] = ()) -> list[Column]:
    """The columns of a packed row, without those that new ones replace."""
    gone = {c.lower() for c in replaced}
    return [F.col(row).getField(c).alias(c) for c in columns if c.lower() not in gone]


def free_name(columns: Sequence[str], wanted: str) -> str:
    """``wanted``, with underscores in front until no column is called so."""
    taken = {c.lower() for c in columns}
    while wanted.lower() in taken:
        wanted = "_" + wanted
    return wanted
