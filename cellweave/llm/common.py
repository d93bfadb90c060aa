"""What the corpus operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellweave.storage import bounded, read_table, shared_dir, written

__all__ = ["bounded", "bounded_bytes", "read_table", "shared_dir", "text_of", "unused", "written"]


def text_of(col: str):
    """The text column as a string, null read as the empty text."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, each with underscores added until ``df`` has no column of that name in any case."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def bounded_bytes(df: DataFrame, most: int, size: Column) -> DataFrame:
    """``df`` with a broadcast hint if its rows, each of ``size`` bytes, come to ``most`` bytes at most, else as it is."""
    held = df.agg(F.sum(size.cast("long")).alias("bytes")).first()["bytes"] or 0
    return F.broadcast(df) if held <= most else df
