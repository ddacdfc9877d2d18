"""Top-k and membership in a top-k list."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def top_k(df: DataFrame, order: list[str | Column], k: int) -> DataFrame:
    """``ORDER BY order LIMIT k``; Spark plans it as TakeOrderedAndProject
    (each task keeps its own k best, the driver merges k x tasks rows).
    Give a full tie-break in ``order`` for a deterministic result."""
    return df.orderBy(*order).limit(k)


def keep_members(df: DataFrame, top: DataFrame, on: list[str] | str) -> DataFrame:
    """Rows of ``df`` whose key is in ``top`` (a left semi join).

    ``top`` must be a ``top_k`` result: its k rows are the proven size bound
    that allows the broadcast.
    """
    return df.join(F.broadcast(top), on=on, how="left_semi")
