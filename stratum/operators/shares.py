"""Percent shares: of a group total and of the grand total."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def share_within(df: DataFrame, value: str, group: list[str], name: str = "share_pct",
                 rows_per_group_bounded: bool = False) -> DataFrame:
    """``100 * value / sum(value) per group`` (a 100%-stacked chart's numbers).

    A group whose total is 0 has no shares: NULL.  By default the group totals are an aggregate joined back on the group key:
    a hot group is summed map-side and the join is against one row per group.
    When every group holds a bounded number of rows (say, at most k after a
    top-k filter) a window over the group is cheaper and equally safe.
    """
    if rows_per_group_bounded:
        total = F.sum(value).over(Window.partitionBy(*group))
        return df.withColumn(name, F.try_divide(F.col(value) * F.lit(100.0), total))
    totals = df.groupBy(*group).agg(F.sum(value).alias("__total"))
    return (df.join(totals, on=group, how="inner")
            .withColumn(name, F.try_divide(F.col(value) * F.lit(100.0), F.col("__total")))
            .drop("__total"))


def share_of_total(df: DataFrame, value: str, name: str = "share_pct") -> DataFrame:
    """``100 * value / sum(value)`` over the whole frame (pie slices); NULL if the
    sum is 0.

    ``df`` is kept once, as it is both summed and returned.  The total is an
    uncorrelated scalar subquery, computed once and inlined as a literal; no
    single-partition window, no join.
    """
    ensure_checkpoint_dir(df.sparkSession)
    df = df.checkpoint()
    total = df.select(F.sum(value)).scalar()
    return df.withColumn(name, F.try_divide(F.col(value) * F.lit(100.0), total))
