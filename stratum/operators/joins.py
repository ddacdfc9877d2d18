"""Broadcast policy, and the left join that survives a hot key.

Explicit ``broadcast()`` hints are given only where the row count is bounded by
construction: a top-k list (k rows) in ``topk.keep_members``, one row per
partition or per dimension in ``sequence.dense_index`` and
``gold.surrogate_dims``.  Every other join is a plain equi-join: Spark compares
its size estimate with ``spark.sql.autoBroadcastJoinThreshold`` at plan time, and
AQE repeats the check on the real shuffle output.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: right rows of one key that a task should not have to meet alone
HOT_ROWS = 1_000_000
#: heavy hitters looked for; no more than 64 keys can hold 1/64 of the rows each
HOT_KEYS, TRACKED = 64, 10_000
MAX_SALTS = 1024

_SALT = "__salt"


def heavy_hitters(keys: DataFrame, key: str, hot_rows: int = HOT_ROWS) -> dict:
    """{key value: about its rows} of the values with ``hot_rows`` rows or more.

    One aggregate over the key column alone: an approximate top-k sketch per
    task, merged.  At most ``HOT_KEYS`` values come to the driver.
    """
    top = keys.where(F.col(key).isNotNull()).select(
        F.call_function("approx_top_k", F.col(key), F.lit(HOT_KEYS), F.lit(TRACKED)).alias("top")).first()["top"]
    return {r["item"]: r["count"] for r in top or [] if r["count"] >= hot_rows}


def left_join(left: DataFrame, right: DataFrame, key: str, keys: DataFrame | None = None,
              hot_rows: int = HOT_ROWS) -> DataFrame:
    """``left LEFT JOIN right USING (key)`` that survives a hot key on the right.

    AQE splits a skewed partition of an outer join on the preserved side only; a
    key with very many rows on the right would be met by one task.  So the hot
    keys are looked for first (in ``keys``, a cheaper frame with the right's key
    column, or the right itself).  Without any this is the plain left join.  Else
    the right rows of a hot key are dealt to salts and its left rows are repeated
    for each salt; all other rows have salt 0, and there is one left join on (key,
    salt).  A salt without right rows gives a left row without a match, which is
    left out: a hot key is known to have matches.
    """
    hot = heavy_hitters(right if keys is None else keys, key, hot_rows)
    if not hot:
        return left.join(right, key, "left")
    salts = min(MAX_SALTS, math.ceil(max(hot.values()) / hot_rows) + 1)
    is_hot = F.col(key).isin(list(hot))
    spread = [f.name for f in right.schema.fields if f.name != key]
    dealt = right.withColumn(_SALT, F.when(is_hot, F.pmod(F.xxhash64(*spread, F.monotonically_increasing_id()), F.lit(salts)))
                             .otherwise(0).cast("int")).withColumn("__matched", F.lit(True))
    every = F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    out = left.withColumn(_SALT, F.explode(every)).join(dealt, [key, _SALT], "left")
    # a null key is not hot
    lonely = F.coalesce(is_hot, F.lit(False)) & F.col("__matched").isNull()
    return out.where(~lonely).select(key, *[c for c in left.columns if c != key], *spread)
