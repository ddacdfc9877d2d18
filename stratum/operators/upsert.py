"""Staging overwrite and key-based upsert (MERGE semantics) on plain tables.

``upsert`` is a pure DataFrame transform: target rows whose key is in the
source are replaced by the source row (every non-key column, ``loaded_at``
included, takes the source value); unmatched source rows are inserted; nothing
is deleted.  Keys match with ``=``, so a NULL key never matches and such rows
pass through on both sides, as in ``MERGE ... ON t.k = s.k``.

Writing the result is done by the caller into a new table version (Spark cannot
overwrite a parquet table that the same job is reading).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .quality import assert_same_columns


def upsert(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """``MERGE INTO target USING source ON keys`` update-all / insert-all."""
    cols = target.columns
    src = source
    if "loaded_at" in cols and "loaded_at" not in source.columns:
        src = src.withColumn("loaded_at", F.current_timestamp())
    assert_same_columns(src.columns, cols, target_name="upsert target", ignore=())
    src = src.select(*cols)
    # Source keys are unique after keep-last, so this anti join has no hot key
    # on the build side; AQE broadcasts the key set when it is small.
    kept = target.join(src.select(*keys), on=keys, how="left_anti")
    return kept.unionByName(src)


def stage_frame(df: DataFrame, staging_columns: list[str], name: str = "staging") -> DataFrame:
    """Validate and order a frame for a staging overwrite.

    Raises when the column sets differ (``loaded_at`` may be missing from the
    frame); the returned frame has the staging column order with ``loaded_at``
    set to the current time when the frame lacks it.
    """
    assert_same_columns(df.columns, staging_columns, target_name=name)
    out = df
    if "loaded_at" in staging_columns and "loaded_at" not in df.columns:
        out = out.withColumn("loaded_at", F.current_timestamp())
    return out.select(*staging_columns)


def overwrite_table(df: DataFrame, staging_columns: list[str], path: str,
                    name: str = "staging", fmt: str = "parquet") -> int:
    """Overwrite a staging table at ``path`` and return the rows written.

    The row count is taken with ``observe`` inside the write job, so the data
    is not scanned a second time.
    """
    obs = Observation()
    staged = stage_frame(df, staging_columns, name).observe(obs, F.count(F.lit(1)).alias("rows"))
    staged.write.mode("overwrite").format(fmt).save(path)
    return int(obs.get["rows"])
