"""Intermediate tables in the shared checkpoint folder, and bounded Arrow batches."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import ensure_checkpoint_dir


def stored(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """``df`` written once as Parquet under ``spark.checkpoint.dir`` and read back.

    Cuts the lineage, survives lost executors and, unlike ``checkpoint()``,
    keeps columns compressed and prunable.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: rows of a file that are worth a task of their own
FILE_ROWS = 1 << 16


def few_files(df: DataFrame, rows: int, file_rows: int = FILE_ROWS) -> DataFrame:
    """``df``, whose last step reads and makes at most ``rows`` rows, in no more
    partitions than ``file_rows`` a partition call for, or than the session has
    cores: a small table in many files takes longer to write and to read again than
    its rows do.  Never makes more partitions; a large table keeps those it has."""
    return df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // file_rows)))


def counted(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """``df`` stored, and its number of rows, counted while it is written."""
    seen = Observation()
    df = stored(df.observe(seen, F.count("*").alias("n")), name)
    return df, seen.get["n"]


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Spark removes the shuffle files of every query that ends inside, and not only
    once the driver collects the plans; where one is wanted again, it is made again."""
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


#: Spark's default and ours: batches of texts and sets stay small next to a heap
_BATCH, _DEFAULT_BYTES, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 64 << 20, 4 << 20


def map_batches(df: DataFrame, fn: Callable, schema: StructType | str) -> DataFrame:
    """``mapInArrow`` with batches of ``BATCH_BYTES``, unless the session says otherwise."""
    conf = df.sparkSession.conf
    if conf.get(_BATCH, None) in (None, f"{_DEFAULT_BYTES}b", "64m", "64MB"):
        conf.set(_BATCH, str(BATCH_BYTES))
    return df.mapInArrow(fn, schema)


_made: dict[str, tuple[Any, Any]] = {}


def once_per_worker(name: str, value: Any, make: Callable[[Any], Any]) -> Any:
    """``make(value)``, kept in this Python worker for its next tasks.

    ``value`` is a broadcast's value, which the worker holds anyway; another one
    under the same name replaces what is kept."""
    held = _made.get(name)
    if held is None or held[0] is not value:
        _made.pop(name, None)
        held = _made[name] = (value, make(value))
    return held[1]
