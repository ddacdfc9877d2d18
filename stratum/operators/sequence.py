"""Consecutive ids 1..n in a total order, computed without a one-partition window.

``row_number() OVER (ORDER BY v)`` with no partition clause makes Spark move every
row into a single task.  Here the rows are range-partitioned on the order
columns and sorted inside each partition; each row gets its position inside its
partition, every partition gets the number of rows before it (one small
aggregate with one row per partition), and the id is the sum of the two.

The range bounds come from sampling, so two evaluations of the same lineage can
cut the data differently.  The tagged rows are therefore written once with a
reliable checkpoint (into the cluster's shared ``spark.checkpoint.dir``) and both
the per-partition counts and the ids are computed from that one copy; this also
means a lost executor cannot renumber anything.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

_PID = "__pid"
_POS = "__pos"


def _num_partitions(df: DataFrame, num_partitions: int | None) -> int:
    if num_partitions:
        return num_partitions
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def dense_index(df: DataFrame, order: list[str | Column], name: str = "idx",
                start: int | Column = 1, num_partitions: int | None = None,
                key: list[str] | None = None, columns: tuple[str, ...] = ()) -> DataFrame:
    """Add ``name`` (bigint): ``start``, ``start``+1, ... following ``order``.

    ``order`` should be a total order (add a unique column as last tie-break);
    with ties the numbering among tied rows is arbitrary but fixed.  ``start``
    may be a Column (for instance a scalar subquery ``max(id) + 1``).  With
    ``key`` (columns that identify a row) only the key and the order columns are
    sorted and checkpointed, and the numbers are joined back to the rows;
    ``columns`` names what ``order`` refers to in Column expressions.
    """
    ensure_checkpoint_dir(df.sparkSession)
    n = _num_partitions(df, num_partitions)
    narrow = df
    if key:
        narrow = df.select(*dict.fromkeys([*key, *(c for c in order if isinstance(c, str)), *columns]))
    tagged = (
        narrow.repartitionByRange(n, *order)
        .sortWithinPartitions(*order)
        # monotonically_increasing_id = (partition index << 33) + row position,
        # assigned in the sorted order of the partition.
        .withColumn(_PID, F.spark_partition_id())
        .withColumn(_POS, F.monotonically_increasing_id()
                    - F.shiftleft(F.col(_PID).cast("bigint"), 33))
        .checkpoint(eager=True)
    )
    # One row per partition: bounded by the partition count, so the ordered
    # window and the broadcast below are of a proven size.
    offsets = (
        tagged.groupBy(_PID).agg(F.count(F.lit(1)).alias("__n"))
        .withColumn("__off", F.coalesce(
            F.sum("__n").over(Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0)))
        .select(_PID, "__off")
    )
    start_col = start if isinstance(start, Column) else F.lit(start)
    numbered = (
        tagged.join(F.broadcast(offsets), _PID)
        .withColumn(name, (F.col("__off") + F.col(_POS) + start_col).cast("bigint"))
        .drop(_PID, _POS, "__off")
    )
    return df.join(numbered.select(*key, name), key) if key else numbered
