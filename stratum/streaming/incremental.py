"""Incremental loading of page files with Structured Streaming.

``stream_pages_to_bronze`` watches the batch folders and appends each new page
file to the raw table exactly once (the stream's checkpoint records which files
were processed, so it is per file, stricter than "is the batch loaded").  With
``trigger(availableNow=True)`` it works as an incremental batch job: process
everything new, then stop.

``stream_pages_to_silver`` additionally upserts every micro-batch into the
silver tables (``foreachBatch``): all batches it holds in one upsert.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.json_pages import compact_document
from ..functions.misc import number_in_name
from ..sources import bronze as B
from ..sources.pages import LAYOUTS

#: page files in a micro-batch: a backlog is worked off in bounded steps
MAX_FILES = 10_000


def page_file_stream(spark: SparkSession, page_root: str, max_files: int | None = None,
                     layout: str = "fetched") -> DataFrame:
    """Streaming rows (batch_id, page, raw_json), one per new page file."""
    reader = spark.readStream.format("text").option("wholetext", True)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    batches, pages = LAYOUTS[layout]
    files = reader.load(f"{page_root.rstrip('/')}/{batches}/{pages}").select(
        F.col("value").alias("doc"), F.col("_metadata.file_path").alias("path"))
    return files.select(
        number_in_name("path", "batch").alias("batch_id"),
        number_in_name("path", "page").alias("page"),
        compact_document("doc").alias("raw_json"))


def _append_micro_batch(batch: DataFrame, bronze_path: str, writer: str | None = None) -> list[int]:
    """Append the pages that are not in the raw table; the batch ids met.

    ``foreachBatch`` is at-least-once: a micro-batch retried after its write but
    before the stream's commit must not append its pages again.  Only the
    partitions of the micro-batch's own batches are looked at.
    """
    ids = sorted(r.batch_id for r in batch.select("batch_id").distinct().collect() if r.batch_id is not None)
    existing = B.read_bronze(batch.sparkSession, bronze_path)
    loaded = existing.where(F.col("batch_id").isin(ids)).select("batch_id", "page")
    B.write_raw(batch.join(loaded, ["batch_id", "page"], "left_anti"), bronze_path, writer=writer)
    return ids


def _start(stream: DataFrame, write, checkpoint: str, available_now: bool):
    w = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def stream_pages_to_bronze(spark: SparkSession, page_root: str, bronze_path: str,
                           checkpoint: str, available_now: bool = True,
                           max_files: int | None = MAX_FILES, layout: str = "fetched"):
    """Start the stream; returns the StreamingQuery (``awaitTermination`` it
    for an availableNow run).  A micro-batch has at most ``max_files`` pages."""
    def write(batch: DataFrame, epoch_id: int) -> None:
        _append_micro_batch(batch, bronze_path, checkpoint)

    return _start(page_file_stream(spark, page_root, max_files, layout), write, checkpoint, available_now)


def stream_pages_to_silver(spark: SparkSession, page_root: str, root: str,
                           checkpoint: str, available_now: bool = True,
                           buckets: int | None = None, database: str | None = None,
                           strict: bool = True, max_files: int | None = MAX_FILES, layout: str = "fetched"):
    """Like ``stream_pages_to_bronze``, then upsert the micro-batch's own pages
    into silver: all its batches in one upsert per table, the last copy of a key
    by (batch, raw id, position).

    The pages are found in the raw table by (batch, page), also those a failed
    attempt has already appended.  Every table's new version carries the stream's
    name (its checkpoint folder) and the epoch, so an epoch that Spark replays
    writes only what it had not committed.  A late page of an older batch adds what
    is new and never overwrites a later batch."""
    from ..plans.pipeline import _p, load_curated

    bronze_path = _p(root, "raw", "api_data")

    def write(batch: DataFrame, epoch_id: int) -> None:
        if batch.isEmpty():
            return
        ids = _append_micro_batch(batch, bronze_path, checkpoint)
        spark = batch.sparkSession
        pages = batch.select("batch_id", "page").distinct()
        raw = B.read_bronze(spark, bronze_path).where(F.col("batch_id").isin(ids))
        mine = raw.select("id", "batch_id", "page", "raw_json").join(pages, ["batch_id", "page"], "left_semi")
        load_curated(spark, root, strict=strict, buckets=buckets, database=database, pages=mine,
                     writer=checkpoint, epoch=epoch_id)

    return _start(page_file_stream(spark, page_root, max_files, layout), write, checkpoint, available_now)
