"""The append-only raw table: one row per page document.

Schema: id (bigint, 1.. in load order), batch_id, page, loaded_at, raw_json.
Stored as parquet partitioned by ``batch_id``, so reading one batch prunes to
its folder and "is batch N loaded" is a partition listing.

A batch is loaded at most once: loading takes the batches present in the
source that are absent from the table (an anti join on ``batch_id``), numbers
their rows and appends them.

Several writers may load at once.  A writer reserves its range of ids by
publishing (start, end, batches) as the next entry of the log beside the table
(``sources.commit_log``): ranges never overlap, so no id is given twice, and a
range whose load failed is not used again, as with any sequence.  The entry also
claims its batches: another writer that wants one of them before it is in the
table gets a ``Conflict``.  A failed load gives its claim up; one whose writer
was killed ends after ``LEASE_SECONDS``, or at once for a writer of the same name.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..operators.sequence import dense_index
from .commit_log import CommitLog, Conflict

#: how long the claim of a writer that has vanished keeps others off its batches
LEASE_SECONDS = 1800


def empty_bronze(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], S.BRONZE)


def read_bronze(spark: SparkSession, path: str) -> DataFrame:
    """The raw table at ``path``; an empty frame when nothing was loaded yet."""
    try:
        return spark.read.schema(S.BRONZE).parquet(path)
    except Exception as e:  # path does not exist yet
        if "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e):
            return empty_bronze(spark)
        raise


def next_batch_id(batches: DataFrame, column: str = "batch_id") -> Column:
    """``max(existing) + 1`` (1 when there is none) as a scalar subquery."""
    return batches.select((F.coalesce(F.max(column), F.lit(0)) + 1).cast("int")).scalar()


def missing_batches(available: DataFrame, loaded: DataFrame, column: str = "batch_id") -> DataFrame:
    """Distinct batch ids present in ``available`` but not in ``loaded``."""
    return (available.select(column).distinct()
            .join(loaded.select(column).distinct(), on=column, how="left_anti"))


def rows_to_load(available: DataFrame, loaded: DataFrame, column: str = "batch_id") -> DataFrame:
    """Rows of ``available`` whose batch is not loaded yet (whole batches only)."""
    return available.join(missing_batches(available, loaded, column), on=column, how="left_semi")


def assign_ids(rows: DataFrame, existing: DataFrame, order: list[str | Column] | None = None,
               name: str = "id") -> DataFrame:
    """Number ``rows`` after the largest id of ``existing`` (a sequence that
    starts at 1 and never reuses a value), in ``order`` (default batch, page)."""
    order = order or ["batch_id", "page"]
    start = existing.select((F.coalesce(F.max(name), F.lit(0)) + 1).cast("bigint")).scalar()
    return dense_index(rows, order, name, start=start)


def scan_batch(bronze: DataFrame, batch_id: int | None = None) -> DataFrame:
    """Rows of one batch (the latest when ``batch_id`` is None): id, batch_id,
    page, raw_json.  The equality on the partition column prunes folders."""
    if batch_id is None:
        target = bronze.select(F.max("batch_id")).scalar()
    else:
        target = F.lit(batch_id)
    return bronze.where(F.col("batch_id") == target).select("id", "batch_id", "page", "raw_json")


def constrained(rows: DataFrame) -> DataFrame:
    """``rows`` with batch_id and page enforced as NOT NULL while they are
    written: a row without either fails the job, nothing is committed."""
    fail = F.raise_error(F.lit("page rows without batch or page number; file names must be "
                               "batch_<N>/page_<P>.json"))
    return rows.withColumns({c: F.coalesce(c, fail.cast("int")) for c in ("batch_id", "page")})


def id_log(spark: SparkSession, path: str) -> CommitLog:
    """The reservations of the raw table at ``path``."""
    return CommitLog(spark, f"{path.rstrip('/')}_ids")


def reserve_ids(spark: SparkSession, path: str, n: int, batches: list[int], writer: str | None = None) -> tuple[int, int]:
    """(entry, first id) of ``n`` ids kept for this writer, who loads ``batches``.

    The first reservation of a table starts after its largest id; from then on
    the log alone says where the next range starts."""
    writer = writer or uuid.uuid4().hex
    log = id_log(spark, path)

    def make(number: int, last: dict | None) -> dict:
        now = time.time()
        open_claims = last["claims"] if last else {}
        claims = {}
        for batch, (who, since) in open_claims.items():
            if who != writer and now - since < LEASE_SECONDS:
                if int(batch) in batches:
                    raise Conflict(f"batch {batch} is being loaded by another writer")
                claims[batch] = [who, since]
        start = last["end"] + 1 if last else int(read_bronze(spark, path).agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]) + 1
        return {"start": start, "end": start + n - 1, "writer": writer, "batches": batches,
                "claims": claims | {str(b): [writer, now] for b in batches}}

    number, entry = log.append(make)
    return number, entry["start"]


def _release(spark: SparkSession, path: str, number: int) -> None:
    """Give up the claims of entry ``number``."""
    log = id_log(spark, path)
    mine = log.read(number)

    def make(_: int, last: dict) -> dict:
        claims = {b: c for b, c in last["claims"].items() if c[0] != mine["writer"] or int(b) not in mine["batches"]}
        return {**last, "claims": claims, "batches": [], "released": number}

    log.append(make)


def write_raw(rows: DataFrame, path: str, keys: DataFrame | None = None, writer: str | None = None) -> int:
    """Append page rows (batch_id, page, raw_json) to the raw table with reserved
    ids and the load time; returns the rows appended.

    Only (batch_id, page) are sorted to number the rows; ``keys`` gives them
    where they are known without reading the pages.  A repeated (batch_id, page)
    would repeat ids, so it fails the load before anything is written; so does a
    page that another writer has appended in the meantime.
    """
    spark = rows.sparkSession
    keys = (rows if keys is None else keys).select("batch_id", "page")
    numbered = dense_index(keys, ["batch_id", "page"], "id")
    held = numbered.groupBy("batch_id").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("page").alias("pages"),
                                            F.count("page").alias("known")).collect()  # one row per batch
    for r in held:
        if r.batch_id is None or r.known < r.n or r.pages < r.n:
            raise ValueError(f"page rows without batch or page number, or a page that is there twice: batch {r.batch_id}; "
                             "file names must be batch_<N>/page_<P>.json")
    if not held:
        return 0
    batches = sorted(r.batch_id for r in held)
    number, start = reserve_ids(spark, path, sum(r.n for r in held), batches, writer)
    try:
        there = read_bronze(spark, path).where(F.col("batch_id").isin(batches)).select("batch_id", "page")
        # no broadcast: a row a page, which looks small where the keys come from Parquet
        twice = there.join(keys.hint("merge"), ["batch_id", "page"], "left_semi").first()
        if twice is not None:
            raise Conflict(f"another writer has loaded batch {twice.batch_id}, page {twice.page} in the meantime")
        ids = numbered.withColumn("id", F.col("id") + F.lit(start - 1))
        new = constrained(rows).join(ids.hint("merge"), ["batch_id", "page"]).withColumn("loaded_at", F.current_timestamp())
        obs = Observation()
        out = new.select(*[f.name for f in S.BRONZE.fields]).observe(obs, F.count(F.lit(1)).alias("n"))
        out.write.mode("append").partitionBy("batch_id").parquet(path)
        return int(obs.get["n"])
    finally:
        _release(spark, path, number)


def append_batches(spark: SparkSession, pages: DataFrame, path: str, listed: DataFrame | None = None) -> int:
    """Load every batch of ``pages`` (batch_id, page, raw_json) not yet in the
    raw table at ``path``; returns the number of rows appended.

    The write is a single append job (a batch is all in or not at all).
    ``listed`` (batch_id, page of the same pages, from a listing) spares a read
    of the page texts.
    """
    bronze = read_bronze(spark, path)
    keys = None if listed is None else rows_to_load(listed, bronze)
    return write_raw(rows_to_load(pages, bronze), path, keys)
