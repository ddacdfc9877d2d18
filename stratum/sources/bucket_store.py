"""Keyed tables with bucket-level copy-on-write versions.

A table's rows are dealt to a fixed number of buckets by the hash of its bucket
column.  An upsert reads and rewrites the buckets that its batch touches; the
others stay where they are, so its cost follows the batch, not the table.

    <root>/<table>/_log/000000000007.json     version 7: which folder holds each bucket
    <root>/<table>/data/_attempt=<id>/_bucket=3/part-*.parquet

Every write attempt has a folder of its own, so two writers never share a file,
and what a failed or half-committed attempt leaves behind is named by no version
and read by nobody.  A version is published by creating the next entry of the
log (``CommitLog``): a writer that finds the number taken keeps its files if the
versions published meanwhile touch none of its buckets, and otherwise merges
again on top of them.

A version's manifest holds (attempt, rows) per bucket and the last epoch of each
streaming writer, so a replayed micro-batch is recognised, and a table's row
count needs no scan.  ``vacuum`` drops versions and the folders no kept version
names.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.upsert import upsert
from .commit_log import CommitLog, Conflict

BUCKETS = 64
BUCKET, ATTEMPT = "_bucket", "_attempt"
TRIES = 20

Prepare = Callable[[DataFrame, DataFrame], DataFrame]


class BucketStore:
    """Tables under ``root``: name -> (schema, bucket column).

    ``buckets`` is taken for tables that do not exist yet; an existing table
    keeps the number it was made with.  Size it to the table: a bucket is what one
    task rewrites at least (skewed buckets are split on write).
    """

    def __init__(self, spark: SparkSession, root: str, tables: dict[str, tuple[T.StructType, str]],
                 buckets: int | None = None):
        self.spark, self.root, self.tables, self.buckets = spark, root.rstrip("/"), tables, buckets or BUCKETS

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def log(self, name: str) -> CommitLog:
        return CommitLog(self.spark, f"{self.path(name)}/_log")

    # ------------------------------------------------------------------ versions
    def current_version(self, name: str) -> int | None:
        """The highest published version (None before the first); reads no table."""
        return self.log(name).last()[0] or None

    def versions(self, name: str) -> list[int]:
        log = self.log(name)
        return [n for n in log.numbers() if log.read(n) is not None]

    def _manifest(self, name: str, version: int | None) -> tuple[int, dict[str, Any]]:
        log = self.log(name)
        number, entry = log.last() if version is None else (version, log.read(version))
        if entry is None and version is not None:
            raise ValueError(f"{name} has no version {version}")
        return number, entry or {"buckets": self.buckets, "files": {}, "epochs": {}}

    def rows(self, name: str, version: int | None = None) -> int:
        return sum(n for _, n in self._manifest(name, version)[1]["files"].values())

    def bucket_of(self, name: str, buckets: int) -> Column:
        return F.pmod(F.hash(self.tables[name][1]), F.lit(buckets)).cast("int")

    def _scan(self, name: str, files: dict[str, list]) -> DataFrame:
        """Rows of the given buckets, with ``_bucket``."""
        schema = self.tables[name][0]
        if not files:
            return self.spark.createDataFrame([], T.StructType(schema.fields + [T.StructField(BUCKET, T.IntegerType())]))
        data = f"{self.path(name)}/data"
        paths = [f"{data}/{ATTEMPT}={attempt}/{BUCKET}={b}" for b, (attempt, _) in sorted(files.items())]
        full = T.StructType(schema.fields + [T.StructField(ATTEMPT, T.StringType()), T.StructField(BUCKET, T.IntegerType())])
        return self.spark.read.schema(full).option("basePath", data).parquet(*paths).drop(ATTEMPT)

    def read(self, name: str, version: int | None = None, buckets: list[int] | None = None) -> DataFrame:
        """A version (default: the current one), or some buckets of it; empty
        before the first upsert.  Only the files of that version are listed."""
        files = self._manifest(name, version)[1]["files"]
        if buckets is not None:
            files = {str(b): files[str(b)] for b in buckets if str(b) in files}
        return self._scan(name, files).drop(BUCKET)

    # -------------------------------------------------------------------- writes
    def _write(self, name: str, rows: DataFrame) -> dict[str, list]:
        """Write ``rows`` (with ``_bucket``) as an attempt of its own: {bucket: [attempt, rows]}."""
        attempt, seen = uuid.uuid4().hex, Observation()
        folder = f"{self.path(name)}/data/{ATTEMPT}={attempt}"
        # a task per bucket; AQE joins small ones and splits a hot one
        (rows.hint("rebalance", F.col(BUCKET)).observe(seen, F.count(F.lit(1)).alias("n"))
         .write.partitionBy(BUCKET).parquet(folder))
        written = int(seen.get["n"])
        if not written:
            return {}
        schema = T.StructType(self.tables[name][0].fields + [T.StructField(BUCKET, T.IntegerType())])
        found = self.spark.read.schema(schema).parquet(folder).groupBy(BUCKET).count().collect()  # a row per bucket
        if sum(r["count"] for r in found) != written:
            raise RuntimeError(f"{name}: {written} rows written to {folder}, {sum(r['count'] for r in found)} readable; not published")
        return {str(r[BUCKET]): [attempt, r["count"]] for r in found}

    def committed(self, name: str, writer: str, epoch: int) -> int | None:
        """The version that ``epoch`` of ``writer`` was based on (0: an empty table),
        or None if the epoch has not been committed."""
        log, base = self.log(name), None
        for number in reversed(self.versions(name)):
            entry = log.read(number)
            if entry["epochs"].get(writer, -1) < epoch:
                break
            base = entry["base"]
        return base

    def upsert(self, name: str, source: DataFrame, key: list[str], prepare: Prepare | None = None,
               writer: str | None = None, epoch: int | None = None) -> int:
        """Merge ``source`` (keys unique) into the table and publish the result;
        returns the table's rows.

        ``prepare(source, current)`` may leave out source rows in view of the current
        rows of the touched buckets.  With ``writer`` and ``epoch`` a batch that has
        been committed already changes nothing.
        """
        columns = self.tables[name][0].fieldNames()
        log = self.log(name)
        for _ in range(TRIES):
            version, entry = self._manifest(name, None)
            if writer is not None and entry["epochs"].get(writer, -1) >= epoch:
                return self.rows(name, version or None)
            bucket = self.bucket_of(name, entry["buckets"])
            new = source.withColumn(BUCKET, bucket)
            touched = sorted(r[BUCKET] for r in new.select(BUCKET).distinct().collect())  # at most one per bucket
            old = {str(b): entry["files"][str(b)] for b in touched if str(b) in entry["files"]}
            current = self._scan(name, old).drop(BUCKET)
            accepted = prepare(source, current) if prepare else source
            merged = upsert(current, accepted.select(*columns), key) if old else accepted.select(*columns)
            mine = self._write(name, merged.withColumn(BUCKET, bucket)) if touched else {}
            while True:  # publish; again while only other buckets have changed
                files = {b: f for b, f in entry["files"].items() if int(b) not in touched} | mine
                epochs = entry["epochs"] | ({writer: epoch} if writer is not None else {})
                if log.publish(version + 1, {"buckets": entry["buckets"], "files": files, "epochs": epochs,
                                             "base": version, "touched": touched}):
                    return sum(n for _, n in files.values())
                before = {str(b): entry["files"].get(str(b)) for b in touched}
                seen, (version, entry) = version, self._manifest(name, None)
                done = writer is not None and entry["epochs"].get(writer, -1) >= epoch
                if version == seen or done or any(entry["files"].get(b) != f for b, f in before.items()):
                    break  # not readable yet, the same epoch, or the same buckets: start again
        raise Conflict(f"{name}: other writers were first {TRIES} times")

    # ------------------------------------------------------------------- clearing
    def vacuum(self, name: str, keep: int = 2, grace_hours: float = 24.0) -> int:
        """Drop all but the last ``keep`` versions and the bucket folders that none of
        the kept names; returns the folders removed.

        Folders younger than ``grace_hours`` stay: they may belong to an attempt
        that is about to be published.
        """
        if keep < 1:
            raise ValueError("the current version is kept")
        log = self.log(name)
        versions = self.versions(name)
        named = {f"{ATTEMPT}={a}/{BUCKET}={b}" for n in versions[-keep:] for b, (a, _) in log.read(n)["files"].items()}
        log.remove(versions[:-keep])
        jvm = self.spark._jvm
        data = jvm.org.apache.hadoop.fs.Path(f"{self.path(name)}/data")
        fs = data.getFileSystem(self.spark._jsc.hadoopConfiguration())
        limit = jvm.java.lang.System.currentTimeMillis() - grace_hours * 3_600_000
        removed = 0
        for attempt in fs.listStatus(data) if fs.exists(data) else []:
            left = 0
            for bucket in fs.listStatus(attempt.getPath()):
                if not bucket.isDirectory():
                    continue
                left += 1
                place = f"{attempt.getPath().getName()}/{bucket.getPath().getName()}"
                if place not in named and bucket.getModificationTime() <= limit:
                    fs.delete(bucket.getPath(), True)
                    removed, left = removed + 1, left - 1
            if not left and attempt.getModificationTime() <= limit:
                fs.delete(attempt.getPath(), True)
        return removed
