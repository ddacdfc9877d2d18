"""A set of tables exported as one: readers meet the old set or the new, whole.

Every export writes its tables into a folder of its own and then publishes one
list (``_sets/<n>.json``, see ``commit_log``) that names the folder and rows of
each table.  Readers open the newest list only, so an export that fails half-way
leaves the one before it complete, and what it wrote is never read.
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .commit_log import CommitLog


def _log(spark: SparkSession, destination: str) -> CommitLog:
    return CommitLog(spark, f"{destination.rstrip('/')}/_sets")


def publish_set(tables: dict[str, DataFrame], destination: str) -> int:
    """Write all ``tables`` under ``destination`` and publish them together;
    returns the number of the set."""
    if not tables:
        raise ValueError("an export needs at least one table")
    spark = next(iter(tables.values())).sparkSession
    destination = destination.rstrip("/")
    folder = f"set-{uuid.uuid4().hex}"
    entry = {"folder": folder, "tables": {}}
    for name, df in tables.items():
        counted = Observation()
        df.observe(counted, F.count(F.lit(1)).alias("n")).write.parquet(f"{destination}/{folder}/{name}")
        entry["tables"][name] = {"rows": int(counted.get["n"]), "schema": df.schema.json()}
    entry["published_at"] = time.time()
    return _log(spark, destination).append(lambda number, last: entry)[0]


def published_set(spark: SparkSession, destination: str, number: int | None = None) -> dict:
    """The list of the newest (or the given) set; empty before the first."""
    log = _log(spark, destination)
    if number is not None:
        return log.read(number) or {}
    return log.last()[1] or {}


def read_set(spark: SparkSession, destination: str, names: list[str] | None = None,
             number: int | None = None) -> dict[str, DataFrame]:
    """name -> DataFrame of one published set (default: the newest, all tables).

    All frames are of the same set, whatever is published meanwhile."""
    entry = published_set(spark, destination, number)
    if not entry:
        raise FileNotFoundError(f"nothing published in {destination}" if number is None
                                else f"no set {number} in {destination}")
    wanted = list(entry["tables"]) if names is None else names
    lacking = [n for n in wanted if n not in entry["tables"]]
    if lacking:
        raise KeyError(f"not in the published set: {', '.join(lacking)}")
    root = f"{destination.rstrip('/')}/{entry['folder']}"
    return {n: spark.read.schema(T.StructType.fromJson(json.loads(entry["tables"][n]["schema"])))
            .parquet(f"{root}/{n}") for n in wanted}


def drop_old_sets(spark: SparkSession, destination: str, keep: int = 2, grace_hours: float = 24.0) -> int:
    """Remove the sets before the last ``keep``, and folders of failed exports older
    than ``grace_hours``; returns the folders removed.  A running export's folder
    is younger than that."""
    if keep < 1:
        raise ValueError("keep at least the newest set")
    log = _log(spark, destination)
    numbers = log.numbers()
    entries = {n: e for n in numbers if (e := log.read(n)) is not None}
    newest = sorted(entries)[-keep:]
    kept = {entries[n]["folder"] for n in newest}
    old = [n for n in entries if n not in newest]
    ended = {entries[n]["folder"] for n in old}
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(destination.rstrip("/"))
    fs = root.getFileSystem(conf)
    log.remove(old)  # first the lists, so that no reader is sent to a folder that goes
    removed = 0
    before = (time.time() - grace_hours * 3600) * 1000
    for status in fs.listStatus(root) if fs.exists(root) else []:
        name = status.getPath().getName()
        stray = name not in kept and name not in ended and status.getModificationTime() < before
        if name.startswith("set-") and (name in ended or stray):
            fs.delete(status.getPath(), True)
            removed += 1
    return removed
