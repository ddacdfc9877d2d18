"""Which page files have been loaded: a stored ledger beside the raw table.

    <raw table>_files/data/<load>/part-*.parquet   the files of one load: batch, page, folder, path, length, time
    <raw table>_files/_log/000000000007.json       entry 7: the loads that count, and the time of every batch folder

Finding new files lists the batch folders (one entry each) and then the files of
those folders only whose modification time is not the recorded one: a loaded batch
that nobody has touched is not listed again, and one that was loaded half-way, or
has had pages since, is finished.  On a file system whose folders carry no time
every folder is listed each time.

Folders are worked off in steps of a fixed number, so neither the driver's list of
paths nor what a lost run has to do again grows with the backlog.  A folder may hold
any number of files: ``page_P.json`` files under ``file:`` paths are listed and read by
the executors and the driver never sees them one by one.  Files of the other layout and
of other file systems come from Spark's readers, whose listing the driver holds.

The raw table decides what is loaded: a page that is in it is never appended again, so a run that
ends between the append and the ledger's entry costs a listing and nothing else.
"""

from __future__ import annotations

import math
import os
import re
import time
import uuid
from collections.abc import Iterator
from fnmatch import fnmatchcase
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.json_pages import compact_document
from ..functions.misc import number_in_name
from ..session import ensure_checkpoint_dir
from . import bronze as B
from .commit_log import CommitLog

#: layout -> (name of a batch folder, glob of the file names below it), see ``pages.LAYOUTS``
FOLDERS = {"fetched": (r"batch_(\d+)", "page_*.json"), "written": (r"batch_id=(\d+)", "part-*")}
FILES = "batch_id int, page int, folder string, path string, length long, modified timestamp"
#: batch folders that one step lists and loads
FOLDERS_PER_STEP = 256
#: files of half-loaded folders that are read by path; beyond it the folders are read whole
PATHS_PER_READ = 10_000
#: files that one task reads: Spark packs 30 small ones, so a backlog is cut into very many tasks
FILES_PER_TASK = 1_000
#: rows, and bytes of documents, that a Python worker holds at a time
ROWS_PER_BATCH, BYTES_PER_BATCH = 1_000, 8 << 20
#: a folder changed this shortly before it was looked at is looked at again next time
SETTLE_MS = 2_000
#: loads after which the ledger is written anew as one
LOADS_KEPT = 32


def batch_folders(spark: SparkSession, root: str, layout: str = "fetched") -> dict[str, int]:
    """{folder name: modification time in ms} of the batch folders, by number; lists
    ``root`` alone, no folder below it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    found = {}
    for status in fs.listStatus(path) if fs.exists(path) else []:
        name = status.getPath().getName()
        if status.isDirectory() and re.fullmatch(FOLDERS[layout][0], name):
            found[name] = status.getModificationTime()
    return dict(sorted(found.items(), key=lambda f: int(re.search(r"\d+", f[0])[0])))


def _inside(layout: str) -> dict[str, Any]:
    return {"pathGlobFilter": FOLDERS[layout][1], "recursiveFileLookup": True}


def _local(spark: SparkSession, paths: list[str], layout: str) -> list[str] | None:
    """``paths`` as Spark's readers name them (``file:/a/b``), if a Python worker can
    list and open what is there; else None."""
    if layout != "fetched":
        return None
    path_of, conf, found = spark._jvm.org.apache.hadoop.fs.Path, spark._jsc.hadoopConfiguration(), []
    for path in paths:
        if not re.match(r"file:/[^/]", path):
            path = path_of(path)
            path = path.getFileSystem(conf).makeQualified(path).toString()
            if not path.startswith("file:/"):
                return None
        found.append(path)
    return found


def _files_at(path: str, pattern: str) -> Iterator[tuple[str, int, int]]:
    """(path, length, modification time in ms) of the files at a local path, as Spark's
    listing has them: of all folders below, without hidden, empty and vanished ones.
    Folders are walked entry by entry, however many there are."""
    def kept(entry: os.DirEntry | str, name: str) -> Iterator[tuple[str, int, int]]:
        at = os.stat(entry)
        if at.st_size and fnmatchcase(name, pattern):
            yield os.fspath(entry), at.st_size, at.st_mtime_ns // 1_000_000

    if not os.path.isdir(path):
        yield from kept(path, os.path.basename(path))
        return
    with os.scandir(path) as entries:
        for entry in entries:
            name = entry.name
            hidden = name.startswith(".") or (name.startswith("_") and "=" not in name) or name.endswith("._COPYING_")
            if hidden and not name.startswith(("_metadata", "_common_metadata")):
                continue
            try:
                yield from _files_at(entry.path, pattern) if entry.is_dir() else kept(entry, name)
            except FileNotFoundError:
                continue


def _listed(spark: SparkSession, paths: list[str], layout: str) -> DataFrame:
    """path, length, ms of the files at qualified ``file:`` paths; a task lists a folder."""
    pattern = FOLDERS[layout][1]

    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for batch in batches:
            for given in batch["given"].to_pylist():
                for path, length, ms in _files_at(given.removeprefix("file:"), pattern):
                    rows.append({"path": f"file:{path}", "length": length, "ms": ms})
                    if len(rows) == ROWS_PER_BATCH:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows = []
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)

    schema = pa.schema([("path", pa.string()), ("length", pa.int64()), ("ms", pa.int64())])
    given = spark.createDataFrame([(p,) for p in paths], "given string")
    return given.mapInArrow(lists, "path string, length long, ms long")


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``path`` with the bytes of the file there."""
    paths, docs, held = [], [], 0
    for batch in batches:
        for path in batch["path"].to_pylist():
            with open(path.removeprefix("file:"), "rb") as file:
                docs.append(file.read())
            paths.append(path)
            held += len(docs[-1])
            if len(docs) >= ROWS_PER_BATCH or held >= BYTES_PER_BATCH:
                yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(docs, pa.binary())], ["path", "doc"])
                paths, docs, held = [], [], 0
    if docs:
        yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(docs, pa.binary())], ["path", "doc"])


def list_files(spark: SparkSession, root: str, folders: list[str], layout: str = "fetched") -> DataFrame:
    """The page files (``FILES``) of some batch folders, from the listing alone."""
    paths = [f"{root.rstrip('/')}/{f}" for f in folders]
    local = _local(spark, paths, layout)
    if local is not None:
        files = _listed(spark, local, layout).withColumn("modificationTime", F.timestamp_millis("ms"))
    else:
        files = spark.read.format("binaryFile").options(**_inside(layout)).load(paths)
    folder = F.regexp_extract("path", rf"/({FOLDERS[layout][0].replace('(', '(?:')})/[^/]+(?:/[^/]+)?$", 1)
    return files.select(number_in_name("path", "batch").alias("batch_id"), number_in_name("path", "page").alias("page"),
                        folder.alias("folder"), "path", "length", F.col("modificationTime").alias("modified"))


def read_files(spark: SparkSession, paths: list[str], layout: str = "fetched") -> DataFrame:
    """batch_id, page, raw_json of the page files in folders, or of files, by path.

    Where the executors read, the folders are listed here (a job) and the paths dealt
    to as many tasks as the files need."""
    local = _local(spark, paths, layout)
    if local is not None:
        ensure_checkpoint_dir(spark)
        found = _listed(spark, local, layout).select("path").checkpoint()
        docs = (found.repartition(_tasks(spark, found.count()), "path").mapInArrow(_documents, "path string, doc binary")
                .select(F.col("doc").cast("string").alias("value"), "path"))
    else:
        docs = (spark.read.text(paths, wholetext=True, **_inside(layout))
                .select("value", F.col("_metadata.file_path").alias("path")))
    return docs.select(number_in_name("path", "batch").alias("batch_id"), number_in_name("path", "page").alias("page"),
                       compact_document("value").alias("raw_json"))


class FileLedger:
    """The ledger of the raw table at ``bronze_path``."""

    def __init__(self, spark: SparkSession, bronze_path: str):
        self.spark, self.root = spark, f"{bronze_path.rstrip('/')}_files"
        self.log = CommitLog(spark, f"{self.root}/_log")

    def state(self) -> dict[str, Any]:
        """{"loads": ids that count, "folders": {name: recorded time}}."""
        return self.log.last()[1] or {"loads": [], "folders": {}}

    def _read(self, loads: list[str]) -> DataFrame:
        if not loads:
            return self.spark.createDataFrame([], FILES)
        return self.spark.read.schema(FILES).parquet(*[f"{self.root}/data/{load}" for load in loads])

    def files(self) -> DataFrame:
        """Every file on record."""
        return self._read(self.state()["loads"])

    def store(self, files: DataFrame) -> tuple[str, int]:
        """Write ``files`` as a load that does not count yet: (its id, files)."""
        load, seen = uuid.uuid4().hex, Observation()
        files.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(f"{self.root}/data/{load}")
        return load, int(seen.get["n"])

    def publish(self, load: str | None, folders: dict[str, int]) -> None:
        """Let ``load`` count, with the folders' times as they were seen before."""
        mine, replaced = [load] if load else [], []
        loads = self.state()["loads"]
        if len(loads) >= LOADS_KEPT:
            replaced, mine = loads, [self.store(self._read([*loads, *mine]))[0]]

        def make(_: int, last: dict | None) -> dict:
            last = last or {"loads": [], "folders": {}}
            if not set(replaced) <= set(last["loads"]):  # written anew by another one meanwhile
                return {"loads": [*last["loads"], *([load] if load else [])], "folders": last["folders"] | folders}
            return {"loads": [n for n in last["loads"] if n not in replaced] + mine, "folders": last["folders"] | folders}

        self.log.append(make)


def changed_folders(spark: SparkSession, root: str, bronze_path: str, layout: str = "fetched") -> dict[str, int]:
    """Batch folders that may hold files not on record, with the time to record once
    they are loaded (0: look again)."""
    now, known = time.time() * 1000, FileLedger(spark, bronze_path).state()["folders"]
    return {name: at if now - at > SETTLE_MS else 0 for name, at in batch_folders(spark, root, layout).items()
            if not at or known.get(name) != at}


def changed_files(spark: SparkSession, root: str, bronze_path: str, layout: str = "fetched") -> DataFrame:
    """Files on record whose length or time is another now (they are not loaded
    again, the raw table is append-only); lists every folder."""
    folders = list(batch_folders(spark, root, layout))
    if not folders:
        return spark.createDataFrame([], FILES)
    old = FileLedger(spark, bronze_path).files().select("path", F.col("length").alias("_length"), F.col("modified").alias("_modified"))
    return (list_files(spark, root, folders, layout).join(old, "path")
            .where("length <> _length OR modified <> _modified").select("batch_id", "page", "folder", "path", "length", "modified"))


def _tasks(spark: SparkSession, files: int) -> int:
    """Tasks for that many small files: enough for all cores, and no more than needed."""
    return max(4 * spark.sparkContext.defaultParallelism, math.ceil(files / FILES_PER_TASK))


def _load_step(ledger: FileLedger, root: str, bronze_path: str, folders: dict[str, int], layout: str, writer: str | None) -> int:
    spark, names = ledger.spark, list(folders)
    batches = [int(re.search(r"\d+", n)[0]) for n in names]
    listed = list_files(spark, root, names, layout)
    on_record = ledger.files().where(F.col("folder").isin(names)).select("path")
    listed = listed.coalesce(_tasks(spark, 0))
    # a row a file takes a few bytes as Parquet: by that size Spark would broadcast millions
    load, n_new = ledger.store(listed.join(on_record.hint("merge"), "path", "left_anti").select(*listed.columns))
    if not n_new:
        ledger.publish(None, folders)
        return 0
    there = B.read_bronze(spark, bronze_path).where(F.col("batch_id").isin(batches)).select("batch_id", "page")
    new = ledger._read([load])  # as written: the same files in every job below
    # a page without number stays in, and fails the load
    pending = new.join(there.hint("merge"), ["batch_id", "page"], "left_anti")
    by_folder = {r.folder: r.n for r in pending.groupBy("folder").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row a folder
    wanted = sum(by_folder.values())
    if wanted:
        loaded = {r.batch_id for r in there.select("batch_id").distinct().collect()}
        half = [n for n, b in zip(names, batches) if b in loaded and n in by_folder]
        whole = [f"{root.rstrip('/')}/{n}" for n in by_folder if n not in half]
        if sum(by_folder[n] for n in half) <= PATHS_PER_READ:
            paths = whole + [r.path for r in pending.where(F.col("folder").isin(half)).select("path").collect()]
        else:
            paths = whole + [f"{root.rstrip('/')}/{n}" for n in half]
        rows = read_files(spark, paths, layout).coalesce(_tasks(spark, wanted))
        if half:  # pages that are in the table already
            rows = rows.join(there, ["batch_id", "page"], "left_anti")
        appended = B.write_raw(rows, bronze_path, pending, writer)
        if appended != wanted:
            raise RuntimeError(f"{wanted} page files listed, {appended} loaded: files have gone meanwhile; run it again")
    ledger.publish(load, folders)
    return wanted


def load_new_files(spark: SparkSession, root: str, bronze_path: str, layout: str = "fetched",
                   writer: str | None = None, step: int = FOLDERS_PER_STEP) -> int:
    """Append every page file that is not in the raw table yet; rows appended.

    ``step`` batch folders at a time, by batch number, each with ids, pages and
    ledger committed before the next."""
    ledger = FileLedger(spark, bronze_path)
    todo = list(changed_folders(spark, root, bronze_path, layout).items())
    return sum(_load_step(ledger, root, bronze_path, dict(todo[i:i + step]), layout, writer)
               for i in range(0, len(todo), step))
