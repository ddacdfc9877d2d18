"""Page files written by the executors under their own names: ``batch_N/page_P.json``.

A Python data source writer.  Every task writes its pages into one staging folder
of the job, each under a temporary name first and then moved to its own, so a task
that is run again (a lost executor, speculation) replaces its files by the same.
The job makes the staging folder, the tasks only folders in it.
The commit counts the files of every batch against the rows the tasks report and
then moves the batch folders to their place, one move a batch.  A job that fails,
or whose commit does, removes what it has written: readers meet whole batches only.

The staging folder's name starts with ``_``, which no scan reads.  ``root`` is a
path or URI of a file system that ``pyarrow.fs`` knows and that all executors
share; a folder must be movable there (HDFS, a mounted folder).  The package must
be importable in the Python workers.
"""

from __future__ import annotations

import os
import re
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

from pyarrow import fs as pafs
from pyspark.sql import DataFrame, Row
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

FORMAT = "page_files"


def open_folder(root: str) -> tuple[pafs.FileSystem, str]:
    """(file system, path) of a path or URI, also as Hadoop writes it (``file:/x``)."""
    local = re.fullmatch(r"file:/+(.*)", root)
    if local:
        return pafs.LocalFileSystem(), "/" + local[1].rstrip("/")
    if "://" in root:
        files, path = pafs.FileSystem.from_uri(root)
        return files, path.rstrip("/")
    return pafs.LocalFileSystem(), root.rstrip("/")


def _exists(files: pafs.FileSystem, path: str) -> bool:
    return files.get_file_info(path).type != pafs.FileType.NotFound


def _entries(files: pafs.FileSystem, path: str) -> int:
    """Files in a folder; ``FileSelector`` holds them all, so a local folder is walked."""
    if not isinstance(files, pafs.LocalFileSystem):
        return len(files.get_file_info(pafs.FileSelector(path)))
    with os.scandir(path) as entries:
        return sum(1 for _ in entries)


@dataclass
class PagesWritten(WriterCommitMessage):
    """Rows a task has written, by batch."""

    rows: dict[int, int]


class PageFileWriter(DataSourceWriter):
    def __init__(self, root: str, overwrite: bool):
        self.root, self.overwrite = root, overwrite
        self.job = f"_job-{uuid.uuid4().hex}"
        files, _, staging = self._folders()
        files.create_dir(f"{staging}/_tmp")

    def _folders(self) -> tuple[pafs.FileSystem, str, str]:
        files, root = open_folder(self.root)
        return files, root, f"{root}/{self.job}"

    def write(self, iterator: Iterator[Row]) -> PagesWritten:
        files, _, staging = self._folders()
        attempt, rows = f"{staging}/_tmp/{uuid.uuid4().hex}", Counter()
        for row in iterator:
            batch, page, document = row["batch_id"], row["page"], row["raw_json"]
            if batch is None or page is None or batch < 0 or page < 0 or document is None:
                raise ValueError(f"a page needs batch_id and page from 0 on and a document: batch {batch}, page {page}")
            if not rows:
                files.create_dir(attempt, recursive=False)
            if batch not in rows:
                files.create_dir(f"{staging}/batch_{batch}", recursive=False)
            with files.open_output_stream(f"{attempt}/page") as out:
                out.write(document.encode())
            target = f"{staging}/batch_{batch}/page_{page}.json"
            if _exists(files, target):  # of an attempt before this one; not every store replaces on a move
                files.delete_file(target)
            files.move(f"{attempt}/page", target)
            rows[batch] += 1
        return PagesWritten(dict(rows))

    def commit(self, messages: list[PagesWritten | None]) -> None:
        files, root, staging = self._folders()
        rows: Counter = Counter()
        for message in messages:
            rows.update(message.rows if message else {})
        for batch, n in sorted(rows.items()):
            there = _entries(files, f"{staging}/batch_{batch}")
            if there != n:
                raise ValueError(f"batch {batch}: {n} rows but {there} page files; a page is there twice")
            if not self.overwrite and _exists(files, f"{root}/batch_{batch}"):
                raise FileExistsError(f"{root}/batch_{batch} exists; overwrite=True replaces it")
        old, moved = f"{staging}/_old", []
        try:
            for batch in sorted(rows):
                name = f"batch_{batch}"
                replaced = _exists(files, f"{root}/{name}")
                if replaced:
                    files.create_dir(old)
                    files.move(f"{root}/{name}", f"{old}/{name}")
                moved.append((name, replaced))
                files.move(f"{staging}/{name}", f"{root}/{name}")
        except BaseException:
            for name, replaced in reversed(moved):  # as it was
                if _exists(files, f"{root}/{name}"):
                    files.delete_dir(f"{root}/{name}")
                if replaced:
                    files.move(f"{old}/{name}", f"{root}/{name}")
            raise
        self._clear()

    def abort(self, messages: list[PagesWritten | None]) -> None:
        self._clear()

    def _clear(self) -> None:
        # tasks of an aborted job may still be running: they make no parent folder,
        # so under another name the folder gets no more files
        files, root, staging = self._folders()
        if _exists(files, staging):
            gone = f"{root}/_gone-{uuid.uuid4().hex}"
            files.move(staging, gone)
            files.delete_dir(gone)


class PageFiles(DataSource):
    """``df.write.format("page_files").save(root)``; columns batch_id, page, raw_json."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "batch_id int, page int, raw_json string"

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return PageFileWriter(self.options["path"], overwrite)


def write_named_pages(pages: DataFrame, root: str, overwrite: bool = False) -> None:
    """Write pages (batch_id, page, raw_json) as ``root/batch_N/page_P.json``, each
    batch whole or not at all.

    A batch that is there already fails the job, or is replaced with ``overwrite``
    (other batches stay).  A page given twice, or one without number or document,
    fails the job.  No shuffle: a task writes the pages it holds."""
    pages.sparkSession.dataSource.register(PageFiles)
    rows = pages.selectExpr("cast(batch_id AS int) batch_id", "cast(page AS int) page", "raw_json")
    rows.write.format(FORMAT).mode("overwrite" if overwrite else "append").save(root)
