"""Page files: scan, write, paginate, take-while, probe.

A batch is a folder ``batch_<N>`` of files ``page_<P>.json``, each holding one
page document.  The scan reads whole files (one row per file) and takes the
batch and page numbers from the file path.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.misc import last_element, number_in_name
from ..functions.json_pages import compact_document, with_records
from ..operators.sequence import dense_index


#: globs of batch folder and page file: as fetched, and as ``write_page_files`` writes
LAYOUTS = {"fetched": ("batch_*", "page_*.json"), "written": ("batch_id=*", "page=*/part-*")}


def _missing(e: Exception) -> bool:
    return "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e)


def scan_page_files(spark: SparkSession, root: str, batch_glob: str | None = None,
                    layout: str = "fetched") -> DataFrame:
    """``root/batch_N/page_P.json`` -> batch_id, page, raw_json (one row per file).

    The whole document is kept, re-serialised without layout whitespace
    (``compact_document``).  ``layout`` names the folder layout (``LAYOUTS``);
    ``batch_glob`` restricts the batch folders.
    """
    batches, pages = LAYOUTS[layout]
    # ``wholetext`` must be the keyword: ``text()`` sets its own default.
    try:
        files = (spark.read.text(f"{root.rstrip('/')}/{batch_glob or batches}/{pages}", wholetext=True)
                 .select(F.col("value").alias("doc"), F.col("_metadata.file_path").alias("path")))
    except Exception as e:  # no batch folder / no page file yet: nothing to load
        if not _missing(e):
            raise
        return spark.createDataFrame([], "batch_id int, page int, raw_json string")
    return files.select(
        number_in_name("path", "batch").alias("batch_id"),
        number_in_name("path", "page").alias("page"),
        compact_document("doc").alias("raw_json"))


def list_page_files(spark: SparkSession, root: str, batch_glob: str | None = None,
                    layout: str = "fetched") -> DataFrame:
    """batch_id, page, folder, path of every page file, from the file listing
    only (the ``binaryFile`` source does not read a file's content unless the
    ``content`` column is selected)."""
    batches, pages = LAYOUTS[layout]
    try:
        files = (spark.read.format("binaryFile")
                 .load(f"{root.rstrip('/')}/{batch_glob or batches}/{pages}").select("path"))
    except Exception as e:
        if not _missing(e):
            raise
        return spark.createDataFrame([], "batch_id int, page int, folder string, path string")
    folder = r"([^/]+)/[^/]+$" if layout == "fetched" else r"([^/]+)/[^/]+/[^/]+$"
    return files.select(number_in_name("path", "batch").alias("batch_id"),
                        number_in_name("path", "page").alias("page"),
                        F.regexp_extract("path", folder, 1).alias("folder"), "path")


def list_batches(spark: SparkSession, root: str, layout: str = "fetched") -> DataFrame:
    """Distinct batch ids of the batch folders under ``root`` that hold pages."""
    return list_page_files(spark, root, layout=layout).select("batch_id").distinct()


def write_page_files(pages: DataFrame, root: str) -> None:
    """Write pages (batch_id, page, raw_json): one folder per batch and page,
    ``root/batch_id=N/page=P/part-*.txt`` holding that page's document.

    Spark names the files itself, so the page number lives in the folder; the
    scans, loads and streams read them back with ``layout="written"``.
    """
    (pages.select("batch_id", "page", "raw_json")
     .repartition("batch_id", "page")
     .write.mode("append").partitionBy("batch_id", "page").text(root))


def paginate(df: DataFrame, order: list[str | Column], page_size: int = S.PAGE_SIZE,
             rn: str = "rn", key: list[str] | None = None, columns: tuple[str, ...] = ()) -> DataFrame:
    """Number rows 1..n in ``order`` and cut them into pages of ``page_size``:
    adds ``rn``, ``page`` (1-based) and ``rec_pos`` (0-based in the page).

    With a ``key`` only the key and the order columns are sorted (``dense_index``)."""
    numbered = dense_index(df, order, rn, key=key, columns=columns)
    return (numbered
            .withColumn("page", ((F.col(rn) - 1) / page_size).cast("int") + 1)
            .withColumn("rec_pos", ((F.col(rn) - 1) % page_size).cast("int")))


def _probed(pages: DataFrame) -> DataFrame:
    """``pages`` with n_records, last_title and last_members; one parse a page."""
    last = last_element(F.col("__data"))
    return with_records(pages, "__data").select(
        *pages.columns, F.coalesce(F.size("__data"), F.lit(0)).alias("n_records"),
        last.getField("title").alias("last_title"), last.getField("members").alias("last_members"))


def page_last_members(pages: DataFrame) -> DataFrame:
    """[batch_id,] page, n_records, last_title, last_members of page documents."""
    keys = [c for c in ("batch_id",) if c in pages.columns]
    return _probed(pages.select(*keys, "page", "raw_json")).drop("raw_json")


#: pages of each batch probed first by ``take_while_pages``
FIRST_PAGES = 64


def stop_pages(pages: DataFrame, min_members: int = S.MIN_MEMBERS, first_pages: int = FIRST_PAGES) -> dict:
    """{batch (None without ``batch_id``): its first page that fails}, of the batches that have one.

    A progressive scan: pages 1 to ``first_pages``, then twice as far, and so on,
    each time of the batches that have not stopped yet.  Pages past twice the stop
    (and past ``first_pages``) are never parsed.  The driver keeps two numbers a
    batch."""
    keys = [c for c in ("batch_id",) if c in pages.columns]
    of = lambda r: r[0] if keys else None
    left = {of(r): r["top"] for r in pages.groupBy(*keys).agg(F.max("page").alias("top")).collect() if r["top"] is not None}
    fails = (F.col("n_records") == 0) | (F.coalesce("last_members", F.lit(0)) < min_members)
    stops, lo, hi = {}, None, first_pages
    while left:
        part = pages.where((F.col("page") <= hi) if lo is None else (F.col("page") > lo) & (F.col("page") <= hi))
        if keys:
            known = F.col("batch_id").isin([b for b in left if b is not None])
            part = part.where(known | F.col("batch_id").isNull() if None in left else known)
        # not a filter on ``fails``: it would be pushed down beside the page range
        bad = _probed(part.select(*keys, "page", "raw_json")).groupBy(*keys).agg(F.min(F.when(fails, F.col("page"))).alias("stop"))
        stops |= {of(r): r["stop"] for r in bad.collect() if r["stop"] is not None}
        left = {b: top for b, top in left.items() if b not in stops and top > hi}
        lo, hi = hi, 2 * hi
    return stops


def take_while_pages(pages: DataFrame, min_members: int = S.MIN_MEMBERS, first_pages: int = FIRST_PAGES) -> DataFrame:
    """Pages kept by the fetch loop: in page order, while the page's last
    record has ``members >= min_members``.  An empty page, or one whose last
    record fails, stops the run and is itself not kept.  Per batch when the
    frame has ``batch_id``.

    The stops are found by ``stop_pages`` (jobs run here), then one filter keeps the
    pages before them.  Output: the page rows with ``n_records`` and
    ``last_members``.
    """
    stops = stop_pages(pages, min_members, first_pages)
    if "batch_id" not in pages.columns:
        kept = pages.where(F.col("page") < stops[None]) if stops else pages
    elif stops:  # one row per batch: a proven bound for the broadcast
        table = pages.sparkSession.createDataFrame(list(stops.items()), "__batch int, __stop int")
        kept = (pages.join(F.broadcast(table), F.col("batch_id").eqNullSafe(F.col("__batch")), "left")
                .where(F.col("__stop").isNull() | (F.col("page") < F.col("__stop"))).select(*pages.columns))
    else:
        kept = pages
    return _probed(kept).drop("last_title")
