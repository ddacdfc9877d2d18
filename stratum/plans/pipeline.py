"""The stored pipeline: page files -> raw table -> staging -> silver -> gold.

Layout under a warehouse root (any Hadoop-compatible path):

  raw/api_data                 parquet, partitioned by batch_id, append-only
  raw/api_data_files           the ledger of the page files loaded
  curated/<table>_merge        staging of the last loaded batch (overwrite)
  curated/records_merge        the unpacked records of the last loaded batch
  curated/rejected_pages       pages left out in lenient mode, with the reason
  curated/<table>              silver table in versions (see ``sources.bucket_store``):
                               an upsert rewrites the buckets its batch touches
  datamart/<table>             gold tables (overwrite = full refresh)
  datamart/_partials           partial sums of the marts per silver bucket (see ``stored_marts``)

Spark cannot overwrite a parquet table that the same job reads, so the upsert
result goes into new files and a version names the files that make it up.  What
a failed or half-committed run leaves behind is never read.

With a catalog ``database`` the silver tables are bucketed catalog tables instead
(``SilverStore``): every upsert writes a complete new version there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S
from ..functions.json_pages import rejected_pages, unpack_pages
from ..operators.quality import assert_key, declared_tests
from ..operators.upsert import overwrite_table, upsert
from ..session import ensure_checkpoint_dir
from ..sources import bronze as B
from ..sources.bucket_store import BucketStore
from ..sources.catalog import export_folder, materialize
from ..sources.file_ledger import load_new_files
from ..sources.publish import publish_set
from .gold import build_gold
from .silver import from_records
from .stored_marts import StoredMarts

VERSION = "_version"


def _p(root: str, *parts: str) -> str:
    return "/".join([root.rstrip("/"), *parts])


def silver_tables() -> dict[str, tuple[list[str], list[str]]]:
    """Silver table -> (columns incl. loaded_at, key)."""
    out = {"anime": (S.ENTITY_COLUMNS + ["loaded_at"], S.ENTITY_KEY)}
    for kind, prefix in S.LINK_KINDS:
        out[f"links_anime_{kind}"] = (S.link_table_columns(prefix) + ["loaded_at"], S.link_key(prefix))
    return out


def _no_path(e: Exception) -> bool:
    return "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e)


def _versioned_schema(name: str) -> T.StructType:
    return T.StructType(S.silver_schema(name).fields + [T.StructField(VERSION, T.IntegerType())])


def _read_versioned(spark: SparkSession, path: str, name: str) -> DataFrame | None:
    """All versions of a silver table, or None when nothing was written yet."""
    try:
        return spark.read.schema(_versioned_schema(name)).parquet(path)
    except Exception as e:
        if _no_path(e):
            return None
        raise


class SilverStore:
    """Silver tables as complete versions, for sessions with a catalog.

    Parquet folders ``root/curated/<table>`` partitioned by ``_version``; with
    ``buckets`` and a ``database`` name the same folders are catalog tables
    bucketed -- and sorted -- by the table key: the current version is then read
    already hash-partitioned by key, so the upsert's anti join shuffles only the
    batch.  Every upsert writes the whole table, and one writer at a time is assumed.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int | None = None,
                 database: str | None = None):
        if buckets and not database:
            raise ValueError("a bucketed silver store needs a catalog database name")
        self.spark, self.root, self.buckets, self.database = spark, root, buckets, database

    def path(self, name: str) -> str:
        return _p(self.root, "curated", name)

    def table(self, name: str) -> str:
        return f"`{self.database}`.`{name}`"

    def _ensure_table(self, name: str) -> None:
        """Register the bucketed table over its folder; an existing table must
        have the same location and buckets.  Versions written elsewhere are
        picked up each time."""
        if self.spark.catalog.tableExists(f"{self.database}.{name}"):
            found = {r.col_name: r.data_type for r in self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.table(name)}").collect()}
            location = found.get("Location", "").replace("file:", "").rstrip("/")
            here = self.path(name).replace("file:", "").rstrip("/")
            if location.lstrip("/") != here.lstrip("/") or int(found.get("Num Buckets", 0)) != self.buckets:
                raise ValueError(f"{self.database}.{name} exists at {found.get('Location')} with "
                                 f"{found.get('Num Buckets')} buckets; wanted {self.path(name)} with {self.buckets}")
        else:
            key = silver_tables()[name][1]
            cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in _versioned_schema(name).fields)
            keys = ", ".join(f"`{k}`" for k in key)
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{self.database}`")
            self.spark.sql(
                f"CREATE TABLE {self.table(name)} ({cols}) USING parquet PARTITIONED BY (`{VERSION}`) "
                f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {self.buckets} BUCKETS "
                f"LOCATION '{self.path(name)}'")
        try:
            self.spark.sql(f"ALTER TABLE {self.table(name)} RECOVER PARTITIONS")
        except Exception as e:  # a new table: its folder does not exist yet
            if not _no_path(e):
                raise

    def _all_versions(self, name: str) -> DataFrame | None:
        if self.buckets:
            self._ensure_table(name)
            return self.spark.table(self.table(name))
        return _read_versioned(self.spark, self.path(name), name)

    def _published(self, name: str) -> str:
        return _p(self.root, "curated", "_published", name)

    def current_version(self, name: str) -> int | None:
        """Highest published version (None if there is none); reads only the
        list of versions, never a table."""
        try:
            row = self.spark.read.schema("version int, n_rows long").parquet(self._published(name)).agg(F.max("version")).first()
        except Exception as e:
            if _no_path(e):
                return None
            raise
        return row[0]

    def read(self, name: str, version: int | None = None) -> DataFrame:
        """A version (default: the current one); empty before the first load."""
        v = self.current_version(name) if version is None else version
        if v is None:
            return self.spark.createDataFrame([], S.silver_schema(name))
        # Equality on the partition column: only that version's folder is read.
        return self._all_versions(name).where(F.col(VERSION) == v).drop(VERSION)

    def free_version(self, name: str) -> int:
        """The next number whose folder does not exist yet."""
        v = (self.current_version(name) or 0) + 1
        while True:
            try:
                self.spark.read.schema(S.silver_schema(name)).parquet(f"{self.path(name)}/{VERSION}={v}")
            except Exception as e:
                if _no_path(e):
                    return v
                raise
            v += 1

    def write_version(self, name: str, df: DataFrame) -> int:
        """Write ``df`` as a new version and publish it; returns its rows."""
        version = self.free_version(name)
        cols = silver_tables()[name][0]
        obs = Observation()
        out = (df.select(*cols).withColumn(VERSION, F.lit(version).cast("int"))
               .observe(obs, F.count(F.lit(1)).alias("n")))
        if self.buckets:
            self._ensure_table(name)
            out.write.mode("append").insertInto(self.table(name))
        else:
            out.write.mode("append").partitionBy(VERSION).parquet(self.path(name))
        written, readable = int(obs.get["n"]), self.read(name, version).count()
        if written != readable:
            raise RuntimeError(f"{name} version {version}: {written} rows written, {readable} readable; not published")
        (self.spark.createDataFrame([(version, written)], "version int, n_rows long").coalesce(1)
         .write.mode("append").parquet(self._published(name)))
        return written


    def rows(self, name: str) -> int:
        return self.read(name).count()

    def committed(self, name: str, writer: str, epoch: int) -> None:
        return None  # no ledger here: a replay is merged again, with the same result

    def upsert(self, name: str, source: DataFrame, key: list[str], prepare=None,
               writer: str | None = None, epoch: int | None = None) -> int:
        if self.current_version(name) is None:
            return self.write_version(name, source)
        current = self.read(name)
        accepted = prepare(source, current) if prepare else source
        return self.write_version(name, upsert(current, accepted.select(*current.columns), key))


def open_store(spark: SparkSession, root: str, buckets: int | None = None,
               database: str | None = None) -> BucketStore | SilverStore:
    """The silver tables of a warehouse: copy-on-write buckets, or bucketed catalog
    tables if a ``database`` is named.  All tables are bucketed by the title, so a
    title's rows are in the same bucket of each."""
    if database:
        return SilverStore(spark, root, buckets, database)
    tables = {n: (S.silver_schema(n), "anime_id") for n in silver_tables()}
    return BucketStore(spark, _p(root, "curated"), tables, buckets)


def read_silver(spark: SparkSession, root: str, name: str, buckets: int | None = None,
                database: str | None = None) -> DataFrame:
    """Current version of a silver table (an empty frame before the first load)."""
    return open_store(spark, root, buckets, database).read(name)


def load_missing_batches(spark: SparkSession, page_root: str, root: str, layout: str = "fetched") -> int:
    """Append every page file not yet in the raw table; rows appended.

    The ledger of loaded files (``sources.file_ledger``) finds the batch folders that
    are new or have changed; only those are listed and only new files read.  A batch
    that was loaded half-way is finished.
    """
    return load_new_files(spark, page_root, _p(root, "raw", "api_data"), layout)


def _not_older(staged: DataFrame, current: DataFrame, titles: DataFrame, key: list[str]) -> DataFrame:
    """The staged rows (with ``batch_id``) that may be upserted: a batch must not
    overwrite what a later batch has written.  Rows of titles last seen in a later
    batch are only inserted where their key is new."""
    last = titles.select("anime_id", F.col("batch_id").alias("_last")).where("_last IS NOT NULL")
    older = (staged.select(*key, "batch_id").join(last, "anime_id").where("batch_id < _last").select(*key))
    known = older.join(current.select(*key), key, "left_semi")
    return staged.join(known, key, "left_anti")


def load_curated(spark: SparkSession, root: str, batch_id: int | None = None,
                 strict: bool = True, buckets: int | None = None,
                 database: str | None = None, pages: DataFrame | None = None,
                 writer: str | None = None, epoch: int | None = None) -> dict[str, int]:
    """Latest (or given) batch -> staging overwrite -> checks -> upsert into a
    new silver version.  Returns rows per silver table after the upsert.

    The pages (``pages``: raw rows, of any number of batches, instead of reading
    one batch from the raw table) are unpacked once into ``curated/records_merge``
    and the seven tables derived from there: one upsert each, the last copy of a
    key by (batch, raw id, position).  A bad page fails the run; with
    ``strict=False`` it is left out, listed in ``curated/rejected_pages`` and
    counted under "rejected_pages".

    ``writer`` and ``epoch`` name a streaming writer's micro-batch: tables that
    hold it already are left alone, and if all do, nothing is written at all.
    """
    ensure_checkpoint_dir(spark)
    store = open_store(spark, root, buckets, database)
    names = silver_tables()
    done = {n: store.committed(n, writer, epoch) if writer is not None else None for n in names}
    if all(v is not None for v in done.values()):
        return {n: store.rows(n) for n in names}
    raw = pages
    if raw is None:
        raw = B.scan_batch(B.read_bronze(spark, _p(root, "raw", "api_data")), batch_id)
    counts: dict[str, int] = {}
    if not strict:
        bad = rejected_pages(raw).withColumn("rejected_at", F.current_timestamp())
        obs = Observation()
        (bad.observe(obs, F.count(F.lit(1)).alias("n")).write.mode("append")
         .parquet(_p(root, "curated", "rejected_pages")))
        counts["rejected_pages"] = int(obs.get["n"])
    records_path = _p(root, "curated", "records_merge")
    unpack_pages(raw, strict).write.mode("overwrite").parquet(records_path)
    staging = from_records(spark.read.parquet(records_path), with_batch=True)
    # as they were before this batch: the entity is upserted first
    if done["anime"]:
        titles = store.read("anime", done["anime"])
    elif done["anime"] == 0:
        titles = spark.createDataFrame([], S.silver_schema("anime"))
    else:
        titles = store.read("anime")
    for name, (cols, key) in names.items():
        if done[name] is not None:
            counts[name] = store.rows(name)
            continue
        stage_path = _p(root, "curated", f"{name}_merge")
        staged_columns = list(dict.fromkeys([*cols, "batch_id"]))
        overwrite_table(staging[name], staged_columns, stage_path, name=f"curated.{name}_merge")
        schema = T.StructType([*S.silver_schema(name).fields,
                               *([] if "batch_id" in cols else [T.StructField("batch_id", T.IntegerType())])])
        staged = spark.read.schema(schema).parquet(stage_path)
        not_null = ["raw_id"] if name == "anime" else []
        assert_key(staged, key, not_null, name=f"curated.{name}_merge")
        counts[name] = store.upsert(name, staged, key, lambda new, old, k=key: _not_older(new, old, titles, k), writer, epoch)
    return counts


def vacuum(spark: SparkSession, root: str, keep: int = 2, grace_hours: float = 24.0) -> dict[str, int]:
    """Drop old versions of the silver tables; folders removed by table."""
    store = open_store(spark, root)
    return {n: store.vacuum(n, keep, grace_hours) for n in silver_tables()}


def build_datamart(spark: SparkSession, root: str, strict: bool = True, buckets: int | None = None,
                   database: str | None = None) -> list[str]:
    """Full refresh of the gold tables from the current silver version."""
    store = open_store(spark, root, buckets, database)
    silver = {n: store.read(n) for n in silver_tables()}
    gold = build_gold(silver, strict=strict, sort_links=True)
    for name in gold:
        materialize(gold[name], name, path=_p(root, "datamart", name))
    return list(gold)


def refresh_marts(spark: SparkSession, root: str) -> StoredMarts:
    """The stored marts of the warehouse (``datamart/_partials``), brought up to its silver
    tables: only buckets that have changed are read.  Needs the bucketed folders, not a
    catalog ``database``."""
    marts = StoredMarts(open_store(spark, root), _p(root, "datamart", "_partials"))
    marts.refresh()
    return marts


def read_datamart(spark: SparkSession, root: str, names: list[str] | None = None) -> dict[str, DataFrame]:
    from ..sources.catalog import load_tables

    names = names or [n for n in GOLD_TABLES]
    return load_tables(spark, names, root=_p(root, "datamart"))


GOLD_TABLES = (["f_anime"] + [f"links_{k}" for k, _ in S.LINK_KINDS]
               + [f"d_{k}" for k, _ in S.LINK_KINDS] + [d for d, _ in S.SURROGATE_DIMS])


def export_datamart(spark: SparkSession, root: str, destination: str) -> list[str]:
    return export_folder(spark, GOLD_TABLES, _p(root, "datamart"), destination)


def publish_datamart(spark: SparkSession, root: str, destination: str) -> int:
    """All gold tables as one published set (``sources.publish``): readers of
    ``read_set`` never meet half an export.  Returns the set's number."""
    return publish_set(read_datamart(spark, root), destination)


def test_silver(spark: SparkSession, root: str, buckets: int | None = None,
                database: str | None = None) -> DataFrame:
    """The declared silver tests (unique / not_null) as a failures report."""
    store = open_store(spark, root, buckets, database)
    silver = {n: store.read(n) for n in silver_tables()}
    return declared_tests(silver, S.SOURCE_TESTS)


def run(spark: SparkSession, page_root: str, root: str, buckets: int | None = None,
        database: str | None = None, strict: bool = True, layout: str = "fetched") -> dict:
    """The monthly run: load new batches, curate the latest, test silver,
    rebuild gold.  ``buckets`` is the number of buckets of a new warehouse's silver
    tables, ``database`` keeps them as catalog tables,
    ``strict=False`` lists bad pages instead of failing."""
    appended = load_missing_batches(spark, page_root, root, layout)
    counts = load_curated(spark, root, strict=strict, buckets=buckets, database=database)
    failures = {(r.table_name, r.column_name, r.test): r.failures
                for r in test_silver(spark, root, buckets, database).where("failures > 0").collect()}
    tables = build_datamart(spark, root, buckets=buckets, database=database)
    return {"appended": appended, "silver_rows": counts, "test_failures": failures,
            "gold_tables": tables}
