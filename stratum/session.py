"""Session construction and the two session-level settings the library relies on.

Everything else in the package takes a ``SparkSession`` (or DataFrames) as an
argument; nothing here is global state beyond what Spark itself keeps.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that matter for the plans this package builds.  AQE is what turns a
# statically planned sort-merge join against a freshly aggregated dimension into
# a broadcast join once the real (post-shuffle) size is known, splits skewed
# join partitions and coalesces small shuffle partitions.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # checkpoint files go when nothing refers to them any more
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "stratum", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the package defaults.

    ``shuffle_partitions`` should be sized to the data: at cluster scale roughly
    input bytes / 128 MiB; AQE coalesces downwards when that is too many.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder of this session.

    The cluster names a shared folder in ``spark.checkpoint.dir``; we use it as
    is.  Only a local-mode session without one (tests, laptop runs) gets a fresh
    scratch folder; on a cluster a missing setting is an error, because a
    machine-local folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if configured.startswith("file:") and not sc.master.startswith("local"):
            # a file: folder is fine only where every machine mounts it
            sc._jvm.org.slf4j.LoggerFactory.getLogger("stratum").warn(
                "spark.checkpoint.dir is a file: path; it must be a folder shared by all executors")
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder (HDFS/S3/ABFS) "
            "so checkpointed data survives executor loss")
    folder = tempfile.mkdtemp(prefix="stratum-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet under the checkpoint folder and read back.

    Cuts the lineage and survives lost executors as ``checkpoint()`` does, but the
    columns are compressed and a reader takes only those it names: a checkpoint
    is read as whole serialised rows, by each reader anew.
    """
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
