"""Sharding by vector bin packing: bytes, tokens and rows balanced together.

Rows with equal texts form a group, which stays in one shard.  A group's demand
is the vector (bytes, tokens, rows), each as a share of the corpus total; it is
placed where the dot product of its demand with the residual capacity of the
shard is highest (ties: lowest shard), large demands first.  ``WEIGHTS`` says
how much each dimension counts; bytes count most, as the law kept is that the
shards' bytes are near equal.

Scale:

* A group larger than a whole shard's share cannot be balanced; it is cut by
  document id into pieces of at most half a share.
* Large groups (over ``LARGE`` of a shard's share in some dimension; at most
  3 * shards / LARGE of them exist, whatever the corpus size) are placed one
  after the other on the driver.
* All other groups are dealt by hash to cells of about ``CELL_GROUPS`` groups.
  Each cell packs its groups against its own part of the capacity that the
  large groups have left, so cells run in parallel, and each errs by no more
  than its smallest groups.
* Slots are numbered inside (shard, block) and moved up by the sizes of the
  earlier blocks; no task holds a whole shard.

Features of every row are written once as a narrow checkpoint (no text).

Defined cases: a null text has no bytes and counts as equal to the empty text;
null or repeated ids are fine (a repeated row is one more row of its group);
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

SHARDS = 16
#: groups over this part of a shard's share are placed before all others
LARGE = 1 / 256
CELL_GROUPS = 4096
BLOCK_ROWS = 16384

WEIGHTS = np.array([32.0, 1.0, 1.0])

_DIMS = ["bytes", "tokens", "n"]


class Residual:
    """Capacity left by shard and dimension, as shares of the whole."""

    def __init__(self, capacity: np.ndarray) -> None:
        self.left = capacity.copy()

    def place(self, demand: np.ndarray) -> int:
        shard = int(np.argmax(self.left @ (demand * WEIGHTS)))
        self.left[shard] -= demand
        return shard


def pack(demands: np.ndarray, residual: Residual) -> list[int]:
    """Shard of each demand, which are given largest first."""
    return [residual.place(d) for d in demands]


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, size, tokens, text_crc32, group): no text is carried on."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("tokens"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.md5(text.cast("binary")).alias("group"))


def assign(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, size, tokens, text_crc32, shard, slot."""
    spark = docs.sparkSession
    ensure_checkpoint_dir(spark)
    rows = features(docs, id_col, text_col).checkpoint()
    total = rows.agg(F.sum("size"), F.sum("tokens"), F.count("*")).first()
    if not total[2]:
        return (rows.withColumn("shard", F.lit(0)).withColumn("slot", F.lit(0).cast("long")).drop("group"))
    total = np.maximum(np.array([total[0], total[1] or 0, total[2]], dtype=float), 1.0)

    # pieces of groups that exceed a whole share: at most 3 * shards groups
    share = total / shards
    sums = [F.sum("size").alias("bytes"), F.sum("tokens").alias("tokens"), F.count("*").alias("n")]
    over = F.greatest(*[F.col(c) / F.lit(float(s)) for c, s in zip(_DIMS, share)])
    groups = rows.groupBy("group").agg(*sums).withColumn("over", over)
    huge = groups.filter(F.col("over") > 1).select("group", F.ceil(F.col("over") * 2).cast("int").alias("pieces"))
    rows = (rows.join(F.broadcast(huge), "group", "left")
            .withColumn("piece", F.when(F.col("pieces").isNull(), F.lit(0))
                        .otherwise(F.pmod(F.xxhash64("doc_id"), F.col("pieces"))).cast("int")).drop("pieces"))
    groups = rows.groupBy("group", "piece").agg(*sums).withColumn("over", over).checkpoint()

    # large groups, one after the other
    residual = Residual(np.full((shards, 3), 1.0 / shards))
    large = (groups.filter(F.col("over") > LARGE)
             .orderBy(F.desc("over"), "group", "piece").select("group", "piece", *_DIMS).collect())
    placed = [(r["group"], r["piece"], residual.place(np.array([r[c] for c in _DIMS]) / total)) for r in large]
    placed = spark.createDataFrame(placed, "group string, piece int, shard int")

    # the rest, cell by cell, into what is left
    left = np.maximum(residual.left, 0)
    weight = left / np.maximum(left.sum(axis=0), 1e-300)
    n_groups = groups.count()
    cells = max(1, -(-n_groups // CELL_GROUPS))

    def pack_cell(pdf: pd.DataFrame) -> pd.DataFrame:
        demand = pdf[_DIMS].to_numpy(float) / total
        order = np.lexsort((pdf["piece"], pdf["group"], -demand.max(axis=1)))
        out = np.empty(len(pdf), np.int32)
        out[order] = pack(demand[order], Residual(weight * demand.sum(axis=0)))
        return pd.DataFrame({"group": pdf["group"], "piece": pdf["piece"], "shard": out})

    small = (groups.filter(F.col("over") <= LARGE)
             .withColumn("cell", F.pmod(F.xxhash64("group", "piece"), F.lit(cells)))
             .groupBy("cell").applyInPandas(pack_cell, placed.schema))
    sharded = rows.join(placed.unionByName(small), ["group", "piece"]).drop("group", "piece")
    return number_slots(sharded, int(total[2]))


def number_slots(sharded: DataFrame, n_rows: int) -> DataFrame:
    """Adds ``slot``: 0, 1, 2, ... inside each shard, without a gap."""
    blocks = max(1, -(-n_rows // BLOCK_ROWS))
    rows = sharded.withColumn("block", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(blocks)))
    per_block = rows.groupBy("shard", "block").agg(F.count("*").alias("in_block"))
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    base = per_block.select("shard", "block", F.coalesce(F.sum("in_block").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("shard", "block").orderBy("doc_id", "text_crc32")
    return (rows.withColumn("slot", F.row_number().over(inside) - 1)
            .join(base, ["shard", "block"])
            .withColumn("slot", (F.col("slot") + F.col("base")).cast("long"))
            .drop("block", "base"))
