"""Corpus preparation: five stages over the ``documents`` table.

Each stage is ``(spark, docs, sf_dir) -> DataFrame``; its result is written as
Parquet and read again as the next stage's documents.  All stages but the last
return the columns of documents.

Defined cases: see the operators; every stage accepts nulls in any column,
empty and very long texts, repeated rows, empty tables and further columns,
which it passes on.  ``n_chars``, where present, follows the text.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.llm import decontaminate, neardup, outliers, packing, pii
from stratum.llm.queries import PSEUDONYM_KEY, TOKENIZERS, WORD_BPE
from stratum.session import ensure_checkpoint_dir


def _counted(docs: DataFrame) -> DataFrame:
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the robust estimate reject go."""
    return outliers.keep(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays (five words, 0.8)."""
    return neardup.deduplicated(docs, shingle=5)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out of the texts."""
    return _counted(decontaminate.remove(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")))


def pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal values are replaced by values of the same format."""
    return _counted(pii.pseudonymised(docs, PSEUDONYM_KEY))


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a training sequence, with its token ids."""
    return packing.packed(docs, f"{TOKENIZERS}/{WORD_BPE}").withColumn("ids_crc32", F.crc32("ids"))


STAGES = [("quality_rules", quality_rules), ("near_dedup", near_dedup), ("decontamination", decontamination),
          ("pseudonyms", pseudonyms), ("packed_sequences", packed_sequences)]

#: robust estimates, sketches and tokens have no SQL form; the tests compare
#: every stage with a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over the whole ``documents`` table.

    The tables between the stages go to a fresh folder under
    ``spark.checkpoint.dir``.
    """
    folder = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for n, (name, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{n}-{name}")
        docs = spark.read.parquet(f"{folder}/{n}-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
