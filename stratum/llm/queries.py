"""The registered queries of this package (``(spark, sf_dir) -> DataFrame``)."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (decontaminate, mixing, nbsvm, neardup, outliers, packing, periods, pii, repeats, sharding, suffix_tree,
               unigram, whitening)
from .oracle_sql import ORACLES  # noqa: F401

#: folder of the public tokenizer files; only the driver reads it
TOKENIZERS = os.environ.get("TOKENIZERS_DIR", "/opt/tokenizers")
WORD_BPE, UNIGRAM = "word_bpe_49k.json", "piece_bpe_32k.model"

PSEUDONYM_KEY = os.environ.get("PSEUDONYM_KEY", "test tables only")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _table(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_near_duplicates(spark, sf_dir):
    """The contract's shingles are two words; the library's default is five."""
    return neardup.near_duplicates(_table(spark, sf_dir), shingle=2)


@query
def op2_packing(spark, sf_dir):
    p = packing.packed(_table(spark, sf_dir), f"{TOKENIZERS}/{WORD_BPE}")
    return p.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                    "sequence_id", "offset", "source")


@query
def op3_token_counts(spark, sf_dir):
    return unigram.count_tokens(_table(spark, sf_dir), unigram.read_vocabulary(f"{TOKENIZERS}/{UNIGRAM}"))


@query
def op4_substring_dedup(spark, sf_dir):
    r = repeats.remove_repeats(_table(spark, sf_dir))
    return r.select("doc_id", "n_words", "n_removed", "kept_sha256")


@query
def op5_sharding(spark, sf_dir):
    """Law ``bytes``: the sizes of the 16 shards are near equal."""
    s = sharding.assign(_table(spark, sf_dir))
    return s.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                    F.lit(None).cast("int").alias("grown_shard"), "tokens")


@query
def op6_quality_rules(spark, sf_dir):
    return outliers.quality(_table(spark, sf_dir))


@query
def op7_pseudonyms(spark, sf_dir):
    """The key is a secret of the deployment; this one is for the test tables."""
    docs = _table(spark, sf_dir).select("doc_id", "text", F.size(pii.values(F.col("text"))).cast("long").alias("n_values"))
    return pii.pseudonymised(docs, PSEUDONYM_KEY)


@query
def op8_suffix_tree_scores(spark, sf_dir):
    return suffix_tree.scores(_table(spark, sf_dir))


@query
def op9_decontamination(spark, sf_dir):
    c = decontaminate.contamination(_table(spark, sf_dir), _table(spark, sf_dir, "benchmark"))
    return c.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                    F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated")


@query
def op10_quality_classifier(spark, sf_dir):
    return nbsvm.quality_scores(_table(spark, sf_dir), _table(spark, sf_dir, "labels"))


@query
def op11_embedding_whitening(spark, sf_dir):
    w = whitening.whiten(_table(spark, sf_dir, "embeddings"))
    w = w.select("vec_id", "n", "deviation", "explained", "identity_error", F.posexplode("whitened").alias("place", "whitened"))
    return w.select("vec_id", (F.col("place") + 1).alias("component"), "n", "deviation", "whitened",
                    F.get("explained", F.col("place")).alias("explained"), "identity_error")


@query
def op12_source_mixing(spark, sf_dir):
    """Weights 3, 1, 2 in turn, one and a half times the corpus, two epochs at most."""
    m = mixing.repetitions(_table(spark, sf_dir))
    return m.select("doc_id", "size", "source_size", "target", "taken", "source")


def _echoed(docs: DataFrame) -> DataFrame:
    """The contract's planted periods: in every tenth document (by hash of its id)
    all words from a place on repeat the p words found there."""
    docs = docs.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string").cast("binary")).alias("h"))
    w = F.when(F.expr("h % 10 = 0"), F.regexp_extract_all("text", F.lit(periods.WORD), F.lit(0)))
    docs = docs.select("doc_id", "text", w.alias("w"), F.expr("h div 10").alias("g"))
    docs = docs.withColumn("n", F.coalesce(F.size("w"), F.lit(0)))
    docs = docs.withColumn("a", F.expr("if(n > 0, cast(g % n AS int), 0)"))
    docs = docs.withColumn("p", F.expr("if(n > 0, 1 + cast(floor((n - a) / (3 + g % 8)) AS int), 1)"))
    text = F.expr("concat_ws(' ', slice(w, 1, a), transform(sequence(0, n - a - 1), i -> w[a + i % p]))")
    return docs.select("doc_id", F.when(F.col("n") > 0, text).otherwise(F.col("text")).alias("text"))


@query
def op13_periodic_runs(spark, sf_dir):
    r = periods.periodic_runs(_echoed(_table(spark, sf_dir)))
    line = lambda x: F.concat_ws(",", x.start, x.length, x.period)
    lines = F.array_join(F.transform("runs", lambda x: F.concat(line(x), F.lit("\n"))), "")
    best = F.col("strongest")
    return r.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.start.alias("start"),
                    best.length.alias("length"), best.period.alias("period"),
                    F.expr("(1000 * strongest.length) div strongest.period").alias("exponent_milli"),
                    F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
