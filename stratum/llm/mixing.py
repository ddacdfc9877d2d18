"""Mixing sources to target weights by capped water-filling.

All sources share ``share`` times the words of the corpus by weight.  A source
whose part would exceed ``epochs`` repetitions of its own words is clamped there,
and what it leaves is divided among the others by weight, until none is above:
the level ``L`` with ``sum(min(epochs * size, L * weight)) = share * total``.
Levels are exact fractions, so the same sources are clamped on every run.

A source's target (rounded to whole words) is taken as repetitions: every
document ``target div size`` times, and a fraction once more.  That fraction is
the start of a seeded order of the source's documents, up to the word: the last
document of it contributes its first words only, so a source's words meet its
target exactly.  The place where the order is cut is found by the sums of the
leading 12 bits of the documents' hashes, then of the next 12 bits in the one
bucket that holds the cut, then among the few documents of that sub-bucket.  No
source is sorted or collected, and a document's part depends on its own row and
its source's row of cuts alone, so a source with a third of the corpus is spread
over all tasks.

Sources are counted, never collected: their order, weights and levels are tables.

Defined cases: a null source is a source of its own, after all others; a null
text has size 0 and nothing is taken from it; a source without words has target 0;
the order goes by the hash of id and text, then id and size, so null or repeated
ids are fine; equal rows are interchangeable, and where the cut falls among them they share
it one after the other.  An empty table gives an empty result.  Other columns
are ignored by ``repetitions`` and kept by ``mixed``.
"""

from __future__ import annotations

from decimal import Decimal
from fractions import Fraction
from math import lcm

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.sequence import dense_index
from .store import stored

SHARE, EPOCHS = Fraction(3, 2), Fraction(2)
WEIGHTS = (3, 1, 2)
SEED = 20

WORD = r"[^\x20\x09-\x0D]+"
_BITS = 12

_CUT = ["target", "whole", "bucket", "sub", "cut_key", "cut_id", "cut_size", "rest", "copies", "source_size"]


def _integer(x: int) -> Column:
    return F.lit(Decimal(x)).cast("decimal(38,0)")


def _features(id_col: Column, text: Column, seed: int) -> dict[str, Column]:
    key = F.xxhash64(id_col, text, F.lit(seed))
    return {"_size": F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long"),
            "_key": key,
            "_bucket": F.shiftrightunsigned(key, 64 - _BITS).cast("int"),
            "_sub": F.shiftrightunsigned(key, 64 - 2 * _BITS).bitwiseAND(F.lit((1 << _BITS) - 1)).cast("int")}


def rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
         seed: int = SEED) -> DataFrame:
    """(_id, _source, _size, _key, _bucket, _sub) of every document, written once."""
    cols = _features(F.col(id_col), F.col(text_col), seed)
    return stored(docs.select(F.col(id_col).alias("_id"), F.col(source_col).alias("_source"),
                              *[c.alias(n) for n, c in cols.items()]), "mixing-rows")


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, share: Fraction = SHARE,
            epochs: Fraction = EPOCHS) -> DataFrame:
    """Adds ``target`` (double) and ``words`` (the target in whole words) to the
    sources (_source, source_size).

    ``weights`` go round the sources in code-point order, a null source last.
    """
    share, epochs = Fraction(share), Fraction(epochs)
    fractions = [Fraction(w) for w in weights]
    if share < 0 or epochs < 0 or not fractions or min(fractions) < 0:
        raise ValueError("share, epochs and weights must not be negative, and a weight is needed")
    unit = lcm(*[w.denominator for w in fractions])
    cycle = F.array(*[F.lit(int(w * unit)) for w in fractions])
    ordered = dense_index(sizes, [F.col("_source").isNull(), F.col("_source")], "_place", start=0)
    sources = stored(ordered.withColumn(
        "_weight", F.element_at(cycle, (F.col("_place") % len(fractions) + 1).cast("int"))), "mixing-sources")
    total, weight = sources.agg(F.sum("source_size"), F.sum("_weight")).first()
    budget, left, clamped = share * int(total or 0), int(weight or 0), 0
    level, is_full = Fraction(0), F.lit(False)  # without any weight nothing is taken
    cap = F.col("source_size").cast("decimal(38,0)")
    while left:  # raises the level until no further source is clamped
        level = (budget - epochs * clamped) / left
        is_full = (cap * _integer(epochs.numerator * level.denominator)
                   <= F.col("_weight") * _integer(level.numerator * epochs.denominator))
        full = sources.filter(is_full).agg(F.sum("source_size"), F.sum("_weight")).first()
        now = int(weight) - int(full[1] or 0)
        if now == left:
            break
        left, clamped = now, int(full[0] or 0)
    part = F.col("_weight").cast("decimal(38,0)") * _integer(level.numerator)
    most = F.expr(f"(cast(source_size AS decimal(38,0)) * {epochs.numerator}) div {epochs.denominator}")
    return (sources
            .withColumn("target", F.when(is_full, F.col("source_size") * F.lit(float(epochs)))
                        .otherwise(part.cast("double") / F.lit(float(level.denominator))))
            .withColumn("_part", part * 2 + _integer(level.denominator))
            .withColumn("words", F.when(is_full, most).otherwise(
                F.least(most, F.expr(f"_part div {2 * level.denominator}"))).cast("long"))
            .drop("_place", "_part"))


def _cut(sums: DataFrame, place: list[str], rest: str) -> DataFrame:
    """The first row, in the order ``place`` of each source, whose words pass ``rest``;
    ``rest`` becomes what is left for that row.  ``sums`` has a bounded number
    of rows per source."""
    before = Window.partitionBy("_source").orderBy(*place).rowsBetween(Window.unboundedPreceding, -1)
    return (sums.withColumn("_before", F.coalesce(F.sum("_words").over(before), F.lit(0)))
            .filter((F.col("_before") <= F.col(rest)) & (F.col(rest) < F.col("_before") + F.col("_words")))
            .withColumn(rest, F.col(rest) - F.col("_before")).drop("_before", "_words"))


def _with_source(left: DataFrame, right: DataFrame, *more: Column) -> DataFrame:
    """Inner join on the source, null equal to null (the right's copy is dropped)."""
    right = right.withColumnRenamed("_source", "_of")
    on = F.col("_source").eqNullSafe(F.col("_of"))
    for c in more:
        on = on & c
    return left.join(right, on).drop("_of")


def cuts(docs_rows: DataFrame, weights: tuple = WEIGHTS, share: Fraction = SHARE,
         epochs: Fraction = EPOCHS) -> DataFrame:
    """One row per source: its target, the whole repetitions of each document and
    the place in the seeded order where the last repetition ends (null: nowhere)."""
    sizes = docs_rows.groupBy("_source").agg(F.sum("_size").alias("source_size"))
    sources = targets(sizes, weights, share, epochs).select(
        "_source", "source_size", "target",
        F.expr("CASE WHEN source_size > 0 THEN words div source_size ELSE 0 END").alias("whole"),
        F.expr("CASE WHEN source_size > 0 THEN words % source_size ELSE 0 END").alias("rest"))
    sources = stored(sources, "mixing-targets")
    wanted = sources.filter("rest > 0").select("_source", "rest")
    first = docs_rows.groupBy("_source", "_bucket").agg(F.sum("_size").alias("_words"))
    first = _cut(_with_source(first, wanted), ["_bucket"], "rest")
    first = stored(first.withColumnRenamed("_bucket", "bucket"), "mixing-cut1")
    inside = _with_source(docs_rows, first, F.col("_bucket") == F.col("bucket"))
    second = _cut(inside.groupBy("_source", "bucket", "rest", "_sub").agg(F.sum("_size").alias("_words")), ["_sub"], "rest")
    second = stored(second.withColumnRenamed("_sub", "sub"), "mixing-cut2")
    inside = _with_source(docs_rows, second, (F.col("_bucket") == F.col("bucket")) & (F.col("_sub") == F.col("sub")))
    third = (inside.groupBy("_source", "bucket", "sub", "rest", "_key", "_id", "_size")
             .agg(F.count("*").alias("copies"), F.sum("_size").alias("_words")))
    third = _cut(third, ["_key", "_id", "_size"], "rest").select(
        F.col("_source").alias("_of"), "bucket", "sub", F.col("_key").alias("cut_key"), F.col("_id").alias("cut_id"),
        F.col("_size").alias("cut_size"), "rest", "copies")
    return stored(sources.drop("rest").join(third, F.col("_source").eqNullSafe(F.col("_of")), "left").drop("_of"),
                  "mixing-cuts").select("_source", *_CUT)


def _again(docs_rows: DataFrame, table: DataFrame) -> DataFrame:
    """Adds ``target``, ``whole``, ``source_size`` and ``extra``, the words taken
    beyond the whole repetitions, to rows that have the columns of ``rows``."""
    r = _with_source(docs_rows, table)
    here = F.struct("_key", "_id", "_size")
    cut = F.struct(F.col("cut_key").alias("_key"), F.col("cut_id").alias("_id"), F.col("cut_size").alias("_size"))
    r = r.withColumn("_at", F.when(F.col("bucket").isNull(), 1)
                     .when(F.col("_bucket") != F.col("bucket"), F.when(F.col("_bucket") < F.col("bucket"), -1).otherwise(1))
                     .when(F.col("_sub") != F.col("sub"), F.when(F.col("_sub") < F.col("sub"), -1).otherwise(1))
                     .when(here < cut, -1).when(here > cut, 1).otherwise(0))
    extra = F.when(F.col("_at") < 0, F.col("_size")).when(F.col("_at") > 0, F.lit(0)).otherwise(F.col("rest"))
    if table.filter("copies > 1").isEmpty():
        out = r.withColumn("extra", extra)
    else:  # equal rows at the cut: numbered, and served one after the other
        tied = (F.col("_at") == 0) & (F.col("copies") > 1)
        equal = dense_index(r.filter(tied), [F.col("_source").isNull(), F.col("_source")], "_n")
        start = equal.groupBy("_source").agg(F.min("_n").alias("_start"))
        left = F.col("rest") - (F.col("_n") - F.col("_start")) * F.col("_size")
        equal = _with_source(equal, start).withColumn("extra", F.greatest(F.lit(0), F.least(left, F.col("_size"))))
        out = r.filter(~tied).withColumn("extra", extra).unionByName(equal.drop("_n", "_start"))
    return (out.withColumn("extra", F.col("extra").cast("long"))
            .drop("_at", *[c for c in _CUT if c not in ("target", "whole", "source_size")]))


def repetitions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                weights: tuple = WEIGHTS, share: Fraction = SHARE, epochs: Fraction = EPOCHS,
                seed: int = SEED) -> DataFrame:
    """Per document: id, source, size, source_size, target, whole (repetitions),
    extra (words of the last one) and taken (words in all)."""
    r = rows(docs, id_col, text_col, source_col, seed)
    return _again(r, cuts(r, weights, share, epochs)).select(
        F.col("_id").alias(id_col), F.col("_source").alias(source_col), F.col("_size").alias("size"), "source_size",
        "target", "whole", "extra", (F.col("whole") * F.col("_size") + F.col("extra")).alias("taken"))


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
          weights: tuple = WEIGHTS, share: Fraction = SHARE, epochs: Fraction = EPOCHS,
          seed: int = SEED) -> DataFrame:
    """The mix itself: a row of ``docs`` for each repetition, numbered by ``repetition``
    from 1; a repetition that is cut has its first words, joined by one space."""
    table = cuts(rows(docs, id_col, text_col, source_col, seed), weights, share, epochs)
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"))
    field = lambda c: F.col("_doc").getField(c)
    whole = whole.select("_doc", field(id_col).alias("_id"), field(source_col).alias("_source"),
                         *[c.alias(n) for n, c in _features(field(id_col), field(text_col), seed).items()])
    r = _again(whole, table).withColumn("_n", (F.col("whole") + F.when(F.col("extra") > 0, 1).otherwise(0)).cast("int"))
    r = r.filter("_n > 0 AND _size > 0").withColumn("repetition", F.explode(F.sequence(F.lit(1), F.col("_n"))))
    start = F.array_join(F.slice(F.regexp_extract_all(field(text_col), F.lit(WORD), F.lit(0)), F.lit(1), F.col("extra").cast("int")), " ")
    text = F.when((F.col("repetition") > F.col("whole")) & (F.col("extra") < F.col("_size")), start).otherwise(field(text_col))
    return r.select(*[text.alias(c) if c == text_col else field(c).alias(c) for c in docs.columns if c != "repetition"],
                    "repetition")
