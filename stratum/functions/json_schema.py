"""Schema of JSON documents, found by Spark and compared with the declared one.

``from_json`` with a declared schema gives NULL for a column that no record has,
without a word.  Here every batch's records are aggregated to one schema each
(``schema_of_variant_agg``: a partial aggregate, so a batch holding most of the
records is merged inside its tasks), and the few field names of each batch are
compared with the declared columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas as S


class MissingColumns(ValueError):
    """A declared column occurs in no record."""


def records_of(pages: DataFrame, raw_json: str = "raw_json", path: str = "$.data", by: tuple[str, ...] = ("batch_id",)) -> DataFrame:
    """``by`` columns and ``record`` (variant): the elements of the array at
    ``path`` of every document.  Documents that are not JSON, or have no array
    there, yield none (``rejected_pages`` lists them)."""
    doc = F.try_parse_json(F.col(raw_json))
    parts = pages.select(*by, F.try_variant_get(doc, path, "array<variant>").alias("__records"))
    return parts.select(*by, F.explode("__records").alias("record"))


def discovered_schemas(records: DataFrame, by: tuple[str, ...] = ("batch_id",), record: str = "record") -> DataFrame:
    """One row per ``by`` group: n_records and ``ddl``, the merged schema of its
    records as Spark writes it (``OBJECT<...>``)."""
    return records.groupBy(*by).agg(F.count("*").alias("n_records"), F.schema_of_variant_agg(record).alias("ddl"))


def discovered_fields(records: DataFrame, by: tuple[str, ...] = ("batch_id",), record: str = "record") -> DataFrame:
    """One row per ``by`` group and top-level field: ``field``, ``n_present``
    (records that have it), ``n_null`` (of these, with a JSON null) and ``type``
    (merged over the records that hold a value; NULL without any)."""
    pairs = records.select(*by, F.explode(F.try_variant_get(F.col(record), "$", "map<string, variant>")).alias("field", "value"))
    value = F.when(~F.is_variant_null("value"), F.col("value"))
    null = F.coalesce(F.is_variant_null("value"), F.lit(True))
    kind = F.schema_of_variant_agg(value)
    return pairs.groupBy(*by, "field").agg(
        F.count("*").alias("n_present"), F.count(F.when(null, 1)).alias("n_null"),
        F.when(F.count(F.when(~null, 1)) > 0, kind).alias("type"))


def compare_fields(fields: DataFrame, declared: list[str], by: tuple[str, ...] = ("batch_id",)) -> DataFrame:
    """Declared against found, per ``by`` group: ``field`` and ``status``
    (``ok``, ``missing``: declared and in no record, ``new``: found and not
    declared), with ``n_present`` (0 where missing)."""
    wanted = F.explode(F.array(*[F.lit(c) for c in declared])).alias("field")
    expected = fields.select(*by).distinct().select(*by, wanted, F.lit(1).alias("declared"), F.lit(0).cast("long").alias("n_present"))
    found = fields.select(*by, "field", F.lit(0).alias("declared"), "n_present")
    both = expected.unionByName(found).groupBy(*by, "field").agg(
        F.max("declared").alias("declared"), F.sum("n_present").alias("n_present"))
    status = F.when(F.col("n_present") == 0, "missing").when(F.col("declared") == 0, "new").otherwise("ok")
    return both.select(*by, "field", status.alias("status"), "n_present")


def assert_columns(pages: DataFrame, declared: list[str] | None = None, by: tuple[str, ...] = ("batch_id",)) -> DataFrame:
    """Raise ``MissingColumns`` if a declared record column occurs in no record of
    a batch; else the columns that are new there (by, field, n_present).

    A batch without any record has no columns to compare and passes."""
    declared = declared or [f.name for f in S.PAGE["data"].dataType.elementType]
    compared = compare_fields(discovered_fields(records_of(pages, by=by), by), declared, by)
    # at most (declared + new) names a batch: a bounded list for the message
    missing = compared.filter("status = 'missing'").orderBy(*by, "field").limit(20).collect()
    if missing:
        raise MissingColumns("in no record: " + ", ".join(
            " ".join([*(f"{c} {r[c]}" for c in by), r["field"]]) for r in missing))
    return compared.filter("status = 'new'").drop("status")

