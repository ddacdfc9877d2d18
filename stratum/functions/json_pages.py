"""Page documents <-> records.

A page document is ``{"data": [record, ...]}``.  Unpacking is ``from_json`` with
the declared schema, then ``posexplode`` (the record's position is kept: it is
the tie-break of keep-last), then a struct star to flatten.  Packing is the
inverse: records grouped by page (a group is one page, at most PAGE_SIZE rows),
sorted by position and serialised with ``to_json``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S


def compact_document(doc: Column | str) -> Column:
    """The whole document re-serialised without layout whitespace, every field
    kept (``parse_json`` -> ``to_json``, as load-and-dump would do).  Text that
    is not JSON is kept verbatim: the raw layer loses nothing, and the silver
    stage decides (``strict``) whether such a page is an error."""
    d = F.col(doc) if isinstance(doc, str) else doc
    return F.coalesce(F.to_json(F.try_parse_json(d)), d)


_CORRUPT = "_corrupt"
_PAGE = T.StructType([*S.PAGE.fields, T.StructField(_CORRUPT, T.StringType())])


def _parsed(raw_json: Column | str) -> Column:
    c = F.col(raw_json) if isinstance(raw_json, str) else raw_json
    return F.from_json(c, _PAGE, {"columnNameOfCorruptRecord": _CORRUPT})


def _reason(doc: Column) -> Column:
    """Why a parsed document is no page; NULL for a good one."""
    return (F.when(doc.isNull(), "no document")
            .when(doc.getField(_CORRUPT).isNotNull(), "malformed document or value")
            .when(doc.getField("data").isNull(), "no data array"))


def _data(doc: Column, strict: bool) -> Column:
    reason = _reason(doc)
    good = F.when(reason.isNull(), doc.getField("data"))
    if not strict:
        return good
    return good.otherwise(F.raise_error(F.concat(F.lit("page rejected: "), reason)).cast(S.PAGE["data"].dataType))


def page_records(raw_json: Column | str, strict: bool = True) -> Column:
    """The ``data`` array of a page document as ``array<struct>``.

    A document that does not parse, holds a value that does not fit the declared
    schema, or has no ``data`` raises; with ``strict=False`` it gives NULL as a
    whole (no half-read page) and ``rejected_pages`` lists it.
    """
    return _data(_parsed(raw_json), strict)


def with_records(pages: DataFrame, name: str = "data", strict: bool = True) -> DataFrame:
    """``pages`` with the ``page_records`` of ``raw_json`` as a column.

    The document is a column of its own select before anything is taken from
    it, so it is parsed once however often the records are used."""
    return (pages.select("*", _parsed("raw_json").alias("__doc"))
            .select(*pages.columns, _data(F.col("__doc"), strict).alias(name)))


def rejected_pages(bronze: DataFrame) -> DataFrame:
    """(raw_id, batch_id, page, reason) of the raw rows that are no good page."""
    docs = bronze.select(F.col("id").alias("raw_id"), "batch_id", "page", _parsed("raw_json").alias("doc"))
    return (docs.select("raw_id", "batch_id", "page", _reason(F.col("doc")).alias("reason"))
            .where(F.col("reason").isNotNull()))


def unpack_pages(bronze: DataFrame, strict: bool = True) -> DataFrame:
    """Raw page rows -> one row per record.

    Output: raw_id, batch_id, page, rec_pos, then every record field with the
    silver names (``mal_id`` -> ``anime_id``, ``episodes`` -> ``no_of_episodes``);
    link arrays stay arrays.  A page with an empty ``data`` array yields no rows;
    a bad page raises, or yields no rows with ``strict=False``.
    """
    docs = bronze.select(F.col("id").alias("raw_id"), "batch_id", "page", _parsed("raw_json").alias("doc"))
    exploded = docs.select("raw_id", "batch_id", "page",
                           F.posexplode(_data(F.col("doc"), strict)).alias("rec_pos", "rec"))
    flat = exploded.select("raw_id", "batch_id", "page", "rec_pos", "rec.*")
    return flat.withColumnsRenamed(S.RECORD_RENAMES)


def pack_pages(records: DataFrame, page: str = "page", pos: str = "rec_pos",
               fields: list[str] | None = None) -> DataFrame:
    """Records with (page, pos) -> one row per page: ``page``, ``raw_json``.

    Each group is one page (bounded by the page size), so collecting it is a
    bounded operation; ``array_sort`` on (pos, record) restores record order.
    """
    fields = fields or [c for c in records.columns if c not in (page, pos)]
    rec = F.struct(F.col(pos).alias("p"), F.struct(*fields).alias("r"))
    grouped = records.groupBy(page).agg(F.array_sort(F.collect_list(rec)).alias("__recs"))
    data = F.transform("__recs", lambda e: e.getField("r"))
    return grouped.select(page, F.to_json(F.struct(data.alias("data"))).alias("raw_json"))
