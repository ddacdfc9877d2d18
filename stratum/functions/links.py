"""Link arrays (``array<struct<mal_id, name>>``) -> many-to-many link rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import link_cols


def rename_link_fields(arr: Column | str, prefix: str) -> Column:
    """Keep only the id and the name of each element, renamed with ``prefix``.

    ``getField`` is used on purpose: ``e.name`` would be ``Column.name``.
    """
    a = F.col(arr) if isinstance(arr, str) else arr
    i, n = link_cols(prefix)
    return F.transform(a, lambda e: F.struct(e.getField("mal_id").alias(i),
                                             e.getField("name").alias(n)))


def extract_links(df: DataFrame, kind: str, prefix: str,
                  keep: list[str] | None = None) -> DataFrame:
    """One row per element of array column ``kind``: anime_id, X_id, X_name.

    ``keep`` columns (e.g. order columns for keep-last) are carried along, plus
    ``link_pos``, the element's position.  Rows with a NULL in any of anime_id,
    X_id, X_name are dropped; empty and NULL arrays yield nothing.
    """
    i, n = link_cols(prefix)
    keep = list(keep or [])
    exploded = df.select("anime_id", *keep,
                         F.posexplode(rename_link_fields(kind, prefix)).alias("link_pos", "__e"))
    out = exploded.select("anime_id", F.col(f"__e.{i}").alias(i), F.col(f"__e.{n}").alias(n),
                          *keep, "link_pos")
    return out.na.drop("any", subset=["anime_id", i, n])
