"""Bronze -> silver: unpack pages, flatten records, extract link tables,
keep the last copy of every key.

One lazy DataFrame graph per output table; no row leaves the executors.

* entity ``anime``: one row per ``anime_id`` (ENTITY_COLUMNS), the last record
  by (batch, raw_id, position in page)
* ``links_anime_<kind>``: one row per (anime_id, X_id) with X_name, the last
  by (batch, raw_id, record position, position in the link array).  Links are taken
  from every record before the entity is de-duplicated, so two copies of a
  title contribute the union of their links.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.json_pages import unpack_pages
from ..functions.links import extract_links
from ..operators.dedup import keep_last
from ..sources.bronze import scan_batch

ORDER = ["batch_id", "raw_id", "rec_pos"]


def records(bronze: DataFrame, batch_id: int | None = None, strict: bool = True) -> DataFrame:
    """One row per record of the chosen (default: latest) batch."""
    return unpack_pages(scan_batch(bronze, batch_id), strict)


def entity(recs: DataFrame) -> DataFrame:
    cols = list(dict.fromkeys(S.ENTITY_COLUMNS + ORDER))
    return keep_last(recs.select(*cols), S.ENTITY_KEY, ORDER).select(*S.ENTITY_COLUMNS)


def link_table(recs: DataFrame, kind: str, with_batch: bool = False) -> DataFrame:
    prefix = S.LINK_NAMES[kind]
    rows = extract_links(recs, kind, prefix, keep=ORDER)
    return keep_last(rows, S.link_key(prefix), ORDER + ["link_pos"]).select(
        *S.link_table_columns(prefix), *(["batch_id"] if with_batch else []))


def build_silver(bronze: DataFrame, batch_id: int | None = None,
                 strict: bool = True) -> dict[str, DataFrame]:
    """The staging frames of one batch: ``anime`` and the six link tables.

    A bad page raises; with ``strict=False`` it is left out as a whole (see
    ``functions.json_pages.rejected_pages``)."""
    return from_records(records(bronze, batch_id, strict))


def from_records(recs: DataFrame, with_batch: bool = False) -> dict[str, DataFrame]:
    """The staging frames of unpacked records; ``with_batch`` keeps the batch that
    a link was last seen in."""
    out = {"anime": entity(recs)}
    for kind, _ in S.LINK_KINDS:
        out[f"links_anime_{kind}"] = link_table(recs, kind, with_batch)
    return out


def bronze_from_pages(pages: DataFrame) -> DataFrame:
    """Page rows (batch_id, page, raw_json) as raw-table rows with ids in
    (batch, page) order and the load time; for in-memory runs and tests."""
    from ..operators.sequence import dense_index

    return (dense_index(pages, ["batch_id", "page"], "id", key=["batch_id", "page"])
            .withColumn("loaded_at", F.current_timestamp())
            .select(*[f.name for f in S.BRONZE.fields]))
