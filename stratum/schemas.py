"""Declared schemas and the fixed names of the title data model.

The reference infers the record layout from the documents; we declare it, so an
absent field becomes NULL and a document that is not JSON can be made to fail
(``mode=FAILFAST``) instead of silently vanishing.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for the same results.
# Link kinds of a title, in the order the reference lists them, as
# (array field in the page record, singular prefix used in column names).
LINK_KINDS = [
    ("producers", "producer"),
    ("licensors", "licensor"),
    ("studios", "studio"),
    ("genres", "genre"),
    ("themes", "theme"),
    ("demographics", "demographic"),
]
# Surrogate-key dimensions built from a string column of the entity:
# (dimension name, entity column).
SURROGATE_DIMS = [("d_sources", "source"), ("d_statuses", "status"), ("d_types", "type")]
# Records per page in the page documents.
PAGE_SIZE = 25
# Page-level popularity cut: a page is kept while its last record has at least
# this many members.
MIN_MEMBERS = 10000
# Declared tests of the silver tables: unique + not_null on the entity key,
# not_null on both key columns of every link table.
SOURCE_TESTS = [("anime", "anime_id", "unique"), ("anime", "anime_id", "not_null")] + [
    (f"links_anime_{kind}", col, "not_null")
    for kind, prefix in LINK_KINDS for col in ("anime_id", f"{prefix}_id")]
# Record fields renamed in the silver entity.
RECORD_RENAMES = {"mal_id": "anime_id", "episodes": "no_of_episodes"}
# Dashboard defaults: year window and minimum group support.
DEFAULT_YEAR_RANGE = (2010, 2024)
MIN_SUPPORT = 5
# ---------------------------------------------------------------------------

LINK_NAMES = {kind: prefix for kind, prefix in LINK_KINDS}


def link_cols(prefix: str) -> tuple[str, str]:
    """Column names of a link kind: ``genre`` -> (``genre_id``, ``genre_name``)."""
    return f"{prefix}_id", f"{prefix}_name"


ID_NAME = T.StructType([
    T.StructField("mal_id", T.IntegerType()),
    T.StructField("name", T.StringType()),
])

# One record of a page's ``data`` array: only the fields the pipeline reads.
RECORD = T.StructType([
    T.StructField("mal_id", T.IntegerType()),
    T.StructField("title", T.StringType()),
    T.StructField("title_english", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("episodes", T.IntegerType()),
    T.StructField("status", T.StringType()),
    T.StructField("duration", T.StringType()),
    T.StructField("score", T.FloatType()),
    T.StructField("scored_by", T.IntegerType()),
    T.StructField("rank", T.IntegerType()),
    T.StructField("popularity", T.IntegerType()),
    T.StructField("members", T.IntegerType()),
    T.StructField("favorites", T.IntegerType()),
    T.StructField("year", T.IntegerType()),
] + [T.StructField(kind, T.ArrayType(ID_NAME)) for kind, _ in LINK_KINDS])

PAGE = T.StructType([T.StructField("data", T.ArrayType(RECORD))])

BRONZE = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("batch_id", T.IntegerType(), False),
    T.StructField("page", T.IntegerType(), False),
    T.StructField("loaded_at", T.TimestampType(), False),
    T.StructField("raw_json", T.StringType()),
])

# Silver entity columns in table order (``loaded_at`` is added on write).
ENTITY_COLUMNS = [
    "raw_id", "batch_id", "page", "anime_id", "title", "title_english", "type", "source",
    "no_of_episodes", "status", "duration", "score", "scored_by", "rank", "popularity",
    "members", "favorites", "year",
]
ENTITY_KEY = ["anime_id"]

FACT_COLUMNS = [
    "anime_id", "title", "title_english", "no_of_episodes", "duration_minutes_per_episode",
    "score", "scored_by", "rank", "popularity", "members", "favorites", "year",
    "status_id", "type_id", "source_id",
]


def link_table_columns(prefix: str) -> list[str]:
    i, n = link_cols(prefix)
    return ["anime_id", i, n]


def link_key(prefix: str) -> list[str]:
    return ["anime_id", link_cols(prefix)[0]]


_ENTITY_TYPES = {
    "raw_id": T.LongType(), "batch_id": T.IntegerType(), "page": T.IntegerType(),
    "anime_id": T.IntegerType(), "no_of_episodes": T.IntegerType(), "score": T.FloatType(),
    "scored_by": T.IntegerType(), "rank": T.IntegerType(), "popularity": T.IntegerType(),
    "members": T.IntegerType(), "favorites": T.IntegerType(), "year": T.IntegerType(),
}


def silver_schema(name: str) -> T.StructType:
    """Declared schema of a stored silver table (``anime`` or ``links_anime_<kind>``),
    ``loaded_at`` included."""
    if name == "anime":
        fields = [T.StructField(c, _ENTITY_TYPES.get(c, T.StringType())) for c in ENTITY_COLUMNS]
    else:
        prefix = LINK_NAMES[name.removeprefix("links_anime_")]
        i, n = link_cols(prefix)
        fields = [T.StructField("anime_id", T.IntegerType()), T.StructField(i, T.IntegerType()),
                  T.StructField(n, T.StringType())]
    return T.StructType(fields + [T.StructField("loaded_at", T.TimestampType())])
