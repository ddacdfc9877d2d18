"""Adapter: the provided TPC-H-like tables seen as the title data model.

The pipeline and the marts are written for the title model (entity + six link
kinds).  This module derives that model from the given tables with Spark, so
every registered query does work that grows with them:

  title (entity)   one order with its customer
                   anime_id = o_orderkey, title / title_english = c_name,
                   type = o_orderpriority, source = c_mktsegment,
                   status = o_orderstatus, year = year(o_orderdate),
                   members = o_totalprice in cents, score = c_acctbal in cents
                   (integer measures: sums and means are exact in any engine),
                   scored_by = o_custkey, rank = c_nationkey,
                   popularity = month, favorites / no_of_episodes = day of month,
                   duration = text in five formats built from the order date
  genres           part brand of the order's line items (id = number in the brand)
  producers        part of the line items
  studios          supplier of the line items
  licensors        nation of those suppliers
  themes           region of those suppliers
  demographics     nation of the customer

Orders without line items have no links (left joins see NULLs); the entity is
one batch (``batch_id`` 1) unless a batch column is given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..operators.joins import HOT_ROWS, heavy_hitters
from ..session import stored

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


class Tables:
    """Lazy accessor for the provided tables of one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return read_table(self.spark, self.sf_dir, name)


def duration_text() -> F.Column:
    """Duration text of the stand-in title, one format per order priority."""
    d = F.dayofmonth("o_orderdate").cast("string")
    m = F.month("o_orderdate").cast("string")
    p = F.col("o_orderpriority")
    return (F.when(p == "1-URGENT", F.concat(d, F.lit(" min per ep")))
            .when(p == "2-HIGH", F.concat(m, F.lit(" hr "), d, F.lit(" min")))
            .when(p == "3-MEDIUM", F.concat(d, F.lit(" sec per ep")))
            .when(p == "4-NOT SPECIFIED", F.concat(m, F.lit(" hr")))
            .otherwise(F.lit("Unknown")))


def titles(t: Tables, batch: F.Column | None = None) -> DataFrame:
    """Silver-shaped entity rows (``ENTITY_COLUMNS``) from orders and customers."""
    o = t.orders
    c = t.customer.select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    j = o.join(c, o.o_custkey == c.c_custkey, "inner")
    return j.select(
        F.lit(0).cast("long").alias("raw_id"),
        (batch if batch is not None else F.lit(1)).cast("int").alias("batch_id"),
        F.lit(0).alias("page"),
        F.col("o_orderkey").alias("anime_id"),
        F.col("c_name").alias("title"),
        F.col("c_name").alias("title_english"),
        F.col("o_orderpriority").alias("type"),
        F.col("c_mktsegment").alias("source"),
        F.dayofmonth("o_orderdate").alias("no_of_episodes"),
        F.col("o_orderstatus").alias("status"),
        duration_text().alias("duration"),
        F.round(F.col("c_acctbal") * 100).cast("int").alias("score"),
        F.col("o_custkey").cast("int").alias("scored_by"),
        F.col("c_nationkey").alias("rank"),
        F.month("o_orderdate").alias("popularity"),
        F.round(F.col("o_totalprice") * 100).cast("long").alias("members"),
        F.dayofmonth("o_orderdate").alias("favorites"),
        F.year("o_orderdate").alias("year"),
    )


def link_rows(t: Tables, kinds: list[str], by_title: bool = False) -> DataFrame:
    """(kind, anime_id, id, name) of the line-item link kinds, one pass over
    the line items, before de-duplication; ``id`` is a long.  ``by_title`` brings
    the lines of a title together before a line becomes a row per kind."""
    j = t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey")
    found = {}
    if {"genres", "producers"} & set(kinds):
        # the brand number is derived on the part side, once per part
        p = t.part.select("p_partkey", "p_brand", "p_name",
                          F.regexp_extract("p_brand", r"(\d+)", 1).cast("int").alias("p_brand_id"))
        j = j.join(p, j.l_partkey == p.p_partkey)
        found |= {"genres": ("p_brand_id", "p_brand"), "producers": ("p_partkey", "p_name")}
    if {"studios", "licensors", "themes"} & set(kinds):
        s = t.supplier.select("s_suppkey", "s_name", "s_nationkey")
        found["studios"] = ("s_suppkey", "s_name")
        if {"licensors", "themes"} & set(kinds):
            nat = t.nation.select("n_nationkey", "n_name", "n_regionkey")
            s = s.join(nat, s.s_nationkey == nat.n_nationkey)
            found["licensors"] = ("n_nationkey", "n_name")
            if "themes" in kinds:
                r = t.region.select("r_regionkey", "r_name")
                s = s.join(r, s.n_regionkey == r.r_regionkey)
                found["themes"] = ("r_regionkey", "r_name")
        j = j.join(s, j.l_suppkey == s.s_suppkey)
    if by_title:  # a number of its own: AQE would merge partitions by their size before the rows multiply
        j = j.repartition(int(t.spark.conf.get("spark.sql.shuffle.partitions")), "l_orderkey")
    tagged = [F.struct(F.lit(k).alias("kind"), F.col(found[k][0]).cast("long").alias("id"), F.col(found[k][1]).alias("name"))
              for k in kinds]
    return j.select(F.col("l_orderkey").alias("anime_id"), F.explode(F.array(*tagged)).alias("x")).select(
        "x.kind", "anime_id", "x.id", "x.name")


def demographic_rows(t: Tables) -> DataFrame:
    """(anime_id, id, name) of the one link kind that does not come from line items."""
    o = t.orders.select("o_orderkey", "o_custkey")
    c = t.customer.select("c_custkey", "c_nationkey")
    nat = t.nation.select("n_nationkey", "n_name")
    j = o.join(c, o.o_custkey == c.c_custkey).join(nat, c.c_nationkey == nat.n_nationkey)
    return j.select(F.col("o_orderkey").alias("anime_id"), F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"))


def _id_type(t: Tables, kind: str):
    if kind == "genres":
        return "int"
    table, column = {"producers": (t.part, "p_partkey"), "studios": (t.supplier, "s_suppkey"),
                     "licensors": (t.nation, "n_nationkey"), "themes": (t.region, "r_regionkey"),
                     "demographics": (t.nation, "n_nationkey")}[kind]
    return table.schema[column].dataType


def links(t: Tables, kinds: list[str]) -> dict[str, DataFrame]:
    """Silver link tables (anime_id, X_id, X_name), one row per (anime_id, X_id).

    In these tables the name is a function of the id, so keeping the last copy
    of a key is a plain distinct (a hash aggregate, combined map-side).  All
    kinds that come from line items are derived in one pass and stored as Parquet
    in the checkpoint folder, as the silver tables would be: the marts read them
    several times, a kind and a few columns each.

    The lines are shuffled by title and the rows of a title made and de-duplicated
    where they are: combined map-side they hardly shrink, and there are more of them
    than a map task's hash table holds.  With a title of very many lines (or very
    many lines without one) the rows are combined map-side and dealt by all columns."""
    out = {}
    from_lines = [k for k in kinds if k != "demographics"]
    if from_lines:
        titles_of_lines = t.lineitem.select(F.coalesce("l_orderkey", F.lit(-1)).alias("l_orderkey"))
        hot = heavy_hitters(titles_of_lines, "l_orderkey", HOT_ROWS)
        rows = stored(link_rows(t, from_lines, by_title=not hot).distinct(), "links")
        out = {k: rows.where(F.col("kind") == k) for k in from_lines}
    if "demographics" in kinds:
        out["demographics"] = demographic_rows(t).distinct()
    for kind, df in out.items():
        i, n = S.link_cols(S.LINK_NAMES[kind])
        out[kind] = df.select("anime_id", F.col("id").cast(_id_type(t, kind)).alias(i), F.col("name").alias(n))
    return out


def silver(t: Tables, kinds: list[str] | None = None,
           batch: F.Column | None = None) -> dict[str, DataFrame]:
    """Entity and link tables in the silver shape."""
    wanted = [kind for kind, _ in S.LINK_KINDS if kinds is None or kind in kinds]
    tables = links(t, wanted)
    return {"anime": titles(t, batch), **{f"links_anime_{kind}": tables[kind] for kind in wanted}}


def page_records(t: Tables, kinds: list[str] | None = None) -> DataFrame:
    """Titles as page records: the fields of ``schemas.RECORD`` with nested
    link arrays, one row per title (links collected per title: a group is one
    title's links, bounded by its line items)."""
    ent = titles(t)
    rec = ent.select(
        F.col("anime_id").cast("int").alias("mal_id"), "title", "title_english", "type", "source",
        F.col("no_of_episodes").alias("episodes"), "status", "duration",
        F.col("score").cast("float").alias("score"), "scored_by", "rank", "popularity",
        F.col("members").cast("int").alias("members"), "favorites", "year")
    tables = links(t, [kind for kind, _ in S.LINK_KINDS if kinds is None or kind in kinds])
    for kind in tables:
        i, n = S.link_cols(S.LINK_NAMES[kind])
        # De-duplicated links first: the array of a title then holds one entry
        # per distinct target, ordered by id.
        arr = (tables[kind]
               .groupBy("anime_id")
               .agg(F.array_sort(F.collect_list(F.struct(
                   F.col(i).cast("int").alias("mal_id"), F.col(n).alias("name")))).alias(kind))
               .select(F.col("anime_id").cast("int").alias("mal_id"), kind))
        rec = rec.join(arr, "mal_id", "left")
    return rec
