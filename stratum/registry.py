"""Named queries over the provided tables (``(spark, sf_dir) -> DataFrame``).

Each one maps the given tables onto the title model (``plans.standin``) and
runs the library's stages and operators over the whole tables.  The matching
DuckDB SQL is in ``oracle_sql``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import schemas as S
from .functions.duration import duration_minutes
from .functions.json_pages import pack_pages, unpack_pages
from .functions.json_schema import discovered_fields
from .functions.links import extract_links
from .functions.misc import number_in_name
from .operators import quality as Q
from .operators.dedup import keep_last
from .operators.sequence import dense_index
from .operators.upsert import upsert
from .plans import marts as M
from .plans import standin
from .plans.gold import build_gold, gold_links
from .plans.silver import bronze_from_pages, build_silver
from .plans.stored_marts import StoredMarts
from .session import ensure_checkpoint_dir, stored
from .sources import bronze as B
from .sources.bucket_store import BucketStore
from .sources.file_ledger import load_new_files
from .sources.page_sink import write_named_pages
from .sources.pages import page_last_members, paginate, take_while_pages

# Parameters used on the provided tables.  Their orders span 1995-2001, so the
# dashboard's default window 2010-2024 would select nothing; members are cents.
YEARS = (1996, 2000)
MIN_SUPPORT_PRODUCERS = 150
TAKE_WHILE_MIN_MEMBERS = 20_000_000
PAGE_FILE_BATCHES = 4
MART_BUCKETS = 16
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _tables(spark: SparkSession, sf_dir: str) -> standin.Tables:
    ensure_checkpoint_dir(spark)
    return standin.Tables(spark, sf_dir)


def _gold(spark: SparkSession, sf_dir: str, kinds: list[str] | None = None):
    return build_gold(standin.silver(_tables(spark, sf_dir), kinds))


def _filtered(g, fanout=True, names=()):
    return M.year_filter(M.titles(g, fanout, list(names)), YEARS)


# ------------------------------------------------------------------- marts
@query
def q_category_share_by_year(spark, sf_dir):
    g = _gold(spark, sf_dir, ["licensors", "genres"])
    return M.genre_share_by_year(g, _filtered(g), 10)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q_category_share_by_year(spark, sf_dir)


@query
def q_enriched_asis(spark, sf_dir):
    g = _gold(spark, sf_dir, ["licensors", "genres"])
    return M.kpis(_filtered(g))


@query
def q_enriched_dedup(spark, sf_dir):
    g = _gold(spark, sf_dir, ["licensors", "genres"])
    return M.kpis(_filtered(g, fanout=False))


def _nullable_ids_as_double(df, cols):
    """Link ids that are NULL for titles without links, presented as double:
    pandas holds a nullable int column as float (Spark) or as a nullable Int
    (DuckDB); as double both sides hold the same values the same way."""
    return df.withColumns({c: F.col(c).cast("double") for c in cols})


@query
def q_enriched_rows(spark, sf_dir):
    g = _gold(spark, sf_dir, ["licensors", "genres"])
    return _nullable_ids_as_double(M.year_filter(M.enriched(g), YEARS), ["licensor_id", "genre_id"])


@query
def q_bubble_rows(spark, sf_dir):
    g = _gold(spark, sf_dir, ["licensors", "genres"])
    return M.bubble_rows(M.year_filter(M.enriched(g), YEARS))


@query
def q_category_summary_top15(spark, sf_dir):
    g = _gold(spark, sf_dir, ["licensors", "genres"])
    return M.genre_top(g, M.titles(g, names=[]), 15)


@query
def q_category_summary_top15_dedup(spark, sf_dir):
    g = _gold(spark, sf_dir, ["licensors", "genres"])
    return M.genre_top(g, M.titles(g, fanout=False, names=[]), 15)


@query
def q_stored_marts(spark, sf_dir):
    """Genre summary from the stored partial sums of bucketed silver tables, refreshed
    after the titles of the last order date have been upserted with more members."""
    t = _tables(spark, sf_dir)
    silver = standin.silver(t, ["licensors", "genres"])
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/stored-marts-{uuid.uuid4().hex}"
    store = BucketStore(spark, f"{root}/curated", {n: (df.schema, "anime_id") for n, df in silver.items()}, MART_BUCKETS)
    for name, df in silver.items():
        store.upsert(name, df, ["anime_id", *(c for c in df.columns if name != "anime" and c.endswith("_id") and c != "anime_id")])
    marts = StoredMarts(store, f"{root}/marts")
    marts.refresh()
    last = t.orders.where(F.col("o_orderdate") == t.orders.select(F.max("o_orderdate")).scalar())
    late = silver["anime"].join(last.select(F.col("o_orderkey").alias("anime_id")), "anime_id", "left_semi")
    store.upsert("anime", late.withColumn("members", F.col("members") + 1000), ["anime_id"])
    marts.refresh()
    return marts.genre_summary()


@query
def q_source_analysis(spark, sf_dir):
    return M.source_analysis(_filtered(_gold(spark, sf_dir, ["licensors", "genres"]), names=["source"]))


@query
def q_source_share(spark, sf_dir):
    return M.source_share(_filtered(_gold(spark, sf_dir, ["licensors", "genres"]), names=["source"]))


@query
def q_source_summary(spark, sf_dir):
    return M.source_summary(_filtered(_gold(spark, sf_dir, ["licensors", "genres"]), names=["source"]))


@query
def q_source_summary_dedup(spark, sf_dir):
    return M.source_summary(_filtered(_gold(spark, sf_dir, ["licensors", "genres"]), fanout=False, names=["source"]))


@query
def q_year_trend(spark, sf_dir):
    return M.year_trend(_filtered(_gold(spark, sf_dir, ["licensors", "genres"])))


@query
def q_year_trend_dedup(spark, sf_dir):
    return M.year_trend(_filtered(_gold(spark, sf_dir, ["licensors", "genres"]), fanout=False))


@query
def q_dim_metrics_supplier(spark, sf_dir):
    g = _gold(spark, sf_dir, ["licensors", "genres", "studios"])
    return M.dim_metrics(g, "studios", _filtered(g))


@query
def q_dim_metrics_part(spark, sf_dir):
    g = _gold(spark, sf_dir, ["licensors", "genres", "producers"])
    return M.dim_metrics(g, "producers", _filtered(g), MIN_SUPPORT_PRODUCERS)


@query
def q_dim_metrics_nation(spark, sf_dir):
    g = _gold(spark, sf_dir, ["licensors", "genres"])
    return M.licensor_metrics(g, _filtered(g))


@query
def q_industry_avg(spark, sf_dir):
    g = _gold(spark, sf_dir, ["licensors", "genres", "studios"])
    avg = M.industry_average(M.dim_metrics(g, "studios", _filtered(g)))
    # A mean of means is summed in no fixed order; 6 decimals make it comparable.
    return avg.select(F.round("industry_avg_score", 6).alias("industry_avg_score"))


@query
def q_year_bounds(spark, sf_dir):
    return M.year_bounds(_gold(spark, sf_dir, []))


# -------------------------------------------------------------------- gold
def _surrogate(name):
    def q(spark, sf_dir):
        return _gold(spark, sf_dir, [])[name]
    return q


QUERIES["q_dim_surrogate_status"] = _surrogate("d_statuses")
QUERIES["q_dim_surrogate_type"] = _surrogate("d_types")
QUERIES["q_dim_surrogate_source"] = _surrogate("d_sources")


@query
def q_dim_natural(spark, sf_dir):
    """All six natural-key dimensions in one frame: dim, X_id, X_name."""
    g = _gold(spark, sf_dir)
    out = None
    for kind, prefix in S.LINK_KINDS:
        i, n = S.link_cols(prefix)
        d = g[f"d_{kind}"].select(F.lit(f"d_{kind}").alias("dim"),
                                  F.col(i).cast("bigint").alias("x_id"), F.col(n).alias("x_name"))
        out = d if out is None else out.unionByName(d)
    return out


@query
def q_link_sorted(spark, sf_dir):
    """All six gold link tables, range-partitioned and sorted by key."""
    t = _tables(spark, sf_dir)
    tables = standin.links(t, [kind for kind, _ in S.LINK_KINDS])
    out = None
    for kind, prefix in S.LINK_KINDS:
        i, _ = S.link_cols(prefix)
        lk = gold_links(tables[kind], prefix, sort=True).select(
            F.lit(f"links_{kind}").alias("link"), "anime_id", F.col(i).cast("bigint").alias("x_id"))
        out = lk if out is None else out.unionByName(lk)
    return out


@query
def q_fact(spark, sf_dir):
    return _gold(spark, sf_dir, [])["f_anime"]


@query
def q_fact_latest_batch(spark, sf_dir):
    """Entity with batch = order year; the fact keeps the latest batch while
    the surrogate dimensions come from every batch."""
    t = _tables(spark, sf_dir)
    silver = {"anime": standin.titles(t, batch=F.year("o_orderdate"))}
    return build_gold(silver)["f_anime"]


@query
def q_star_select(spark, sf_dir):
    return _nullable_ids_as_double(M.star_select(_gold(spark, sf_dir, ["genres"]), "genres"), ["genre_id"])


@query
def q_duration_minutes(spark, sf_dir):
    """Duration text in nine formats built from every part row (format chosen
    by part type and size band), parsed to minutes."""
    p = _tables(spark, sf_dir).part
    s = F.col("p_size").cast("string")
    h = F.ceil(F.col("p_size") / 20).cast("string")          # 1..3 hours
    small = F.col("p_size") <= 25
    ty = F.col("p_type")
    text = (F.when((ty == "STANDARD") & small, F.concat(s, F.lit(" min per ep")))
            .when((ty == "STANDARD") & ~small, F.concat(h, F.lit(" hr "), s, F.lit(" min per ep")))
            .when((ty == "LARGE") & small, F.concat(s, F.lit(" min")))
            .when((ty == "LARGE") & ~small, F.concat(s, F.lit(" min "), s, F.lit(" sec")))
            .when((ty == "SMALL") & small, F.concat(h, F.lit(" hr "), s, F.lit(" min "), s, F.lit(" sec")))
            .when((ty == "SMALL") & ~small, F.concat(s, F.lit(" sec per ep")))
            .when(ty == "ECONOMY", F.concat(h, F.lit(" hr")))
            .when(ty == "PROMO", F.lit("Unknown"))
            .otherwise(F.concat(s, F.lit(" MIN"))))
    return (p.select("p_partkey", text.alias("duration"))
            .withColumn("minutes", duration_minutes("duration")))


# ------------------------------------------------------------ silver, json
def _pages(t):
    """Titles cut into page documents of 25, by members desc then id."""
    recs = paginate(standin.page_records(t, ["genres"]), [F.desc("members"), F.asc("mal_id")], key=["mal_id"],
                    columns=("members",))
    fields = [f.name for f in S.RECORD.fields if f.name in recs.columns]
    return pack_pages(recs.select("page", "rec_pos", *fields), fields=fields)


@query
def q_json_page_unpack(spark, sf_dir):
    t = _tables(spark, sf_dir)
    pages = _pages(t).withColumn("batch_id", F.lit(1)).withColumn("id", F.col("page").cast("long"))
    recs = unpack_pages(pages)
    return recs.select("page", "rec_pos", "anime_id", "title", "type", "source", "status",
                       "duration", "score", "members", "year",
                       F.coalesce(F.size("genres"), F.lit(0)).alias("n_genres"))


@query
def q_struct_array_links(spark, sf_dir):
    """Genre arrays of the page records, one name blanked (NULL) per rule,
    exploded to link rows; rows with a NULL are dropped, duplicates kept last."""
    t = _tables(spark, sf_dir)
    recs = standin.page_records(t, ["genres"]).withColumnRenamed("mal_id", "anime_id")
    recs = recs.withColumn("genres", F.transform(
        "genres", lambda e: F.struct(e.getField("mal_id").alias("mal_id"),
                                     F.nullif(e.getField("name"), F.lit("Brand#1")).alias("name"))))
    rows = extract_links(recs, "genres", "genre")
    return keep_last(rows, ["anime_id", "genre_id"], ["link_pos"], drop_order=True)


@query
def q_event_props(spark, sf_dir):
    ev = _tables(spark, sf_dir).events
    k = F.from_json("props", "k int").getField("k")
    return ev.select("event_id", "event_type", k.alias("k"))


@query
def q_discovered_fields(spark, sf_dir):
    """Fields, presence, nulls and merged types of the event documents, by event type."""
    ev = _tables(spark, sf_dir).events
    return discovered_fields(ev.select("event_type", F.try_parse_json("props").alias("record")), by=("event_type",))


@query
def q_keep_last(spark, sf_dir):
    li = _tables(spark, sf_dir).lineitem
    order = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
             "l_discount", "l_tax", "l_returnflag", "l_linestatus"]
    return keep_last(li, ["l_orderkey", "l_linenumber"], order)


@query
def q_pipeline_end_to_end(spark, sf_dir):
    """Page documents -> raw rows -> silver (unpack, keep-last) -> gold fact."""
    t = _tables(spark, sf_dir)
    pages = _pages(t).withColumn("batch_id", F.lit(1))
    silver = build_silver(bronze_from_pages(pages))
    # kept once, as the stored silver table would be: dims and fact start from it
    silver["anime"] = silver["anime"].checkpoint()
    return build_gold(silver)["f_anime"]


@query
def q_silver_links_from_pages(spark, sf_dir):
    t = _tables(spark, sf_dir)
    pages = _pages(t).withColumn("batch_id", F.lit(1))
    return build_silver(bronze_from_pages(pages))["links_anime_genres"]


@query
def q_silver_keep_last(spark, sf_dir):
    """Every line item as a page record of its order, so a title is on as many
    pages as it has lines: the last page wins, the part links are the union (a
    link without a name is no link), NULLs survive."""
    li = _tables(spark, sf_dir).lineitem
    order, line, part = F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey")
    link = F.struct(part.cast("int").alias("mal_id"), F.when(part % 7 != 0, F.concat(F.lit("p"), part)).alias("name"))
    recs = li.select(
        (line + 8 * F.floor(order / 100)).alias("page"), order.alias("rec_pos"), order.cast("int").alias("mal_id"),
        F.concat(F.lit("t"), line).alias("title"), F.when(line % 2 == 0, F.concat(F.lit("s"), line)).alias("source"),
        F.array(link).alias("producers"))
    raw = pack_pages(recs, fields=["mal_id", "title", "source", "producers"]).select(
        F.col("page").cast("long").alias("id"), F.lit(1).alias("batch_id"), F.col("page").cast("int").alias("page"), "raw_json")
    silver = build_silver(raw)
    n = silver["links_anime_producers"].groupBy("anime_id").agg(F.count("*").alias("n_links"))
    return (silver["anime"].join(n, "anime_id", "left")
            .select("anime_id", "title", "source", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")))


@query
def q_upsert_links(spark, sf_dir):
    """Upsert with a composite key: line items of even suppliers change."""
    li = _tables(spark, sf_dir).lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", "l_suppkey")
    target = li.where("l_suppkey % 3 != 0").drop("l_suppkey")
    source = li.where("l_suppkey % 2 = 0").drop("l_suppkey").withColumn("l_returnflag", F.lit("U"))
    return upsert(target, source, ["l_orderkey", "l_linenumber"])


@query
def q_kpi_labels(spark, sf_dir):
    g = _gold(spark, sf_dir, ["licensors", "genres"])
    # the mean is rounded first: two engines' last digits do not decide a label
    k = M.kpis(_filtered(g)).withColumn("avg_score", F.round("avg_score", 4))
    return M.kpi_labels(k)


@query
def q_dim_metrics_part_5(spark, sf_dir):
    """Producers with the default minimum support."""
    g = _gold(spark, sf_dir, ["licensors", "genres", "producers"])
    return M.dim_metrics(g, "producers", _filtered(g))


@query
def q_category_share_zero_year(spark, sf_dir):
    """Shares by year where one year's titles have no members at all."""
    g = _gold(spark, sf_dir, ["licensors", "genres"])
    t = _filtered(g).withColumn("members", F.when(F.col("year") == 1998, F.lit(0)).otherwise(F.col("members")))
    return M.genre_share_by_year(g, t, 10)


# ------------------------------------------------------------------ upsert
ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
              "o_orderpriority"]


def _upsert_inputs(spark, sf_dir):
    """Target = orders up to mid-1999 as they were; source = orders from 1998
    on with a changed status and price (1998 to mid-1999 update, later insert)."""
    o = _tables(spark, sf_dir).orders.select(*ORDER_COLS)
    target = o.where(F.col("o_orderdate") < F.lit("1999-07-01").cast("timestamp_ntz"))
    source = (o.where(F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz"))
              .withColumn("o_orderstatus", F.lit("U"))
              .withColumn("o_totalprice", F.col("o_totalprice") + 1))
    return target, source


@query
def q_upsert(spark, sf_dir):
    target, source = _upsert_inputs(spark, sf_dir)
    return upsert(target, source, ["o_orderkey"])


@query
def q_upsert_twice(spark, sf_dir):
    target, source = _upsert_inputs(spark, sf_dir)
    return upsert(upsert(target, source, ["o_orderkey"]), source, ["o_orderkey"])


# ------------------------------------------------------------------ bronze
def _event_batches(spark, sf_dir):
    """Events with batch = day of month; the first 14 days are loaded."""
    ev = _tables(spark, sf_dir).events.withColumn("batch_id", F.dayofmonth("ts"))
    loaded = ev.where(F.col("ts") < F.lit("2024-01-15").cast("timestamp_ntz"))
    return ev, loaded


@query
def q_missing_batches(spark, sf_dir):
    ev, loaded = _event_batches(spark, sf_dir)
    return B.missing_batches(ev, loaded)


@query
def q_incremental_rows(spark, sf_dir):
    ev, loaded = _event_batches(spark, sf_dir)
    return B.rows_to_load(ev, loaded).select("event_id", "batch_id")


@query
def q_next_batch(spark, sf_dir):
    ev, _ = _event_batches(spark, sf_dir)
    return spark.range(1).select(B.next_batch_id(ev).alias("next_batch_id"))


@query
def q_sequence_id(spark, sf_dir):
    """Ids of loaded rows 1..n1 by (batch, event); new rows continue at n1+1."""
    ev, loaded = _event_batches(spark, sf_dir)
    existing = dense_index(loaded.select("event_id", "batch_id"), ["batch_id", "event_id"], "id")
    new = B.rows_to_load(ev, loaded).select("event_id", "batch_id")
    appended = B.assign_ids(new, existing, ["batch_id", "event_id"])
    return existing.unionByName(appended)


@query
def q_paginate(spark, sf_dir):
    ent = standin.titles(_tables(spark, sf_dir)).select("anime_id", "members")
    return paginate(ent, [F.desc("members"), F.asc("anime_id")])


@query
def q_page_files(spark, sf_dir):
    """All pages written as batch_N/page_P.json, even batches first; found and loaded by
    the file ledger in two runs, so that the second finds new folders only; raw rows
    numbered in load order, unpacked to records."""
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/page-files-{uuid.uuid4().hex}"
    pages = _pages(_tables(spark, sf_dir)).withColumn("batch_id", F.col("page") % PAGE_FILE_BATCHES + 1)
    pages = stored(pages, "pages")
    for odd in (0, 1):
        write_named_pages(pages.where(F.col("batch_id") % 2 == odd), f"{root}/import")
        load_new_files(spark, f"{root}/import", f"{root}/raw")
    return unpack_pages(B.read_bronze(spark, f"{root}/raw")).select("raw_id", "batch_id", "page", "rec_pos", "anime_id", "members")


@query
def q_take_while_pages(spark, sf_dir):
    pages = _pages(_tables(spark, sf_dir)).checkpoint()  # probed in several steps
    return take_while_pages(pages, TAKE_WHILE_MIN_MEMBERS).select("page", "n_records", "last_members")


@query
def q_page_probe(spark, sf_dir):
    return page_last_members(_pages(_tables(spark, sf_dir)))


@query
def q_name_numbers(spark, sf_dir):
    """Batch and page numbers of paths whose parent folders mislead."""
    ev = _tables(spark, sf_dir).events
    batch, page = F.dayofmonth("ts").cast("string"), F.col("event_id").cast("string")
    parents = F.when(F.col("event_id") % 3 == 0, F.lit("/data/batch_2024/import")).when(
        F.col("event_id") % 3 == 1, F.lit("/x/mybatch_7/in")).otherwise(F.lit("/x/page_9/batch_5/old"))
    path = F.concat(parents, F.lit("/batch_"), batch, F.lit("/page_"), page, F.lit(".json"))
    return ev.select("event_id", path.alias("path")).select(
        "event_id", number_in_name("path", "batch").alias("batch_id"), number_in_name("path", "page").alias("page"))


@query
def q_batch_scan(spark, sf_dir):
    """The raw rows of one chosen batch (the 9th)."""
    ev, _ = _event_batches(spark, sf_dir)
    raw = ev.select(F.col("event_id").alias("id"), "batch_id", F.col("user_id").cast("int").alias("page"),
                    F.col("props").alias("raw_json"))
    return B.scan_batch(raw, 9)


# ------------------------------------------------------------------ checks
@query
def q_dq_not_null(spark, sf_dir):
    o = _tables(spark, sf_dir).orders.select(
        "o_orderkey", F.nullif("o_orderpriority", F.lit("5-LOW")).alias("o_orderpriority"))
    return Q.not_null_failures(o, "o_orderpriority").select("o_orderkey")


@query
def q_dq_source_tests(spark, sf_dir):
    """The declared silver tests on the title model, with some link ids blanked
    (genre 1 -> NULL) so the not_null test of that column reports failures."""
    silver = standin.silver(_tables(spark, sf_dir))
    silver["links_anime_genres"] = silver["links_anime_genres"].withColumn(
        "genre_id", F.nullif("genre_id", F.lit(1)))
    return Q.declared_tests(silver, S.SOURCE_TESTS)


@query
def q_dq_unique(spark, sf_dir):
    return Q.unique_failures(_tables(spark, sf_dir).orders, "o_custkey")


@query
def q_dq_composite(spark, sf_dir):
    return Q.unique_failures(_tables(spark, sf_dir).lineitem, ["l_orderkey", "l_linenumber"])
