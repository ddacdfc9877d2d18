"""Gold -> the analytic answers behind the dashboard.

Two readings of every "per title" number exist:

* ``fanout=True`` (default, the reference's numbers): the dashboard computes
  everything from the enriched frame, which left-joins the licensor and genre
  links, so a title with L licensor rows and G genre rows counts
  max(L,1)*max(G,1) times.
* ``fanout=False``: one row per title.

The literal enriched frame is ``enriched()`` (row-level views use it).  The
aggregates do not build it: they attach to each title its multiplicity in the
enriched frame (``title_weights``) and aggregate weighted values:
count -> sum(w), sum(x) -> sum(w*x), mean(x) -> sum(w*x)/sum(w where x not null).
That is exactly the same numbers, but the work is linear in fact + links
instead of growing with licensors x genres per title.

Null group keys are dropped and sums of nothing are 0 (pandas groupby rules);
means skip NULLs.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.misc import fmt_2dp, fmt_thousands
from ..operators.joins import left_join
from ..operators.shares import share_of_total, share_within
from ..operators.topk import keep_members, top_k
from ..session import ensure_checkpoint_dir

Gold = Mapping[str, DataFrame]


# ---------------------------------------------------------------- enrichment
def _link_with_dim(gold: Gold, kind: str, how: str = "left") -> DataFrame:
    """links_<kind> joined to d_<kind> on the id: anime_id, X_id, X_name."""
    i, _ = S.link_cols(S.LINK_NAMES[kind])
    return gold[f"links_{kind}"].join(gold[f"d_{kind}"], on=i, how=how)


def fact_dims(gold: Gold, names: list[str] | None = None) -> DataFrame:
    """Fact with the names of the surrogate dimensions (one row per title).

    ``names``: the columns wanted (default all three).  Where gold is built on
    the fly (``gold.LazyFrames``) only their ids are looked up."""
    wanted = [c for _, c in S.SURROGATE_DIMS] if names is None else names
    out = gold.fact_with(wanted) if names is not None and hasattr(gold, "fact_with") else gold["f_anime"]
    for dim_name, column in S.SURROGATE_DIMS:
        if column in wanted:
            out = out.join(gold[dim_name], on=f"{column}_id", how="left")
    return out


def enriched(gold: Gold) -> DataFrame:
    """The enriched frame: fact LEFT source, type, status, licensor links and
    names, genre links and names.

    Same rows as the reference's chain of seven left merges.  Each link table
    is joined to its dimension first (the small side); ``left_join`` keeps a
    title with a huge link list from being met by a single task.
    """
    lic = _link_with_dim(gold, "licensors")
    gen = _link_with_dim(gold, "genres")
    first = left_join(fact_dims(gold), lic, "anime_id", gold["links_licensors"])
    return left_join(first, gen, "anime_id", gold["links_genres"])


def year_filter(df: DataFrame, year_range: tuple[int, int] = S.DEFAULT_YEAR_RANGE) -> DataFrame:
    """Inclusive year window; NULL years drop out."""
    lo, hi = year_range
    return df.where(F.col("year").between(lo, hi))


def title_weights(gold: Gold) -> DataFrame:
    """anime_id, w_lic, w_gen, weight: rows of a title in the enriched frame.

    A left join yields max(matches, 1) rows per left row, so a title with link
    rows r (after the join with the dimension) counts max(r, 1) times per link
    kind.  Both counts come from one aggregate over the tagged union of the two
    link streams (combined map-side, one shuffle).  Titles without any link get
    no row here (weight 1 by default).
    """
    lic = _link_with_dim(gold, "licensors").select("anime_id", F.lit(1).alias("__l"), F.lit(0).alias("__g"))
    gen = _link_with_dim(gold, "genres").select("anime_id", F.lit(0).alias("__l"), F.lit(1).alias("__g"))
    counts = lic.unionByName(gen).groupBy("anime_id").agg(F.sum("__l").alias("__l"), F.sum("__g").alias("__g"))
    return counts.select(
        "anime_id",
        F.greatest("__l", F.lit(1)).cast("long").alias("w_lic"),
        F.greatest("__g", F.lit(1)).cast("long").alias("w_gen"),
    ).withColumn("weight", F.col("w_lic") * F.col("w_gen"))


def titles(gold: Gold, fanout: bool = True, names: list[str] | None = None) -> DataFrame:
    """One row per title with its weights and the dimension names in ``names``
    (default: all three)."""
    base = fact_dims(gold, names)
    if not fanout:
        return base.select("*", F.lit(1).cast("long").alias("w_lic"),
                           F.lit(1).cast("long").alias("w_gen"), F.lit(1).cast("long").alias("weight"))
    w = title_weights(gold)
    return (base.join(w, on="anime_id", how="left")
            .select(*base.columns,
                    *[F.coalesce(c, F.lit(1)).cast("long").alias(c) for c in ("w_lic", "w_gen", "weight")]))


# ------------------------------------------------------- weighted aggregates
def w_count(w: str = "weight") -> Column:
    return F.coalesce(F.sum(w), F.lit(0)).cast("long")


def w_sum(x: str, w: str = "weight") -> Column:
    return F.coalesce(F.sum(F.col(x) * F.col(w)), F.lit(0))


def w_mean(x: str, w: str = "weight") -> Column:
    num = F.sum(F.col(x).cast("double") * F.col(w))
    den = F.sum(F.when(F.col(x).isNotNull(), F.col(w)))
    return (num / den.cast("double"))


def _group(df: DataFrame, key: str | list[str]) -> DataFrame:
    keys = [key] if isinstance(key, str) else key
    for k in keys:
        df = df.where(F.col(k).isNotNull())
    return df


# ------------------------------------------------------------------ the marts
def kpis(t: DataFrame) -> DataFrame:
    """Mean score and total members of the (year-filtered) titles."""
    return t.agg(w_mean("score").alias("avg_score"), w_sum("members").alias("total_members"))


def kpi_labels(k: DataFrame) -> DataFrame:
    """The two KPI numbers as display text: mean score with two decimals,
    total members with thousands separators."""
    return k.select(fmt_2dp("avg_score").alias("avg_score_label"),
                    fmt_thousands("total_members").alias("total_members_label"))


def bubble_rows(enr: DataFrame) -> DataFrame:
    """Rows of the score-vs-members chart (one per enriched row)."""
    return enr.select("anime_id", "title_english", "score", "members", "favorites", "genre_name")


def genre_summary(gold: Gold, t: DataFrame) -> DataFrame:
    """By genre over all years: title count, total members, mean score."""
    gen = _link_with_dim(gold, "genres", "inner")
    j = gen.join(t.select("anime_id", "members", "score", "weight"), on="anime_id")
    return _group(j, "genre_name").groupBy("genre_name").agg(
        w_count().alias("anime_count"), w_sum("members").alias("members"),
        w_mean("score").alias("score"))


def genre_top(gold: Gold, t: DataFrame, k: int = 15) -> DataFrame:
    """Top-k genres by total members (ties: genre name ascending)."""
    return top_k(genre_summary(gold, t), [F.desc_nulls_last("members"), F.asc("genre_name")], k)


def source_analysis(t: DataFrame) -> DataFrame:
    """By source: mean score, mean popularity, title count."""
    return _group(t, "source").groupBy("source").agg(
        w_mean("score").alias("score"), w_mean("popularity").alias("popularity"),
        w_count().alias("anime_count"))


def source_share(t: DataFrame) -> DataFrame:
    """By source: title count and its percent of all (pie slices)."""
    counts = _group(t, "source").groupBy("source").agg(w_count().alias("anime_count"))
    return share_of_total(counts, "anime_count")


def source_summary(t: DataFrame) -> DataFrame:
    """By source: title count, mean members, mean score; by mean members desc."""
    return (_group(t, "source").groupBy("source").agg(
        w_count().alias("anime_count"), w_mean("members").alias("members"),
        w_mean("score").alias("score"))
        .orderBy(F.desc_nulls_last("members"), F.asc("source")))


def year_trend(t: DataFrame) -> DataFrame:
    """By year: title count, total members, mean score."""
    return _group(t, "year").groupBy("year").agg(
        w_count().alias("anime_count"), w_sum("members").alias("members"),
        w_mean("score").alias("score"))


def genre_by_year(gold: Gold, t: DataFrame) -> DataFrame:
    """(year, genre_name) -> total members."""
    gen = _link_with_dim(gold, "genres", "inner")
    j = gen.join(t.select("anime_id", "year", "members", "weight"), on="anime_id")
    return _group(j, ["year", "genre_name"]).groupBy("year", "genre_name").agg(
        w_sum("members").alias("members"))


def top_genres(by_year: DataFrame, k: int = 10) -> DataFrame:
    """The k genres with the most members over all years (ties: name asc)."""
    totals = by_year.groupBy("genre_name").agg(F.sum("members").alias("total"))
    return top_k(totals, [F.desc("total"), F.asc("genre_name")], k).select("genre_name")


def genre_share_by_year(gold: Gold, t: DataFrame, k: int = 10) -> DataFrame:
    """Each top-k genre's percent of the year's members, the year's total
    taken over the kept top-k genres only (a 100%-stacked area chart)."""
    # kept once: the top-k and the shares both start from it
    ensure_checkpoint_dir(t.sparkSession)
    by_year = genre_by_year(gold, t).checkpoint()
    kept = keep_members(by_year, top_genres(by_year, k), "genre_name")
    # (year, genre) is unique in by_year, so a year keeps at most k rows.
    return share_within(kept, "members", ["year"], "share_pct", rows_per_group_bounded=True).select(
        "year", "genre_name", "members", "share_pct")


def dim_metrics(gold: Gold, kind: str, t: DataFrame, min_support: int = S.MIN_SUPPORT) -> DataFrame:
    """Per member of a many-to-many dimension (studios, producers, ...): title
    count, mean score, mean members; only groups with count >= min_support.

    The name column is ``<singular>_name``, as ``get_dim_metrics`` derives it.
    """
    _, name = S.link_cols(S.LINK_NAMES[kind])
    j = _link_with_dim(gold, kind, "inner").join(
        t.select("anime_id", "score", "members", "weight"), on="anime_id")
    return (_group(j, name).groupBy(name).agg(
        w_count().alias("anime_count"), w_mean("score").alias("score"),
        w_mean("members").alias("members"))
        .where(F.col("anime_count") >= min_support))


def licensor_metrics(gold: Gold, t: DataFrame, min_support: int = S.MIN_SUPPORT) -> DataFrame:
    """The licensor numbers, grouped straight on the enriched rows: a
    (title, licensor) row appears once per genre row of the title."""
    j = _link_with_dim(gold, "licensors", "left").join(
        t.select("anime_id", "score", "members", "w_gen"), on="anime_id")
    return (_group(j, "licensor_name").groupBy("licensor_name").agg(
        w_count("w_gen").alias("anime_count"), w_mean("score", "w_gen").alias("score"),
        w_mean("members", "w_gen").alias("members"))
        .where(F.col("anime_count") >= min_support))


def industry_average(stats: DataFrame) -> DataFrame:
    """Unweighted mean of the per-group mean scores."""
    return stats.agg(F.avg("score").alias("industry_avg_score"))


def year_bounds(gold: Gold) -> DataFrame:
    """Smallest and largest year (the slider's range)."""
    return gold["f_anime"].agg(F.min("year").alias("min_year"), F.max("year").alias("max_year"))


def star_select(gold: Gold, kind: str = "genres") -> DataFrame:
    """Fact LEFT link LEFT dimension with every column named once: the fact's
    columns, the link's ``X_id`` and the dimension's ``X_name``."""
    i, n = S.link_cols(S.LINK_NAMES[kind])
    fact = gold["f_anime"]
    d = gold[f"d_{kind}"]
    out = left_join(fact, gold[f"links_{kind}"], "anime_id").join(d, i, "left")
    return out.select(*fact.columns, i, n)
