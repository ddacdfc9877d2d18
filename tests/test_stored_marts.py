"""Marts from stored partial sums: equal to the marts from gold, refreshed by bucket."""

import pytest
from pyspark.sql import functions as F

from stratum import schemas as S
from stratum.plans import marts as M
from stratum.plans.gold import build_gold
from stratum.plans.stored_marts import KINDS, StoredMarts
from stratum.sources.bucket_store import BucketStore

ANIME = S.silver_schema("anime")


def titles(spark, rows):
    full = []
    for r in rows:
        d = dict.fromkeys(ANIME.fieldNames()) | dict(raw_id=1, batch_id=1, page=1, title="t", source="Manga", type="TV", status="x",
                                                     duration="24 min", score=5.0, popularity=1, members=1, year=2015)
        full.append(tuple((d | r)[c] for c in ANIME.fieldNames()))
    return spark.createDataFrame(full, ANIME)


def links(spark, kind, rows):
    return spark.createDataFrame([(*r, None) for r in rows], S.silver_schema(f"links_anime_{kind}"))


def stores(spark, root, buckets=16, kinds=KINDS):
    tables = {n: (S.silver_schema(n), "anime_id") for n in ["anime", *[f"links_anime_{k}" for k in kinds]]}
    silver = BucketStore(spark, f"{root}/curated", tables, buckets)
    return silver, StoredMarts(silver, f"{root}/marts")


def rows_of(df):
    return sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.collect()), key=repr)


def assert_as_from_gold(silver, stored, years=None):
    gold = build_gold({n: silver.read(n) for n in silver.tables})
    t = M.titles(gold)
    t = t if years is None else M.year_filter(t, years)
    pairs = [(stored.kpis(years), M.kpis(t)), (stored.source_analysis(years), M.source_analysis(t)),
             (stored.source_summary(years), M.source_summary(t)), (stored.source_share(years), M.source_share(t)),
             (stored.year_trend(years), M.year_trend(t)), (stored.genre_summary(years), M.genre_summary(gold, t)),
             (stored.genre_by_year(years), M.genre_by_year(gold, t)),
             (stored.dim_metrics("licensors", years, 1), M.licensor_metrics(gold, t, 1)),
             *[(stored.dim_metrics(k, years, 1), M.dim_metrics(gold, k, t, 1)) for k in ("studios", "producers")]]
    for got, want in pairs:
        assert got.columns == want.columns and rows_of(got) == rows_of(want)


def load(spark, silver, n=60):
    anime = [dict(anime_id=i, members=None if i % 11 == 0 else 10 * i, score=None if i % 7 == 0 else float(i % 9), popularity=i,
                  source=[None, "Manga", "Game"][i % 3], year=None if i % 13 == 0 else 2010 + i % 4) for i in range(n)]
    silver.upsert("anime", titles(spark, anime), ["anime_id"])
    for j, kind in enumerate(KINDS):
        found = [(i, k, None if k == 4 else f"{kind}{k}") for i in range(n) for k in range(6) if (i * (j + 3) + k) % (k + 2) == 0 and i % 10]
        silver.upsert(f"links_anime_{kind}", links(spark, kind, found), S.link_key(S.LINK_NAMES[kind]))


def test_marts_equal_those_from_gold(spark, tmp_root):
    silver, stored = stores(spark, tmp_root)
    load(spark, silver)
    assert stored.refresh() == list(range(16))
    assert stored.refresh() == []
    assert_as_from_gold(silver, stored)
    assert_as_from_gold(silver, stored, (2011, 2012))
    assert stored.genre_top(2).count() == 2
    # few rows, whatever the number of titles
    assert stored.partials("total").count() <= 16 * 5


def test_a_small_upsert_refreshes_its_buckets_only(spark, tmp_root, monkeypatch):
    silver, stored = stores(spark, tmp_root)
    load(spark, silver)
    stored.refresh()
    batch = titles(spark, [dict(anime_id=7, members=5, source="New", year=2013), dict(anime_id=1000, members=9)])
    touched = {r[0] for r in batch.select(silver.bucket_of("anime", 16)).collect()}
    silver.upsert("anime", batch, ["anime_id"])
    more = links(spark, "genres", [(7, 99, "fresh")])
    touched |= {r[0] for r in more.select(silver.bucket_of("links_anime_genres", 16)).collect()}
    silver.upsert("links_anime_genres", more, ["anime_id", "genre_id"])
    read, plain = [], silver.read
    monkeypatch.setattr(silver, "read", lambda name, version=None, buckets=None: read.append(buckets) or plain(name, version, buckets))
    assert set(stored.refresh()) == touched and len(touched) <= 2
    assert read and all(set(b) == touched for b in read)  # no other bucket was read
    monkeypatch.undo()
    assert_as_from_gold(silver, stored)
    fresh = StoredMarts(silver, f"{tmp_root}/again")  # a full rebuild gives the same
    assert fresh.refresh() == list(range(16))
    for mart in ("total", "source", *KINDS):
        key = ["mart", "batch_id", "year", "key"]
        assert rows_of(stored.partials(mart).groupBy(key).agg(F.sum("n"), F.sum("members"), F.sum("score"))) == \
            rows_of(fresh.partials(mart).groupBy(key).agg(F.sum("n"), F.sum("members"), F.sum("score")))


def test_a_new_batch_and_a_renamed_id(spark, tmp_root):
    silver, stored = stores(spark, tmp_root)
    load(spark, silver)
    stored.refresh()
    silver.upsert("anime", titles(spark, [dict(anime_id=i, batch_id=2, members=i) for i in (1, 2, 3)]), ["anime_id"])
    assert len(stored.refresh()) <= 3
    assert_as_from_gold(silver, stored)  # the fact is the three titles of the new batch
    # a second name of a genre changes the weight of every title that has it
    silver.upsert("links_anime_genres", links(spark, "genres", [(1, 0, "renamed")]), ["anime_id", "genre_id"])
    assert stored.refresh() == list(range(16))
    assert_as_from_gold(silver, stored)
    # a second name of a kind that weighs nothing does not
    silver.upsert("links_anime_studios", links(spark, "studios", [(1, 0, "renamed")]), ["anime_id", "studio_id"])
    assert len(stored.refresh()) == 1
    assert_as_from_gold(silver, stored)


def test_empty_and_missing_tables(spark, tmp_root):
    silver, stored = stores(spark, tmp_root, 4)
    assert stored.refresh() == []
    assert stored.kpis().collect() == [(None, 0)] and stored.genre_summary().count() == 0
    silver.upsert("anime", titles(spark, [dict(anime_id=1, members=3), dict(anime_id=2, members=4)]), ["anime_id"])
    assert 1 <= len(stored.refresh()) <= 2  # no link table has been written yet
    assert stored.kpis().collect() == [(5.0, 7)] and stored.dim_metrics("studios", min_support=1).count() == 0
    one, only = stores(spark, f"{tmp_root}/one", 4, kinds=("genres",))
    one.upsert("anime", titles(spark, [dict(anime_id=1)]), ["anime_id"])
    one.upsert("links_anime_genres", links(spark, "genres", [(1, 1, "a"), (1, 2, "b")]), ["anime_id", "genre_id"])
    only.refresh()
    assert rows_of(only.genre_summary()) == [("a", 2, 2, 5.0), ("b", 2, 2, 5.0)]


def test_another_refresh_was_first(spark, tmp_root, monkeypatch):
    silver, stored = stores(spark, tmp_root, 4)
    load(spark, silver, 12)
    other = StoredMarts(silver, f"{tmp_root}/marts")
    plain = stored._compute

    def slow(*args):
        other.refresh()
        return plain(*args)

    monkeypatch.setattr(stored, "_compute", slow)
    assert stored.refresh() == []  # nothing was left to do
    assert_as_from_gold(silver, stored)


def test_tables_of_different_buckets_are_refused(spark, tmp_root):
    silver, stored = stores(spark, tmp_root, 4)
    silver.upsert("anime", titles(spark, [dict(anime_id=1)]), ["anime_id"])
    other, _ = stores(spark, tmp_root, 8)
    other.upsert("links_anime_genres", links(spark, "genres", [(1, 1, "a")]), ["anime_id", "genre_id"])
    with pytest.raises(ValueError, match="number of buckets"):
        stored.refresh()


def test_marts_of_a_warehouse(spark, tmp_root):
    from conftest import rec, write_batch
    from stratum.plans import pipeline as P
    pages, wh = f"{tmp_root}/in", f"{tmp_root}/wh"
    write_batch(pages, 1, {1: [rec(n, members=n, genres=[(1, "a"), (n, "b")]) for n in range(2, 9)]})
    P.run(spark, pages, wh, buckets=4)
    stored = P.refresh_marts(spark, wh)
    gold = P.read_datamart(spark, wh)
    assert rows_of(stored.kpis()) == rows_of(M.kpis(M.titles(gold)))
    assert rows_of(stored.genre_summary()) == rows_of(M.genre_summary(gold, M.titles(gold)))
