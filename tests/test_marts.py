"""Mart semantics (FIXTURES.md §5) on hand-made gold tables, and the weighted
aggregates against the literal fan-out frame."""

import pytest
from pyspark.sql import functions as F

from stratum import schemas as S
from stratum.plans import marts as M
from stratum.plans.gold import build_gold

ENTITY_DDL = ("raw_id long, batch_id int, page int, anime_id int, title string, title_english string, "
              "type string, source string, no_of_episodes int, status string, duration string, "
              "score float, scored_by int, rank int, popularity int, members int, favorites int, year int")


def entity(spark, rows):
    full = []
    for r in rows:
        d = dict(raw_id=1, batch_id=1, page=1, title="t", title_english="t", type="TV", source="Manga",
                 no_of_episodes=1, status="Airing", duration="24 min", score=5.0, scored_by=1, rank=1,
                 popularity=1, members=1, favorites=1, year=2015)
        d.update(r)
        full.append(tuple(d[c] for c in S.ENTITY_COLUMNS))
    return spark.createDataFrame(full, ENTITY_DDL)


def links(spark, prefix, rows):
    i, n = S.link_cols(prefix)
    return spark.createDataFrame(rows, f"anime_id int, {i} int, {n} string")


def gold_of(spark, ent, **link_rows):
    silver = {"anime": entity(spark, ent)}
    for kind, prefix in S.LINK_KINDS:
        silver[f"links_anime_{kind}"] = links(spark, prefix, link_rows.get(kind, []))
    return build_gold(silver)


def test_fanout_asis_vs_dedup(spark):
    g = gold_of(spark, [dict(anime_id=1, members=10)],
                licensors=[(1, 1, "L1"), (1, 2, "L2")],
                genres=[(1, 1, "G1"), (1, 2, "G2"), (1, 3, "G3")])
    assert M.enriched(g).count() == 6
    asis = M.kpis(M.titles(g)).first()
    dedup = M.kpis(M.titles(g, fanout=False)).first()
    assert asis.total_members == 60 and dedup.total_members == 10
    assert asis.avg_score == pytest.approx(5.0)


def test_kpi_labels(spark):
    g = gold_of(spark, [dict(anime_id=1, members=1234567, score=7.456)])
    r = M.kpi_labels(M.kpis(M.titles(g))).first()
    assert (r.avg_score_label, r.total_members_label) == ("7.46", "1,234,567")


def test_null_group_key_and_empty_sums(spark):
    g = gold_of(spark, [dict(anime_id=1, source="a"), dict(anime_id=2, source="a"),
                        dict(anime_id=3, source=None), dict(anime_id=4, source="c", score=None,
                                                           members=None)])
    by = {r.source: r for r in M.source_analysis(M.titles(g)).collect()}
    assert set(by) == {"a", "c"} and by["a"].anime_count == 2
    assert by["c"].score is None
    tr = {r.year: r for r in M.year_trend(M.titles(g).where("anime_id = 4")).collect()}
    assert tr[2015].members == 0 and tr[2015].score is None and tr[2015].anime_count == 1


def test_year_filter_drops_null_years(spark):
    g = gold_of(spark, [dict(anime_id=1, year=2012), dict(anime_id=2, year=None), dict(anime_id=3, year=2030)])
    assert [r.anime_id for r in M.year_filter(M.titles(g), (2010, 2024)).collect()] == [1]
    b = M.year_bounds(g).first()
    assert (b.min_year, b.max_year) == (2012, 2030)


def test_genre_share_uses_kept_genres_only(spark):
    # year total over the top-1 genre only: its share is 100
    g = gold_of(spark, [dict(anime_id=1, members=30), dict(anime_id=2, members=10)],
                genres=[(1, 1, "A"), (2, 2, "B")])
    out = M.genre_share_by_year(g, M.titles(g), k=1).collect()
    assert [(r.genre_name, r.share_pct) for r in out] == [("A", 100.0)]
    out2 = {r.genre_name: r.share_pct for r in M.genre_share_by_year(g, M.titles(g), k=2).collect()}
    assert out2 == {"A": 75.0, "B": 25.0}


def test_min_support_and_industry_average(spark):
    ent = [dict(anime_id=i, score=float(i)) for i in range(1, 8)]
    studios = [(i, 1, "Big") for i in range(1, 6)] + [(6, 2, "Small"), (7, 2, "Small")]
    g = gold_of(spark, ent, studios=studios)
    stats = M.dim_metrics(g, "studios", M.titles(g, fanout=False))
    rows = stats.collect()
    assert [r.studio_name for r in rows] == ["Big"] and rows[0].anime_count == 5
    assert M.industry_average(stats).first()[0] == pytest.approx(3.0)


def test_weighted_aggregates_equal_literal_fanout(spark):
    ent = [dict(anime_id=i, members=i * 100, score=float(i % 4) if i % 5 else None,
                source=["a", "b", None][i % 3], year=2010 + i % 3) for i in range(1, 40)]
    lic = [(i, j, f"L{j}") for i in range(1, 40) for j in range(i % 3)]
    gen = [(i, j, f"G{j}") for i in range(1, 40) for j in range(i % 4)]
    stu = [(i, i % 2, f"S{i % 2}") for i in range(1, 40)]
    g = gold_of(spark, ent, licensors=lic, genres=gen, studios=stu)
    enr = M.enriched(g)
    t = M.titles(g)

    def close(a, b):
        ra = sorted(map(tuple, a.collect()), key=repr)
        rb = sorted(map(tuple, b.collect()), key=repr)
        assert len(ra) == len(rb)
        for x, y in zip(ra, rb):
            assert [v for v in x if isinstance(v, str)] == [v for v in y if isinstance(v, str)]
            assert [v for v in x if not isinstance(v, str)] == pytest.approx(
                [v for v in y if not isinstance(v, str)], nan_ok=True)

    kp = enr.agg(F.avg("score").alias("avg_score"), F.sum("members").alias("total_members"))
    close(M.kpis(t), kp)
    ys = (enr.where("year is not null").groupBy("year")
          .agg(F.count("anime_id").alias("anime_count"), F.sum("members").alias("members"),
               F.avg("score").alias("score")))
    close(M.year_trend(t), ys)
    lic_lit = (enr.where("licensor_name is not null").groupBy("licensor_name")
               .agg(F.count("anime_id").alias("anime_count"), F.avg("score").alias("score"),
                    F.avg("members").alias("members")).where("anime_count >= 5"))
    close(M.licensor_metrics(g, t), lic_lit)
    gl = g["links_genres"].join(g["d_genres"], "genre_id").join(
        enr.select("anime_id", "members", "score"), "anime_id")
    gs = gl.groupBy("genre_name").agg(F.count("anime_id").alias("anime_count"),
                                      F.sum("members").alias("members"), F.avg("score").alias("score"))
    close(M.genre_summary(g, t), gs)
