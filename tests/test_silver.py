"""Silver stage on page documents (FIXTURES.md §1 cases)."""

import pytest

from pyspark.sql import functions as F

from conftest import page_doc, rec
from stratum.plans.silver import bronze_from_pages, build_silver


def pages_df(spark, batch, pages):
    rows = [(batch, p, page_doc(recs)) for p, recs in pages.items()]
    return spark.createDataFrame(rows, "batch_id int, page int, raw_json string")


def test_unpack_flatten_links_and_keep_last(spark):
    p1 = [rec(1, members=100, genres=[(1, "Action"), (1, "Action")], licensors=[]),
          rec(2, genres=None, studios=[(7, None), (8, "Bones")], year=None, source=None, score=None)]
    p2 = [rec(1, members=999, genres=[(2, "Drama")])]
    p3 = []
    bronze = bronze_from_pages(pages_df(spark, 1, {1: p1, 2: p2, 3: p3}))
    s = build_silver(bronze)
    ent = {r.anime_id: r for r in s["anime"].collect()}
    assert set(ent) == {1, 2}
    assert ent[1].members == 999 and ent[1].page == 2          # last copy wins
    assert ent[2].year is None and ent[2].source is None and ent[2].score is None
    genres = sorted((r.anime_id, r.genre_id, r.genre_name) for r in s["links_anime_genres"].collect())
    assert genres == [(1, 1, "Action"), (1, 2, "Drama")]       # union of both copies, duplicate once
    studios = [(r.anime_id, r.studio_id) for r in s["links_anime_studios"].collect()]
    assert studios == [(2, 8)]                                  # null name dropped
    assert s["links_anime_licensors"].count() == 0
    assert s["anime"].columns[:4] == ["raw_id", "batch_id", "page", "anime_id"]


def test_latest_batch_only(spark):
    rows = (pages_df(spark, 1, {1: [rec(1), rec(2)]})
            .unionByName(pages_df(spark, 2, {1: [rec(3)]})))
    s = build_silver(bronze_from_pages(rows))
    assert [r.anime_id for r in s["anime"].collect()] == [3]
    s1 = build_silver(bronze_from_pages(rows), batch_id=1)
    assert sorted(r.anime_id for r in s1["anime"].collect()) == [1, 2]


def test_malformed_document(spark):
    import pytest
    rows = spark.createDataFrame([(1, 1, "{not json")], "batch_id int, page int, raw_json string")
    assert build_silver(bronze_from_pages(rows), strict=False)["anime"].count() == 0
    with pytest.raises(Exception):
        build_silver(bronze_from_pages(rows))["anime"].collect()


def test_empty_raw_table_gives_empty_silver(spark):
    from stratum.sources.bronze import empty_bronze
    s = build_silver(empty_bronze(spark))
    assert s["anime"].count() == 0
    assert all(s[f"links_anime_{k}"].count() == 0 for k in ("genres", "studios"))


BAD = {"truncated": '{"data": [{"mal_id": 1', "no data": '{"pagination": {}}',
       "text for a number": '{"data": [{"mal_id": 3, "score": "N/A"}]}',
       "overflow": '{"data": [{"mal_id": 4, "members": 3000000000}]}', "not JSON": "x"}


@pytest.mark.parametrize("name", sorted(BAD))
def test_bad_pages_raise_or_are_listed(spark, name):
    from stratum.functions.json_pages import rejected_pages
    good = page_doc([rec(10), rec(11)])
    raw = bronze_from_pages(spark.createDataFrame([(1, 1, good), (1, 2, BAD[name])], "batch_id int, page int, raw_json string"))
    with pytest.raises(Exception, match="page rejected"):
        build_silver(raw)["anime"].collect()
    assert sorted(r.anime_id for r in build_silver(raw, strict=False)["anime"].collect()) == [10, 11]
    assert [(r.page, bool(r.reason)) for r in rejected_pages(raw).collect()] == [(2, True)]


def test_take_while_does_not_take_a_bad_page_for_an_empty_one(spark):
    from stratum.sources.pages import take_while_pages
    good = page_doc([rec(1, members=50000)])
    pages = spark.createDataFrame([(1, good), (2, BAD["truncated"]), (3, good)], "page int, raw_json string")
    with pytest.raises(Exception, match="page rejected"):
        take_while_pages(pages).collect()
