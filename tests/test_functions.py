"""Column functions: names, last element, formats, page JSON round trip."""

from pyspark.sql import functions as F

from stratum.functions.json_pages import pack_pages, unpack_pages
from stratum.functions.misc import fmt_2dp, fmt_thousands, last_element, number_in_name


def test_number_in_name(spark):
    df = spark.createDataFrame([("/x/batch_12/page_3.json",), ("batch_7",), ("nothing",)], "p string")
    got = df.select(number_in_name("p", "batch").alias("b"), number_in_name("p", "page").alias("pg")).collect()
    assert [(r.b, r.pg) for r in got] == [(12, 3), (7, None), (None, None)]


def test_last_element(spark):
    df = spark.createDataFrame([([1, 2, 3],), ([],), (None,)], "a array<int>")
    assert [r.x for r in df.select(last_element("a").alias("x")).collect()] == [3, None, None]


def test_formats(spark):
    df = spark.createDataFrame([(7.456, 1234567)], "s double, m long")
    r = df.select(fmt_2dp("s").alias("a"), fmt_thousands("m").alias("b")).first()
    assert (r.a, r.b) == ("7.46", "1,234,567")


def test_pack_unpack_round_trip(spark):
    recs = spark.createDataFrame(
        [(1, 0, 10, "a"), (1, 1, 11, "b"), (2, 0, 12, "c")], "page int, rec_pos int, mal_id int, title string")
    pages = pack_pages(recs, fields=["mal_id", "title"])
    bronze = pages.select(F.col("page").cast("long").alias("id"), F.lit(1).alias("batch_id"), "page", "raw_json")
    out = unpack_pages(bronze).select("page", "rec_pos", "anime_id", "title").collect()
    assert sorted(map(tuple, out)) == [(1, 0, 10, "a"), (1, 1, 11, "b"), (2, 0, 12, "c")]


def test_numbers_come_from_the_last_folder_and_the_stem(spark):
    from stratum.functions.misc import number_in_name
    paths = {"/data/batch_2024/import/batch_3/page_1.json": (3, 1), "/x/mybatch_7/in/batch_2/page_5.json": (2, 5),
             "/x/page_9/batch_2/page_4.json": (2, 4), "batch_12": (12, None), "page_3.json": (None, 3),
             "file:/r/batch_id=4/page=7/part-0.txt": (4, 7), "/batch_1/other/page_2.json": (None, 2),
             "/batch_8/notes.txt": (8, None), "": (None, None), "batch_": (None, None)}
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    got = {r.p: (r.b, r.g) for r in df.select("p", number_in_name("p", "batch").alias("b"), number_in_name("p", "page").alias("g")).collect()}
    assert got == paths
