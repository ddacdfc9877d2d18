"""Catalog helpers: schema, materialise, list, load, export."""

import os

from stratum.sources import catalog as C


def test_catalog_round_trip(spark, tmp_root):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    C.materialize(df, "t1", schema="datamart")
    C.materialize(df.where("k = 1"), "t2", schema="datamart")
    df.createOrReplaceTempView("not_a_table")
    assert {"t1", "t2"} <= set(C.base_tables(spark, "datamart"))
    assert "not_a_table" not in C.base_tables(spark, "datamart")
    assert C.table_columns(spark, "datamart.t1") == ["k", "v"]
    assert ("t1", "k", "int") in C.all_columns(spark, "datamart")
    loaded = C.load_tables(spark, ["t1", "t2"], schema="datamart")
    assert loaded["t2"].count() == 1
    dst = os.path.join(tmp_root, "export")
    copied = C.export_schema(spark, "datamart", dst)
    assert {"t1", "t2"} <= set(copied)
    assert spark.read.parquet(os.path.join(dst, "t1")).count() == 2
