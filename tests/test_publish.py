"""Exports of several tables that readers meet whole."""

import os

import pytest
from pyspark.sql import functions as F

from stratum.sources import publish as X


def _tables(spark, n):
    return {"a": spark.range(n).withColumn("v", F.lit(n)), "b": spark.range(2 * n).withColumn("v", F.lit(n)),
            "none": spark.range(0).selectExpr("id", "'x' AS name")}


def test_a_set_is_read_as_published(spark, tmp_root):
    dst = os.path.join(tmp_root, "export")
    with pytest.raises(FileNotFoundError):
        X.read_set(spark, dst)
    assert X.publish_set(_tables(spark, 3), dst) == 1
    first = X.read_set(spark, dst)
    assert {k: v.count() for k, v in first.items()} == {"a": 3, "b": 6, "none": 0}
    assert first["none"].columns == ["id", "name"]
    assert X.publish_set(_tables(spark, 5), dst) == 2
    assert first["b"].count() == 6  # a reader keeps the set it opened
    assert {k: v.count() for k, v in X.read_set(spark, dst, ["a", "b"]).items()} == {"a": 5, "b": 10}
    assert X.read_set(spark, dst, number=1)["a"].count() == 3
    assert {k: t["rows"] for k, t in X.published_set(spark, dst)["tables"].items()} == {"a": 5, "b": 10, "none": 0}
    with pytest.raises(KeyError, match="zzz"):
        X.read_set(spark, dst, ["zzz"])


def test_a_failed_export_leaves_the_previous_one(spark, tmp_root):
    dst = os.path.join(tmp_root, "export")
    X.publish_set(_tables(spark, 3), dst)
    broken = _tables(spark, 7) | {"c": spark.range(4).withColumn("v", F.raise_error(F.lit("no table")).cast("int"))}
    with pytest.raises(Exception, match="no table"):
        X.publish_set(broken, dst)
    assert {k: v.count() for k, v in X.read_set(spark, dst).items()} == {"a": 3, "b": 6, "none": 0}
    folders = [f for f in os.listdir(dst) if f.startswith("set-")]
    assert len(folders) == 2  # the failed one's files are there, and no reader sees them
    assert X.drop_old_sets(spark, dst) == 0  # it might still be running
    assert X.drop_old_sets(spark, dst, grace_hours=-1) == 1
    assert X.read_set(spark, dst)["b"].count() == 6


def test_two_exports_at_once_and_old_sets(spark, tmp_root):
    from concurrent.futures import ThreadPoolExecutor
    dst = os.path.join(tmp_root, "export")
    with ThreadPoolExecutor(4) as pool:
        numbers = list(pool.map(lambda n: X.publish_set(_tables(spark, n), dst), [1, 2, 3, 4]))
    assert sorted(numbers) == [1, 2, 3, 4]
    for number in numbers:  # each set is of one export
        got = X.read_set(spark, dst, ["a", "b"], number=number)
        assert got["b"].count() == 2 * got["a"].count() == 2 * got["a"].first().v
    assert X.drop_old_sets(spark, dst, keep=2) == 2
    assert len([f for f in os.listdir(dst) if f.startswith("set-")]) == 2
    assert X.read_set(spark, dst)["a"].count() == X.read_set(spark, dst, number=4)["a"].count()
    with pytest.raises(FileNotFoundError):
        X.read_set(spark, dst, number=1)
    with pytest.raises(ValueError):
        X.drop_old_sets(spark, dst, keep=0)
    with pytest.raises(ValueError):
        X.publish_set({}, dst)
