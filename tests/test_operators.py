"""Operators: dense ids, keep-last, upsert, shares, top-k, checks."""

import pytest
from pyspark.sql import functions as F

from stratum.operators import quality as Q
from stratum.operators.dedup import keep_last
from stratum.operators.sequence import dense_index
from stratum.operators.shares import share_of_total, share_within
from stratum.operators.topk import keep_members, top_k
from stratum.operators.upsert import stage_frame, upsert


def test_dense_index_is_1_to_n_in_order(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5000).alias("v"))
    out = dense_index(df, ["v"], "idx", num_partitions=7).orderBy("v").collect()
    assert [r.idx for r in out] == list(range(1, 5001))
    assert [r.v for r in out] == list(range(5000))


def test_dense_index_desc_and_start(spark):
    df = spark.createDataFrame([(1,), (3,), (2,)], "v int")
    out = dense_index(df, [F.desc("v")], "i", start=10).orderBy("i").collect()
    assert [(r.v, r.i) for r in out] == [(3, 10), (2, 11), (1, 12)]


def test_surrogate_ids_skip_nulls(spark):
    from stratum.plans.gold import surrogate_dim
    df = spark.createDataFrame([("b",), ("a",), (None,), ("a",)], "source string")
    got = {r.source: r.source_id for r in surrogate_dim(df, "source", "source_id").collect()}
    assert got == {"a": 1, "b": 2}


def test_keep_last_by_order_columns(spark):
    df = spark.createDataFrame(
        [(1, "x", 1, 0), (1, "y", 2, 0), (1, "z", 2, 1), (2, "w", 1, 5), (None, "n1", 1, 0), (None, "n2", 2, 0)],
        "k int, v string, raw_id int, pos int")
    got = {r.k: r.v for r in keep_last(df, ["k"], ["raw_id", "pos"]).collect()}
    assert got == {1: "z", 2: "w", None: "n2"}


def test_keep_last_hot_key(spark):
    # a third of all rows on one key: still one row out, the last one
    hot = spark.range(0, 30000).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
                                        F.col("id").alias("ord"))
    out = keep_last(hot, ["k"], ["ord"])
    assert out.count() == hot.select("k").distinct().count()
    assert out.where("k = 0").first().ord == 29997


def test_upsert_semantics_and_idempotence(spark):
    t = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    s = spark.createDataFrame([(2, "z"), (3, "w")], "k int, v string")
    once = upsert(t, s, ["k"])
    assert sorted(once.collect()) == sorted([(1, "x"), (2, "z"), (3, "w")])
    twice = upsert(once, s, ["k"])
    assert sorted(twice.collect()) == sorted(once.collect())


def test_upsert_null_keys_never_match(spark):
    t = spark.createDataFrame([(None, "t")], "k int, v string")
    s = spark.createDataFrame([(None, "s")], "k int, v string")
    assert upsert(t, s, ["k"]).count() == 2


def test_upsert_updates_loaded_at(spark):
    t = spark.createDataFrame([(1, "x")], "k int, v string").withColumn(
        "loaded_at", F.lit("2000-01-01").cast("timestamp"))
    s = spark.createDataFrame([(1, "y")], "k int, v string")
    r = upsert(t, s, ["k"]).first()
    assert r.v == "y" and r.loaded_at.year > 2000


def test_stage_frame_column_check(spark):
    df = spark.createDataFrame([(1, "x")], "k int, v string")
    assert stage_frame(df, ["k", "v", "loaded_at"]).columns == ["k", "v", "loaded_at"]
    with pytest.raises(ValueError, match="lacks"):
        stage_frame(df, ["k", "w", "loaded_at"])


def test_shares(spark):
    df = spark.createDataFrame([(2000, "a", 10), (2000, "b", 30), (2001, "a", 5)], "year int, g string, m long")
    got = {(r.year, r.g): r.share_pct for r in share_within(df, "m", ["year"]).collect()}
    assert got == {(2000, "a"): 25.0, (2000, "b"): 75.0, (2001, "a"): 100.0}
    tot = share_of_total(df, "m").agg(F.sum("share_pct")).first()[0]
    assert tot == pytest.approx(100.0)


def test_top_k_tie_break(spark):
    df = spark.createDataFrame([("a", 5), ("b", 7), ("c", 5), ("d", 5)], "g string, m int")
    top = top_k(df, [F.desc("m"), F.asc("g")], 2)
    assert [r.g for r in top.collect()] == ["b", "a"]
    assert sorted(r.g for r in keep_members(df, top.select("g"), "g").collect()) == ["a", "b"]


def test_quality_checks(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (2, None), (None, 3), (1, 1)], "a int, b int")
    assert Q.not_null_failures(df, "b").count() == 1
    assert {tuple(r) for r in Q.unique_failures(df, "a").collect()} == {(1, 3)}
    assert {tuple(r) for r in Q.unique_failures(df, ["a", "b"]).collect()} == {(1, 1, 2)}
    with pytest.raises(ValueError, match="Constraint violation"):
        Q.assert_key(df, ["a", "b"])
    Q.assert_key(df.where("a = 2"), ["a"])
    assert Q.key_violations(df, ["a"], ["b"]) == {"nulls": {"a": 1, "b": 1}, "duplicate_keys": True}
    assert Q.key_violations(df.where("a = 2 or a is null"), ["a"]) == {"nulls": {"a": 1},
                                                                       "duplicate_keys": False}
    assert Q.column_mismatch(["a", "x"], ["a", "b", "loaded_at"]) == (["b"], ["x"])


def test_surrogate_dims_of_two_columns(spark):
    from stratum.plans import gold
    df = spark.createDataFrame([("b", "x"), ("a", None), ("c", "y"), (None, "x"), ("b", "z")], "a string, b string")
    dims = gold.surrogate_dims(df, [("a", "a_id"), ("b", "b_id")])
    got = {c: sorted(tuple(r) for r in d.collect()) for c, d in dims.items()}
    assert got == {"a": [(1, "a"), (2, "b"), (3, "c")], "b": [(1, "x"), (2, "y"), (3, "z")]}


def test_dense_index_by_key_checkpoints_no_payload(spark):
    df = spark.createDataFrame([(i, (7 * i) % 100, "payload" * 50) for i in range(100)], "k int, o int, p string")
    out = dense_index(df, ["o"], "n", key=["k"])
    assert all(r.n == r.o + 1 and len(r.p) == 350 for r in out.collect())
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    kept = [line for line in plan.splitlines() if "ExistingRDD" in line or "LogicalRDD" in line]
    assert not any("p#" in line for line in kept if "__pos" in line)


def test_shares_of_a_zero_total_are_null(spark):
    from stratum.operators.shares import share_of_total, share_within
    df = spark.createDataFrame([(1, 0), (1, 0), (2, 1), (2, 3)], "g int, v long")
    for bounded in (False, True):
        got = sorted(share_within(df, "v", ["g"], rows_per_group_bounded=bounded).collect(), key=lambda r: (r.g, r.v))
        assert [r.share_pct for r in got] == [None, None, 25.0, 75.0]
    assert share_of_total(df.where("g = 1"), "v").first().share_pct is None


def test_left_join_equals_outer_join_and_splits_a_hot_key(spark):
    from stratum.operators.joins import heavy_hitters, left_join
    left = spark.range(1000).selectExpr("IF(id = 5, NULL, id) AS k", "id * 2 AS x").union(spark.createDataFrame([(7, -1)], "k long, x long"))
    right = spark.range(200000).selectExpr("IF(id % 2 = 0, 7, id % 900) AS k", "id AS y", "id % 3 AS z")
    right = right.union(spark.createDataFrame([(None, 1, 1)], "k long, y long, z long"))
    want = left.join(right, "k", "left")
    totals = {"k": "sum", "x": "sum", "y": "sum", "z": "sum", "*": "count"}
    keep = {c: spark.conf.get(c) for c in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        spark.conf.set("spark.sql.shuffle.partitions", 16)
        assert set(heavy_hitters(right, "k", 20_000)) == {7} and heavy_hitters(right.limit(0), "k") == {}
        for hot_rows in (20_000, 1_000_000):
            got = left_join(left, right, "k", hot_rows=hot_rows)
            assert got.columns == want.columns
            assert tuple(got.agg(totals).first()) == tuple(want.agg(totals).first())
        # a plain left join unless a key is hot; one left join, on the salt too, if one is
        plain = left_join(left, right, "k")._jdf.queryExecution().executedPlan().toString()
        assert "salt" not in plain and plain.count("Join") == 1
        salted = left_join(left, right, "k", hot_rows=20_000)
        plan = salted._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Join") == 1 and "Join [k" in plan and "__salt" in plan and "LeftOuter" in plan
        assert plan.count("Range (0, 200000") == 1 and plan.count("Range (0, 1000") == 1
        # the hot key's 200,000 rows (two left rows) are met by several tasks
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        salted = left_join(left, right, "k", hot_rows=20_000)
        per_task = salted.groupBy(F.spark_partition_id()).count().agg({"count": "max"}).first()[0]
        assert per_task < 120_000
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        for c, v in keep.items():
            spark.conf.set(c, v)


def test_left_join_by_a_cheaper_key_frame(spark):
    from stratum.operators.joins import left_join
    left = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3), (None, 4)], "k string, x int")
    right = spark.createDataFrame([("a", n) for n in range(50)] + [("b", 0)], "k string, y int")
    got = left_join(left, right, "k", keys=right.select("k"), hot_rows=10)
    want = left.join(right, "k", "left")
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def test_surrogate_ids_follow_native_order(spark):
    from stratum.plans.gold import surrogate_dims
    df = spark.createDataFrame([(10, "b"), (9, "a"), (100, "b")], "n int, s string")
    d = surrogate_dims(df, [("n", "n_id"), ("s", "s_id")])
    assert [tuple(r) for r in d["n"].orderBy("n_id").collect()] == [(1, 9), (2, 10), (3, 100)]
    assert [tuple(r) for r in d["s"].orderBy("s_id").collect()] == [(1, "a"), (2, "b")]


def test_declared_tests_make_no_row_per_value(spark):
    """Null counts and repeated values of whole tables; not_null columns are counted in the scan."""
    from stratum.operators.quality import declared_tests
    a = spark.createDataFrame([(1, None), (1, "x"), (2, "y"), (None, None), (None, "")], "id long, name string")
    b = spark.createDataFrame([], "id long, other int")
    tests = [("a", "id", "unique"), ("a", "id", "not_null"), ("a", "name", "not_null"), ("b", "id", "not_null"),
             ("b", "other", "not_null"), ("b", "other", "unique")]
    got = declared_tests({"a": a, "b": b}, tests)
    assert sorted(map(tuple, got.collect())) == [
        ("a", "id", "not_null", 2), ("a", "id", "unique", 2), ("a", "name", "not_null", 2),
        ("b", "id", "not_null", 0), ("b", "other", "not_null", 0), ("b", "other", "unique", 0)]
    plan = declared_tests({"a": a}, [("a", "name", "not_null"), ("a", "id", "not_null")])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate") < plan.index("Aggregate")  # rows are made of the counts, above the aggregate
