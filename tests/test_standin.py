"""The title model derived from the provided tables: stored link rows and their de-duplication."""

import os

import pytest

from stratum.plans import standin
from stratum.plans.gold import build_gold

KINDS = ["producers", "licensors", "studios", "genres", "themes"]


@pytest.fixture()
def tables(spark, tmp_root):
    """Line items with repeated and null keys, a part and a supplier under two names."""
    lines = [(o, p, s) for o in (1, 2, 3, None) for p in (1, 2, None) for s in (1, 2, None)] * 2 + [(4, 9, 1)]
    rows = {"lineitem": (lines, "l_orderkey long, l_partkey long, l_suppkey long"),
            "part": ([(1, "Brand#1", "a"), (1, "Brand#1", "b"), (2, "Brand#22", None), (3, None, "c")],
                     "p_partkey long, p_brand string, p_name string"),
            "supplier": ([(1, "s", 1), (1, "s2", 2), (2, "u", 2)], "s_suppkey long, s_name string, s_nationkey int"),
            "nation": ([(1, "N", 1), (2, "M", 1)], "n_nationkey int, n_name string, n_regionkey int"),
            "region": ([(1, "R")], "r_regionkey int, r_name string")}
    for name, (data, schema) in rows.items():
        spark.createDataFrame(data, schema).write.parquet(os.path.join(tmp_root, f"{name}.parquet"))
    return standin.Tables(spark, tmp_root)



@pytest.mark.parametrize("hot_rows", [1_000_000, 2])
def test_links_are_the_distinct_rows(tables, monkeypatch, hot_rows):
    monkeypatch.setattr(standin, "HOT_ROWS", hot_rows)
    made, plain = [], standin.link_rows
    monkeypatch.setattr(standin, "link_rows", lambda t, k, by_title=False: made.append(by_title) or plain(t, k, by_title))
    got = standin.links(tables, KINDS)
    assert made == [hot_rows > 2]
    want = plain(tables, KINDS).distinct().collect()
    for kind, df in got.items():
        assert sorted(map(repr, (tuple(r) for r in df.collect()))) == sorted(
            repr((r.anime_id, r.id, r.name)) for r in want if r.kind == kind)


def test_lines_move_before_they_become_rows(tables):
    """Nothing but the lines of a title is shuffled for the de-duplication."""
    plan = standin.link_rows(tables, KINDS, by_title=True).distinct()._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Generate") < plan.index("Exchange")


def test_a_dimension_reads_its_columns_only(tables):
    """A dimension is read from stored columns, the title ids left alone."""
    gold = build_gold({f"links_anime_{k}": df for k, df in standin.links(tables, ["producers"]).items()})
    plan = gold["d_producers"]._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet" in plan and "ReadSchema: struct<kind:string,id:bigint,name:string>" in plan
    assert sorted(map(repr, (tuple(r) for r in gold["d_producers"].collect()))) == ["(1, 'a')", "(1, 'b')", "(2, None)"]
