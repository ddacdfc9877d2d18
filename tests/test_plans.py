"""Plan invariants of every registered query: no Python evaluation, no
cartesian product or nested-loop join in the final adaptive plan."""

import os
import sys

import pytest

import __spark_entry__ as E
from stratum.registry import QUERIES

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
from plan_report import count_operators, explain_text  # noqa: E402

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_invariants(spark, name):
    df = E.queries()[name](spark, SF)
    df.collect()
    c = count_operators(explain_text(df))
    assert c["python"] == 0, name
    assert c["cartesian"] == 0, name


@pytest.mark.parametrize("name", ["q_category_share_by_year", "q_source_share"])
def test_marts_read_their_tables_at_most_twice(spark, name):
    keep = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        plan = E.queries()[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", keep)
    relations = [line for line in plan.splitlines() if "Relation" in line]
    assert sum("l_orderkey" in line for line in relations) <= 2
    assert sum("o_orderkey" in line for line in relations) <= 2


@pytest.mark.parametrize("name", ["q_json_page_unpack", "q_page_probe", "q_take_while_pages"])
def test_pages_are_parsed_once(spark, name):
    plan = E.queries()[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lower().count("from_json") + plan.lower().count("jsontostructs") == 1


@pytest.mark.parametrize("name", ["q_enriched_rows", "q_star_select", "q_bubble_rows"])
def test_left_joins_read_their_left_side_once(spark, name):
    plan = E.queries()[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    relations = [line for line in plan.splitlines() if "Relation" in line]
    # the entity, and once more to find its latest batch
    assert sum("o_orderkey" in line for line in relations) <= 2 and "LeftAnti" not in plan
