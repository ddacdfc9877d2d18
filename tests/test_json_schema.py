"""Schemas found in the documents, against the declared columns."""

import json

import pytest

from stratum.functions import json_schema as J

from conftest import page_doc, rec


def _pages(spark, batches):
    rows = [(b, p, page_doc(records)) for b, pages in batches.items() for p, records in pages.items()]
    return spark.createDataFrame(rows, "batch_id int, page int, raw_json string")


def test_schema_of_each_batch(spark):
    pages = _pages(spark, {1: {1: [rec(1), rec(2)]}, 2: {1: [rec(3, extra_count=4)], 2: [rec(4, extra_count=1.5)]}})
    got = {r.batch_id: r for r in J.discovered_schemas(J.records_of(pages)).collect()}
    assert got[1].n_records == got[2].n_records == 2
    assert "extra_count" not in got[1].ddl and "extra_count: DECIMAL" in got[2].ddl
    assert "genres: ARRAY" in got[1].ddl


def test_fields_nulls_and_types(spark):
    pages = spark.createDataFrame(
        [(1, json.dumps({"data": [{"a": 1, "b": None}, {"a": None, "c": "x"}, 5, None, {}]})),
         (1, "not json"), (1, json.dumps({"data": "text"})), (1, json.dumps([1])), (1, None),
         (None, json.dumps({"data": [{"a": "s"}]})), (2, json.dumps({"data": []}))], "batch_id int, raw_json string")
    got = {(r.batch_id, r.field): (r.n_present, r.n_null, r.type) for r in J.discovered_fields(J.records_of(pages)).collect()}
    assert got == {(1, "a"): (2, 1, "BIGINT"), (1, "b"): (1, 1, None), (1, "c"): (1, 0, "STRING"),
                   (None, "a"): (1, 0, "STRING")}


def test_compare_lists_missing_and_new(spark):
    fields = spark.createDataFrame([(1, "a", 3), (1, "x", 1), (None, "b", 2)], "batch_id int, field string, n_present long")
    got = {(r.batch_id, r.field): (r.status, r.n_present) for r in J.compare_fields(fields, ["a", "b"]).collect()}
    assert got == {(1, "a"): ("ok", 3), (1, "b"): ("missing", 0), (1, "x"): ("new", 1),
                   (None, "a"): ("missing", 0), (None, "b"): ("ok", 2)}


def test_a_column_no_record_has_raises(spark):
    whole = [rec(1), rec(2, studio_notes="n")]
    lacking = [{k: v for k, v in r.items() if k != "duration"} for r in (rec(3), rec(4))]
    assert [(r.batch_id, r.field) for r in J.assert_columns(_pages(spark, {1: {1: whole}})).collect()
            if r.field == "studio_notes"] == [(1, "studio_notes")]
    # one record that has it is enough, even as a null
    J.assert_columns(_pages(spark, {2: {1: lacking, 2: [rec(5, duration=None)]}}))
    with pytest.raises(J.MissingColumns, match="batch_id 3 duration"):
        J.assert_columns(_pages(spark, {1: {1: whole}, 3: {1: lacking}}))
    assert J.assert_columns(_pages(spark, {4: {1: []}})).count() == 0
