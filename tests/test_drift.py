"""Report documents as VARIANT: added, missing and re-typed fields."""

import json

from tidewatch.operators import drift as DR
from tidewatch.plans import catalog as C

SF = "/root/testdata/sf0.001"


def document(*reports):
    return json.dumps({"result": {"objects": {"output": {"geometries": list(reports)}}}})


DOCS = [
    (1, document({"properties": {"pkey": "a", "status": "confirmed", "tags": {"flood_depth": 30}, "text": "x"},
                  "geometry": {"coordinates": [112.7, -7.25]}},
                 {"properties": {"pkey": "b", "tags": {"flood_depth": "45", "new": True}, "severity": 2.5}})),
    (2, document({"properties": {"pkey": 77, "status": None, "tags": {"flood_depth": "deep"}, "text": ["x"]},
                  "geometry": {"coordinates": "none"}})),
    (3, document({"properties": {"pkey": "c", "tags": "none"}}, {"geometry": None}, 5)),
    (4, document()), (5, "{}"), (6, "no json"), (7, ""), (8, None), (9, '{"result":{"objects":{"output":{"geometries":7}}}}')]


def test_fields_by_path(spark):
    rows = DR.reports(spark.createDataFrame(DOCS, "doc_id long, json string"))
    got = sorted(((r.doc_id, r.pkey, r.status, r.flood_depth, r.lon, r.lat) for r in DR.flatten(rows).collect()), key=repr)
    assert got == sorted([(1, "a", "confirmed", 30, 112.7, -7.25), (1, "b", None, 45, None, None), (2, "77", None, None, None, None),
                          (3, "c", None, None, None, None), (3, None, None, None, None, None), (3, None, None, None, None, None)], key=repr)


def test_types_that_fields_hold(spark):
    rows = DR.reports(spark.createDataFrame(DOCS, "doc_id long, json string"))
    got = {(r.field, r.type): r.n for r in DR.field_types(rows).collect()}
    assert got == {("pkey", "STRING"): 3, ("pkey", "BIGINT"): 1, ("status", "STRING"): 1, ("status", "VOID"): 1,
                   ("tags", "OBJECT"): 3, ("tags", "STRING"): 1, ("text", "STRING"): 1, ("text", "ARRAY"): 1, ("severity", "DECIMAL"): 1,
                   ("tags.flood_depth", "BIGINT"): 1, ("tags.flood_depth", "STRING"): 2, ("tags.new", "BOOLEAN"): 1}


def test_empty(spark):
    rows = DR.reports(spark.createDataFrame([], "doc_id long, json string"))
    assert DR.flatten(rows).collect() == [] and DR.field_types(rows).collect() == []


def test_same_rows_as_the_fixed_schema(spark):
    a, b = (C.QUERIES[n](spark, SF) for n in ("report_variant", "report_flatten"))
    assert a.columns == b.columns
    assert a.exceptAll(b).count() == b.exceptAll(a).count() == 0 and a.count() > 0
