"""J1 and V4 over bodies with arrays of anything, against a parser written out."""

import json

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import jsontree
from ledgerline.operators.jsonio import Field

ITEM = Field("", "object", required=True, fields=(
    Field("part", "long", required=True), Field("qty", "int", required=True), Field("price", "decimal", precision=(20, 2)),
    Field("flag", "enum", values=("A", "N", "R")), Field("grid", "array", items=Field("", "array", items=Field("", "int")))))
SCHEMA = (Field("id", "long", required=True), Field("sizes", "array", items=Field("", "int", required=True)),
          Field("flags", "array", items=Field("", "enum", values=("A", "N", "R"))), Field("items", "array", items=ITEM),
          Field("meta", "object", fields=(Field("a", "int"), Field("b", "int", required=True))))

CASES = [
    ('{"id": 1}', None, {"id": 1, "sizes": None, "flags": None, "items": None, "meta": None}),
    ('{"id": 1, "sizes": [1, "2", 3.9], "flags": ["A", 2, null], "items": []}', None,
     {"id": 1, "sizes": [1, 2, 3], "flags": ["A", "R", None], "items": [], "meta": None}),
    ('{"id": 1, "sizes": 7, "items": {"part": 5, "qty": 1}}', None,
     {"id": 1, "sizes": [7], "flags": None, "items": [{"part": 5, "qty": 1, "price": None, "flag": None, "grid": None}], "meta": None}),
    ('{"id": 1, "items": [{"part": 5, "qty": 1, "price": "1.50", "grid": [[1, null], 2, []]}]}', None,
     {"id": 1, "sizes": None, "flags": None, "meta": None,
      "items": [{"part": 5, "qty": 1, "price": "1.50", "flag": None, "grid": [[1, None], [2], []]}]}),
    ('{"id": 1, "sizes": [1, null]}', ("missing_field", "sizes.?"), None),
    ('{"id": 1, "sizes": [1, "x"]}', ("wrong_type", "sizes.?"), None),
    ('{"id": 1, "sizes": [1, 99999999999]}', ("mapping_error", "sizes.?"), None),
    ('{"id": 1, "sizes": [1, "99999999999"]}', ("wrong_type", "sizes.?"), None),
    ('{"id": 1, "flags": ["A", "Z"]}', ("wrong_type", "flags.?"), None),
    ('{"id": 1, "items": [{"part": 5, "qty": 1}, {"qty": 1}]}', ("missing_field", "items.?.part"), None),
    ('{"id": 1, "items": [{"part": 5, "qty": 1}, null]}', ("missing_field", "items.?"), None),
    ('{"id": 1, "items": [{"part": 5, "qty": 1, "grid": [[1], ["x"]]}]}', ("wrong_type", "items.?.grid.?.?"), None),
    ('{"id": 1, "items": [{"part": 5, "qty": 1, "grid": [[{}]]}]}', ("missing_field", "items.?.grid.?.?"), None),
    ('{"items": [{"qty": "x", "part": "y"}]}', ("wrong_type", "items.?.qty"), None),
    ('{"items": [{"part": "y", "qty": "x"}]}', ("wrong_type", "items.?.part"), None),
    ('{"sizes": ["x"], "id": "y"}', ("wrong_type", "sizes.?"), None),
    ('{"id": "y", "sizes": ["x"]}', ("wrong_type", "id"), None),
    ('{"meta": {"b": 1e30, "a": "z"}, "id": "y"}', ("mapping_error", "meta.b"), None),
    ('{"meta": {"a": "z", "b": 1e30}, "id": "y"}', ("wrong_type", "meta.a"), None),
    ('{"meta": {"a": 1}, "id": "y"}', ("missing_field", "meta.b"), None),
    ('{"sizes": 1}', ("missing_field", "id"), None),
    ('{"id": 1, "meta": []}', ("missing_field", "meta"), None),
    ('{"id": 1, "meta": ""}', None, {"id": 1, "sizes": None, "flags": None, "items": None, "meta": None}),
    ('[1]', ("missing_field", ""), None), ("7", ("missing_field", ""), None), ("{", ("unreadable", ""), None), (None, ("unreadable", ""), None),
]


def plain(x):
    return json.loads(json.dumps(x, default=str))


def test_bodies_of_any_shape(spark):
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(CASES)], "i int, payload string")
    rows = {r["i"]: r for r in jsontree.decode(df, "payload", SCHEMA).collect()}
    for i, (payload, reject, body) in enumerate(CASES):
        r = rows[i]
        got = (r["reject"]["kind"], r["reject"]["path"]) if r["reject"] else None
        assert (got, plain(r["body"].asDict(True)) if r["body"] else None) == (reject, body), payload
        assert r["accepted"] == (reject is None)
    flat = jsontree.rejects(jsontree.decode(df, "payload", SCHEMA))
    assert flat.count() == sum(c[1] is not None for c in CASES) and set(flat.columns) >= {"reject_kind", "reject_path", "message", "error_type"}


def test_repeated_keys(spark):
    df = spark.createDataFrame([('{"id": 1, "id": 2}',), ('{"id": 1, "meta": {"b": 1, "a": 2, "a": 3}}',)], "payload string")
    last = [r["body"]["id"] for r in jsontree.decode(df, "payload", SCHEMA).collect()]
    assert last == [2, 1]
    found = [(r["reject"]["kind"], r["reject"]["path"]) for r in jsontree.decode(df, "payload", SCHEMA, duplicate_keys="reject").collect()]
    assert found == [("mapping_error", ""), ("mapping_error", "meta")]


def test_schema_is_checked(spark):
    df = spark.createDataFrame([], "payload string")
    for bad in (Field("a.b", "int"), Field("a", "array")):
        with pytest.raises(ValueError):
            jsontree.decode(df, "payload", (bad,))
    assert jsontree.decode(df, "payload", SCHEMA).select(F.col("body.items")).count() == 0
