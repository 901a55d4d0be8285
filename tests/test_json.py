import decimal
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.operators import jsonio
from ledgerline.plans.registry import LEVELS, PAYLOAD_SCHEMA


def decode_one(spark, payload):
    df = spark.createDataFrame([(1, payload)], "id long, payload string")
    return jsonio.decode(df, "payload", PAYLOAD_SCHEMA).first()


@pytest.mark.parametrize("payload,k,tags,level,source", [
    ('{"k": 1, "tags": ["a", "b"], "level": "LOW"}', 1, ["a", "b"], "LOW", None),
    ('{"k": 2, "unknown": {"x": 1}}', 2, None, None, None),
    ('{"k": 3, "meta": ""}', 3, None, None, None),
    ('{"k": 4, "tags": "solo"}', 4, ["solo"], None, None),
    ('{"k": "7"}', 7, None, None, None),
    ('{"k": 1.5, "tags": 7, "level": 2}', 1, ["7"], "HIGH", None),
    ('{"k": 5, "meta": {"source": "web"}, "level": ""}', 5, None, None, "web"),
    ('{"k": 6, "tags": ["a{b", "[x]", "q\\"{"]}', 6, ["a{b", "[x]", 'q"{'], None, None),
])
def test_accepted(spark, payload, k, tags, level, source):
    r = decode_one(spark, payload)
    assert r.accepted and r.reject is None
    assert (r.k, r.tags, r.level, r.meta_source) == (k, tags, level, source)


@pytest.mark.parametrize("payload,kind,path", [
    ('{"k": 1, "tags": {"a": 1}}', "missing_field", "tags"),
    ('{"k": 1, "tags": [{"a": 1}]}', "missing_field", "tags.?"),
    ('{"k": null}', "missing_field", "k"),
    ('{"level": "LOW"}', "missing_field", "k"),
    ('{"k": true}', "missing_field", "k"),
    ('{"k": "abc"}', "wrong_type", "k"),
    ('{"k": 1, "level": "ULTRA"}', "wrong_type", "level"),
    ('{"k": 1, "meta": "text"}', "missing_field", "meta"),
    ('{"k": 1, "meta": {"source": [1]}}', "missing_field", "meta.source"),
    ('{"k": ', "unreadable", ""),
    ('[1, 2]', "missing_field", ""),
])
def test_rejected(spark, payload, kind, path):
    r = decode_one(spark, payload)
    assert not r.accepted and r.k is None
    assert (r.reject.kind, r.reject.path) == (kind, path)


def test_enum_reject_lists_allowed_values(spark):
    r = decode_one(spark, '{"k": 1, "level": "ULTRA"}')
    assert "ULTRA" in r.reject.message and "[" + ", ".join(LEVELS) + "]" in r.reject.message


def test_wrong_type_before_missing(spark):
    # the missing required k is reported after the in-order type error
    r = decode_one(spark, '{"level": "ULTRA"}')
    assert r.reject.path == "level"


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_encode_plain_decimals_and_omitted_nulls(spark, ansi):
    old = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        _check_encode(spark)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)


def _check_encode(spark):
    schema = T.StructType([
        T.StructField("id", T.LongType()), T.StructField("amount", T.DecimalType(20, 12)),
        T.StructField("note", T.StringType()),
        T.StructField("meta", T.StructType([T.StructField("a", T.StringType())])),
    ])
    rows = [(1, decimal.Decimal("0.000000012300"), None, None), (None, None, None, (None,)),
            (3, decimal.Decimal("12.5"), 'q"uote', ("x",)), (4, decimal.Decimal("-0.000000000001"), None, None)]
    got = [r.json for r in jsonio.encode(spark.createDataFrame(rows, schema)).orderBy(F.col("id").asc_nulls_first()).collect()]
    assert got[0] == '{"meta":{}}'
    assert got[1] == '{"id":1,"amount":0.000000012300}'
    assert got[2] == '{"id":3,"amount":12.500000000000,"note":"q\\"uote","meta":{"a":"x"}}'
    assert got[3] == '{"id":4,"amount":-0.000000000001}'
    assert json.loads(got[2])["note"] == 'q"uote'


def test_duplicate_keys_last_wins_or_reject(spark):
    df = spark.createDataFrame([(1, '{"k": 1, "level": "LOW", "k": 2}')], "id long, payload string")
    r = jsonio.decode(df, "payload", PAYLOAD_SCHEMA).first()
    assert r.accepted and r.k == 2
    r = jsonio.decode(df, "payload", PAYLOAD_SCHEMA, duplicate_keys="reject").first()
    assert r.reject.kind == "unreadable"
    jsonio.decode(df, "payload", PAYLOAD_SCHEMA)  # back to the default for later tests


def test_more_kinds_and_nulls(spark):
    from decimal import Decimal

    F_ = jsonio.Field
    schema = (F_("id", "long", required=True), F_("n", "int"), F_("x", "double"), F_("d", "decimal", precision=(20, 4)),
              F_("b", "boolean"))
    texts = ['{"id": 5000000000, "n": null, "x": 1.5, "d": 12.3456, "b": true}', '{"id": "7", "x": "2", "d": "0.5", "b": "false"}',
             '{"id": null}', '{"n": 1}', '{"id": 1, "b": "yes"}', '{"id": 1, "x": true}', '{"id": 1, "b": 0}']
    df = spark.createDataFrame(list(enumerate(texts)), "i int, payload string")
    got = [r for r in jsonio.decode(df, "payload", schema).orderBy("i").collect()]
    assert (got[0].id, got[0].n, got[0].x, got[0].d, got[0].b) == (5000000000, None, 1.5, Decimal("12.3456"), True)
    assert (got[1].id, got[1].x, got[1].d, got[1].b) == (7, 2.0, Decimal("0.5"), False)
    assert [r.accepted for r in got] == [True, True, False, False, False, False, True] and got[6].b is False
    assert [got[k].reject.path for k in (2, 3, 4, 5)] == ["id", "id", "b", "x"]


def test_clashing_field_names_are_refused(spark):
    df = spark.createDataFrame([("{}",)], "payload string")
    for schema in [(jsonio.Field("a_b", "int"), jsonio.Field("a", "object", fields=(jsonio.Field("b", "int"),))),
                   (jsonio.Field("a.b", "int"),)]:
        with pytest.raises(ValueError):
            jsonio.decode(df, "payload", schema)


def test_duplicate_keys_leave_the_session_alone(spark):
    key = "spark.sql.variant.allowDuplicateKeys"
    before = spark.conf.get(key)
    df = spark.createDataFrame([('{"k": 1, "k": 2}',)], "payload string")
    last = jsonio.decode(df, "payload", (jsonio.Field("k", "int"),))
    reject = jsonio.decode(df, "payload", (jsonio.Field("k", "int"),), duplicate_keys="reject")
    assert spark.conf.get(key) == before
    assert last.first().k == 2 and reject.first().reject.kind == jsonio.UNREADABLE


def test_nested_decimals_are_plain(spark):
    df = spark.sql("""SELECT array(1.23e-8BD, NULL) AS a, map('k"', 1.23e-8BD) AS m,
                      array(named_struct('d', 1.23e-8BD, 'n', CAST(NULL AS INT))) AS s, CAST(NULL AS array<decimal(9,8)>) AS z""")
    assert jsonio.encode(df).first().json == (
        '{"a":[0.0000000123,null],"m":{"k\\"":0.0000000123},"s":[{"d":0.0000000123}]}')
