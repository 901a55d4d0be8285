from pyspark.sql import functions as F

from ledgerline.operators import errors


def test_every_type_has_its_default_message(spark):
    df = spark.createDataFrame([(t, None) for t, *_ in errors.ERROR_CATALOGUE], "error_type string, custom_message string")
    got = {r.error_type: r for r in errors.with_error_details(df).collect()}
    for t, status, code, message in errors.ERROR_CATALOGUE:
        assert (got[t].status, got[t].code, got[t].message) == (status, code, message)


def test_custom_message_kept_even_when_empty(spark):
    df = spark.createDataFrame([("INTERNAL_ERROR", "custom"), ("BAD_REQUEST", "")],
                               "error_type string, custom_message string")
    got = {r.error_type: r.message for r in errors.with_error_details(df).collect()}
    assert got == {"INTERNAL_ERROR": "custom", "BAD_REQUEST": ""}


def test_routing(spark):
    rows = [("domain", "CONFLICT", "dup"), ("type_mismatch", None, "bad id"), ("missing_parameter", None, "m"),
            ("unreadable_body", None, "u"), ("input_error", None, "i"), ("no_resource", None, "gone"),
            ("boom", None, "stack trace")]
    df = spark.createDataFrame(rows, "kind string, domain_type string, detail string")
    got = {r.kind: (r.error_type, r.status, r.message) for r in errors.route_errors(df).collect()}
    assert got["domain"] == ("CONFLICT", 409, "dup")
    assert got["type_mismatch"] == ("BAD_REQUEST", 400, "bad id")
    assert got["no_resource"][:2] == ("NOT_FOUND", 404) and got["no_resource"][2] != "gone"
    # internal details are hidden behind the default message
    assert got["boom"] == ("INTERNAL_ERROR", 500, errors.ERROR_CATALOGUE[0][3])
    assert {got[k][0] for k in ["missing_parameter", "unreadable_body", "input_error"]} == {"BAD_REQUEST"}


def test_catalogue_table(spark):
    rows = {r.error_type: (r.status, r.code, r.message) for r in errors.catalogue_df(spark).collect()}
    assert rows == {t: (s, c, m) for t, s, c, m in errors.ERROR_CATALOGUE}
    assert sorted(s for s, _, _ in rows.values()) == [400, 404, 409, 500]
