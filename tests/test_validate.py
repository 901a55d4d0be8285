import pytest
from pyspark.sql import functions as F

from ledgerline.operators import validate
from ledgerline.plans.inputs import BLANK_CASES


def run(spark, rows):
    df = spark.createDataFrame(rows, "id long, name string, description string")
    return {r.id: r for r in validate.apply_rules(df, validate.entity_rules()).collect()}


def test_valid_and_invalid_creates(spark):
    got = run(spark, [(1, "name", "desc"), (2, "   ", "desc"), (3, "name", ""), (4, "", "\t"), (5, None, "d"),
                      (6, "n", None)])
    assert got[1].accepted and got[1].error_type is None
    assert got[2].rule == "name_blank" and got[2].error_type == "BAD_REQUEST"
    assert got[3].rule == "description_blank"
    # both blank: only the first rule fires
    assert got[4].rule == "name_blank"
    # missing counts as blank
    assert (got[5].rule, got[6].rule) == ("name_blank", "description_blank")


def test_blank_semantics(spark):
    rows = [(i, "".join(map(chr, c)), "x") for i, c in enumerate(BLANK_CASES)]
    got = run(spark, rows)
    blank = {i for i, r in got.items() if r.rule == "name_blank"}
    not_blank = {5, 6, 7, 10}  # NEL, "a", ZWSP, space + NEL
    assert blank == set(range(len(BLANK_CASES))) - not_blank


def test_split_partitions_rows(spark):
    df = spark.createDataFrame([(1, "a", "b"), (2, " ", "b"), (3, "a", "")], "id long, name string, description string")
    acc, rej = validate.split(df, validate.entity_rules())
    assert [r.id for r in acc.collect()] == [1]
    assert sorted(r.id for r in rej.collect()) == [2, 3]
    assert acc.columns == df.columns


@pytest.mark.parametrize("reason,token", [
    ("Required values 'a' and 'b' are not present", "a"),
    ("no quotes here", ""),
    ("''", ""),
    ("'' then 'x'", "' then "),
    (None, ""),
])
def test_quoted_token(spark, reason, token):
    from ledgerline.functions.text import quoted_token

    df = spark.createDataFrame([(reason,)], "reason string")
    r = df.select(quoted_token(F.coalesce("reason", F.lit(""))).alias("t"),
                  validate.missing_value_message(F.col("reason")).alias("m")).first()
    assert r.t == token
    assert (r.m is None) == (token == "")


@pytest.mark.parametrize("raw,parsed", [("5", 5), (" 5 ", 5), ("+5", 5), ("-1", -1), ("5.0", None), ("abc", None),
                                        ("18446744073709551616", None), (None, None), ("", None)])
def test_parse_key(spark, raw, parsed):
    df = spark.createDataFrame([(1, raw)], "request_id long, raw_id string")
    r = validate.check_key(df).first()
    assert r.id == parsed
    assert r.error_kind == (None if parsed is not None else ("missing_parameter" if raw is None else "type_mismatch"))


def test_write_split_writes_both_sides_in_one_pass(spark, tmpdir_fresh):
    df = spark.createDataFrame([(1, "a", "b"), (2, " ", "b"), (3, "a", ""), (4, "c", "d")],
                               "id long, name string, description string")
    path = tmpdir_fresh + "/split"
    validate.write_split(df, validate.entity_rules(), path)
    back = spark.read.parquet(path)
    assert sorted(r.id for r in back.where("verdict = 'accepted'").collect()) == [1, 4]
    assert {r.id: r.rule for r in back.where("verdict = 'rejected'").collect()} == {2: "name_blank",
                                                                                   3: "description_blank"}
    assert dict(back.dtypes)["accepted"] == "boolean"
