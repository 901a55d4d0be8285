"""Random payloads: the Spark decoder against a plain-Python statement of
the policy (see jsonio's module docstring), in one Spark job."""

import json
import math
import os
import random
import re

import pytest

from ledgerline.operators import jsonio
from ledgerline.plans.registry import LEVELS, PAYLOAD_SCHEMA

INT_MIN, INT_MAX = -2 ** 31, 2 ** 31 - 1
STRINGS = ["7", " 8 ", "+9", "-3", "1.5", "abc", "", "LOW", "MID", "HIGH", "ULTRA", "x", "2147483648", "a{b", "[x]",
           'q"{', "back\\[", "]"]
FLOATS = [1.5, -2.5, 0.25, 3.0, -0.5]


def rand_scalar(r):
    return r.choice([
        lambda: None, lambda: r.random() < 0.5, lambda: r.randint(-5, 5), lambda: r.choice([2 ** 31, -2 ** 40]),
        lambda: r.choice(STRINGS), lambda: r.choice(FLOATS),
    ])()


def rand_value(r, depth=0):
    k = r.random()
    if depth < 1 and k < 0.15:
        return [rand_value(r, depth + 1) if r.random() < 0.2 else rand_scalar(r) for _ in range(r.randint(0, 3))]
    if depth < 1 and k < 0.3:
        return {r.choice(["source", "a"]): rand_value(r, depth + 1) for _ in range(r.randint(0, 2))}
    return rand_scalar(r)


def rand_payload(r):
    roll = r.random()
    if roll < 0.04:
        return json.dumps(r.choice([[1, 2], "text", 5, None]))
    obj = {key: rand_value(r) for key in ["k", "tags", "level", "meta", "extra"] if r.random() < 0.7}
    text = json.dumps(obj)
    return text[: len(text) // 2] if roll < 0.08 else text


def cat(v, present=True):
    if not present:
        return "missing"
    if v is None:
        return "null"
    if isinstance(v, bool):
        return "boolean"
    if isinstance(v, (int, float)):
        return "number"
    if isinstance(v, str):
        return "string"
    return "array" if isinstance(v, list) else "object"


def as_text(v):
    """Text of a JSON value as the decoder reports it: numbers in canonical
    form (a VARIANT keeps 3.0 as the decimal 3)."""
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, float) and v.is_integer():
        return str(int(v))
    return v if isinstance(v, str) else json.dumps(v)


def to_int(v):
    if isinstance(v, str):
        s = v.strip(" ")
        if not re.fullmatch(r"[+-]?[0-9]+", s):
            return None
        n = int(s)
    else:
        if isinstance(v, float) and not math.isfinite(v):
            return None
        n = int(v)  # truncates toward zero
    return n if INT_MIN <= n <= INT_MAX else None


def wrong(path, value, type_name, allowed=""):
    return ("wrong_type", path,
            f"Field '{path}' has value '{value}', which does not match the expected type ({type_name}).{allowed}")


def missing(path):
    return ("missing_field", path, f"Required field '{path}' is missing or has the wrong shape.")


def reference(text):
    try:
        obj = json.loads(text)
    except ValueError:
        return None, ("unreadable", "", jsonio.UNREADABLE_MESSAGE)
    if not isinstance(obj, dict):
        return None, missing("")
    out, rejects = {}, []
    k, kc = obj.get("k"), cat(obj.get("k"), "k" in obj)
    if kc in ("number", "string"):
        out["k"] = to_int(k)
        if out["k"] is None:
            rejects.append(wrong("k", as_text(k), "Integer"))
    elif kc != "missing":
        rejects.append(missing("k"))
    t, tc = obj.get("tags"), cat(obj.get("tags"), "tags" in obj)
    if tc == "array":
        if any(isinstance(e, (list, dict)) for e in t):
            rejects.append(missing("tags.?"))
        out["tags"] = [None if e is None else as_text(e) for e in t]
    elif tc in ("string", "number", "boolean"):
        out["tags"] = [as_text(t)]
    elif tc == "object":
        rejects.append(missing("tags"))
    lv, lc = obj.get("level"), cat(obj.get("level"), "level" in obj)
    if lc == "string":
        if lv in LEVELS:
            out["level"] = lv
        elif lv != "":
            rejects.append(wrong("level", lv, "Enum", " Allowed values: [" + ", ".join(LEVELS) + "]"))
    elif lc == "number":
        i = to_int(lv)
        if i is not None and 0 <= i < len(LEVELS):
            out["level"] = LEVELS[i]
        else:
            rejects.append(wrong("level", as_text(lv), "Enum", " Allowed values: [" + ", ".join(LEVELS) + "]"))
    elif lc in ("boolean", "array", "object"):
        rejects.append(missing("level"))
    m, mc = obj.get("meta"), cat(obj.get("meta"), "meta" in obj)
    if mc == "object":
        s, sc = m.get("source"), cat(m.get("source"), "source" in m)
        if sc in ("string", "number", "boolean"):
            out["meta_source"] = as_text(s)
        elif sc in ("array", "object"):
            rejects.append(missing("meta.source"))
    elif mc in ("array", "boolean", "number") or (mc == "string" and m != ""):
        rejects.append(missing("meta"))
    if kc == "missing":
        rejects.append(missing("k"))
    if rejects:
        return None, rejects[0]
    return out, None


@pytest.mark.parametrize("seed", [20261203, 7, 99])
def test_random_payloads_match_reference(spark, seed, n=int(os.environ.get("LEDGERLINE_RANDOM_N", "600"))):
    r = random.Random(seed)
    payloads = [rand_payload(r) for _ in range(n)]
    df = spark.createDataFrame(list(enumerate(payloads)), "id long, payload string")
    got = {row.id: row for row in jsonio.decode(df, "payload", PAYLOAD_SCHEMA).collect()}
    kinds = set()
    for i, text in enumerate(payloads):
        want, reject = reference(text)
        row = got[i]
        if reject is None:
            assert row.accepted, (text, row.reject)
            assert (row.k, row.tags, row.level, row.meta_source) == (
                want.get("k"), want.get("tags"), want.get("level"), want.get("meta_source")), text
        else:
            assert not row.accepted, text
            assert (row.reject.kind, row.reject.path, row.reject.message) == reject, text
            kinds.add(reject[0])
    assert kinds == {"unreadable", "missing_field", "wrong_type"}


def test_random_rows_encode_to_equivalent_json(spark):
    import decimal

    from pyspark.sql import types as T

    r = random.Random(5)
    schema = T.StructType([
        T.StructField("id", T.LongType()), T.StructField("name", T.StringType()),
        T.StructField("amount", T.DecimalType(20, 12)), T.StructField("flag", T.BooleanType()),
        T.StructField("meta", T.StructType([T.StructField("n", T.IntegerType()), T.StructField("s", T.StringType())])),
    ])
    texts = ["plain", 'q"uote', "back\\slash", "new\nline", "탭\t", "é", ""]

    def maybe(v):
        return None if r.random() < 0.25 else v

    rows = []
    for i in range(500):
        amount = decimal.Decimal(r.randint(-10 ** 14, 10 ** 14)).scaleb(-12)
        meta = maybe((maybe(r.randint(-9, 9)), maybe(r.choice(texts))))
        rows.append((maybe(i), maybe(r.choice(texts)), maybe(amount), maybe(r.random() < 0.5), meta))
    for o in jsonio.encode(spark.createDataFrame(rows, schema)).collect():
        parsed = json.loads(o.json, parse_float=decimal.Decimal)
        # null fields omitted, nested too; everything else round-trips
        want = {k: v for k, v in o.asDict(recursive=True).items() if k != "json" and v is not None}
        if "meta" in want:
            want["meta"] = {k: v for k, v in want["meta"].items() if v is not None}
        assert parsed == want
        if "amount" in parsed:
            # plain notation with the column's scale
            assert re.search(r'"amount":-?[0-9]+\.[0-9]{12}[,}]', o.json)
