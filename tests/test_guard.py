"""The guard against a row-by-row machine."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerline import schemas
from ledgerline.operators import guard, lifecycle
from tests.test_lifecycle import as_dict, at, brute_force

RULES = (guard.Rule("not_deleted", "deleted", lambda was: F.lit(was.deleted) & (F.col("op") == "UPDATE")),
         guard.Rule("known", "unknown", lambda was: F.lit(not was.exists) & (F.col("op") != "CREATE")),
         guard.Rule("no_fall", "falls", lambda was: F.col("value_class") < F.lit(was.value).cast("int")),
         guard.Rule("no_delete_of_0", "kept", lambda was: F.lit(was.value == 0) & (F.col("op") == "DELETE")))


# As schemas.CHANGE, with ids that may be null.
NULLABLE = "id bigint, event_id bigint, ts timestamp_ntz, op string, description string"


def value_class():
    return F.substring("description", 2, 9).try_cast("int")


def machine(changes):
    state, out = {}, {}
    for cid, eid, ts, op, desc in sorted(changes, key=lambda c: (repr(c[0]), c[2], c[1])):
        exists, deleted, value = state.get(cid, (False, False, None))
        own = int(desc[1:]) if desc and desc[1:].isdigit() and int(desc[1:]) < 4 else None
        raw = int(desc[1:]) if desc and desc[1:].isdigit() else None
        if op == "UPDATE" and (desc is None or not desc.strip()):
            out[eid] = "not_blank"
        elif deleted and op == "UPDATE":
            out[eid] = "not_deleted"
        elif not exists and op != "CREATE":
            out[eid] = "known"
        elif raw is not None and value is not None and raw < value:
            out[eid] = "no_fall"
        elif value == 0 and op == "DELETE":
            out[eid] = "no_delete_of_0"
        else:
            out[eid] = None
            if op in ("CREATE", "UPDATE"):
                state[cid] = (True, deleted, own)
            elif op in ("DELETE", "RESTORE"):
                state[cid] = (True, op == "DELETE", value)
    return out


def log(n, seed):
    rnd = random.Random(seed)
    rows = []
    for eid in range(n):
        op = rnd.choice(["CREATE", "UPDATE", "UPDATE", "UPDATE", "DELETE", "RESTORE", "RESTORE", "OTHER"])
        desc = rnd.choice(["d0", "d0", "d0", "d0", "d1", "d2", "d3", "d7", "dx", " ", None]) if op in ("CREATE", "UPDATE") else None
        rows.append((0 if rnd.random() < 0.5 else rnd.choice([*range(1, 9), None]), eid, at(rnd.randint(0, n // 4)), op, desc))
    return rows


# Without cuts, with one level of runs, with several levels over several ranges.
@pytest.mark.parametrize(("n", "slice_rows", "rows_per_range"), [(600, 1000, 10_000), (900, 40, 200), (300, 5, 60)])
def test_guard_equals_the_machine(spark, n, slice_rows, rows_per_range):
    rows = log(n, n)
    got = guard.guard(spark.createDataFrame(rows, NULLABLE), RULES, value_class(), 4, slice_rows, rows_per_range)
    assert got.columns == ["id", "event_id", "ts", "op", "description", "rule", "message"]
    found = got.collect()
    want = machine(rows)
    assert len(found) == n and {r["event_id"]: r["rule"] for r in found} == want
    assert len(set(want.values())) == 6
    assert {tuple(r)[:5] for r in found} == set(rows)
    texts = {r.name: r.message for r in RULES} | {"not_blank": "Description must not be blank.", None: None}
    assert all(r["message"] == texts[r["rule"]] for r in found)


def test_snapshot_of_accepted_changes(spark):
    rows = [(1, 1, at(0), "CREATE", "d1"), (1, 2, at(1), "UPDATE", "d3"), (1, 3, at(2), "UPDATE", "d2"),  # falls: rejected
            (1, 4, at(3), "DELETE", None), (1, 5, at(4), "UPDATE", "d3"),  # deleted: rejected
            (1, 6, at(5), "RESTORE", None), (1, 7, at(6), "UPDATE", "d3")]  # the value is still d3: no change
    done = guard.guard(spark.createDataFrame(rows, schemas.CHANGE), RULES, value_class(), 4)
    assert as_dict(lifecycle.fold(done.where("rule IS NULL")))[1] == ("d3", at(0), at(5), None)
    assert brute_force([r for r in rows if r[1] not in (3, 5)])[1] == ("d3", at(0), at(5), None)


def test_no_rules_and_no_changes(spark):
    changes = spark.createDataFrame([(1, 1, at(0), "UPDATE", " "), (1, 2, at(0), "UPDATE", "x")], schemas.CHANGE)
    assert [r["rule"] for r in guard.guard(changes, (), F.lit(None), 0).orderBy("event_id").collect()] == ["not_blank", None]
    assert guard.guard(changes.limit(0), RULES, value_class(), 4).count() == 0
