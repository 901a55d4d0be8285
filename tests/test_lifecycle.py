"""Lifecycle fold against a row-by-row state machine (the brute force)."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from ledgerline import schemas
from ledgerline.functions.text import BLANK_PATTERN
from ledgerline.operators import lifecycle

import regex

T0 = dt.datetime(2024, 1, 1)
_BLANK = regex.compile(BLANK_PATTERN.replace(r"\z", r"\Z"))


def brute_force(changes):
    """Apply changes one at a time, as the entity would."""
    state = {}
    for cid, eid, ts, op, desc in sorted(changes, key=lambda c: (c[0], c[2], c[1])):
        if op == "UPDATE" and (desc is None or _BLANK.match(desc)):
            continue  # rejected, row unchanged
        s = state.get(cid)
        if op == "CREATE":
            state[cid] = {"description": desc, "created_at": ts, "updated_at": ts, "deleted_at": None}
            continue
        if s is None:
            s = state[cid] = {"description": None, "created_at": ts, "updated_at": None, "deleted_at": None,
                              "_first": True}
        if op == "UPDATE":
            if s["description"] != desc:
                s["description"] = desc
                s["updated_at"] = ts
        elif op == "DELETE":
            if s["deleted_at"] is None:
                s["deleted_at"] = ts
                s["updated_at"] = ts
        elif op == "RESTORE":
            if s["deleted_at"] is not None:
                s["deleted_at"] = None
                s["updated_at"] = ts
    return {k: (v["description"], v["created_at"], v["updated_at"], v["deleted_at"]) for k, v in state.items()}


def as_dict(df):
    return {r.id: (r.description, r.created_at, r.updated_at, r.deleted_at) for r in df.collect()}


def at(m):
    return T0 + dt.timedelta(minutes=m)


def test_idempotent_delete_and_restore(spark):
    rows = [(1, 1, at(0), "CREATE", "a"), (1, 2, at(10), "RESTORE", None),  # restore a live row: no-op
            (1, 3, at(20), "DELETE", None), (1, 4, at(30), "DELETE", None),  # second delete keeps the first time
            (2, 5, at(0), "CREATE", "b"), (2, 6, at(5), "DELETE", None), (2, 7, at(7), "RESTORE", None),
            (2, 8, at(9), "UPDATE", "b"),  # same value: no change
            (2, 9, at(11), "UPDATE", "  ")]  # blank: rejected
    got = as_dict(lifecycle.fold(spark.createDataFrame(rows, schemas.CHANGE)))
    assert got[1] == ("a", at(0), at(20), at(20))
    assert got[2] == ("b", at(0), at(7), None)


def random_log(n_ids, n_rows, seed, hot_share=0.0):
    rnd = random.Random(seed)
    rows, eid = [], 0
    for i in range(n_ids):
        rows.append((i, eid, at(rnd.randint(0, 10)), "CREATE", f"d{rnd.randint(0, 2)}"))
        eid += 1
    for _ in range(n_rows):
        cid = 0 if rnd.random() < hot_share else rnd.randrange(n_ids)
        op = rnd.choice(["UPDATE", "UPDATE", "DELETE", "RESTORE", "DELETE"])
        desc = rnd.choice(["d0", "d1", "d2", "", " "]) if op == "UPDATE" else None
        rows.append((cid, eid, at(rnd.randint(11, 5000)), op, desc))
        eid += 1
    return rows


@pytest.mark.parametrize("grain", [1, 60, 3600, 10 ** 7])
def test_fold_equals_state_machine(spark, grain):
    rows = random_log(20, 1500, seed=grain, hot_share=0.4)
    got = as_dict(lifecycle.fold(spark.createDataFrame(rows, schemas.CHANGE), grain_seconds=grain))
    assert got == brute_force(rows)


@pytest.mark.parametrize("cut", [5, 11, 600, 2500, 4999])
@pytest.mark.parametrize("max_ids", [0, 1000])
def test_incremental_equals_full_fold(spark, cut, max_ids):
    rows = random_log(15, 800, seed=cut, hot_share=0.3)
    log = spark.createDataFrame(rows, schemas.CHANGE)
    full = as_dict(lifecycle.fold(log))
    t = at(cut)
    snap = lifecycle.fold(log.where(F.col("ts") < F.lit(t)))
    inc = as_dict(lifecycle.fold_incremental(snap, log.where(F.col("ts") >= F.lit(t)), grain_seconds=120,
                                             max_broadcast_ids=max_ids))
    assert inc == full


def test_incremental_leaves_untouched_ids_alone(spark):
    rows = random_log(30, 300, seed=4)
    log = spark.createDataFrame(rows, schemas.CHANGE)
    snap = lifecycle.fold(log.where(F.col("ts") < F.lit(at(2000))))
    later = log.where((F.col("ts") >= F.lit(at(2000))) & F.col("id").isin(1, 2))
    out = as_dict(lifecycle.fold_incremental(snap, later))
    before = as_dict(snap)
    assert {k: v for k, v in out.items() if k not in (1, 2)} == {k: v for k, v in before.items() if k not in (1, 2)}
    assert out == brute_force([r for r in rows if r[2] < at(2000) or r[0] in (1, 2)])


def test_log_is_shuffled_once(spark):
    """One exchange of the log for the sliced lag, reused by the slice-head
    branch; the other exchanges carry one row per slice or per id."""
    import re

    rows = random_log(5, 100, seed=1)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = lifecycle.fold(spark.createDataFrame(rows, schemas.CHANGE))
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    log_exchanges = [line for line in plan.splitlines() if "ReusedExchange" not in line
                     and re.search(r"Exchange hashpartitioning\(id#\d+L, kind#\d+, bucket#\d+L", line)]
    assert len(log_exchanges) == 1
    assert "ReusedExchange" in plan


def test_late_changes_refold_only_affected_ids(spark):
    rows = random_log(12, 600, seed=7, hot_share=0.3)
    late = [r for r in rows if r[0] in (2, 5) and r[3] != "CREATE"][::3]
    on_time = [r for r in rows if r not in late]
    snap = lifecycle.fold(spark.createDataFrame(on_time, schemas.CHANGE))
    fixed = lifecycle.apply_late_changes(snap, spark.createDataFrame(on_time, schemas.CHANGE),
                                         spark.createDataFrame(late, schemas.CHANGE))
    assert as_dict(fixed) == brute_force(rows)


def test_hot_id_is_spread_over_tasks(spark):
    """An id with 40% of the log is processed by many tasks, not one."""
    rows = random_log(20, 3000, seed=3, hot_share=0.4)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        marked = lifecycle._with_effective(spark.createDataFrame(rows, schemas.CHANGE), 600, None)
        tasks = (marked.where(F.col("id") == 0).select(F.spark_partition_id().alias("p")).distinct().count())
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert tasks >= 4


def any_log(n_ids, n_rows, seed):
    """Any change may come first; CREATE repeats, at times without a description."""
    rnd = random.Random(seed)
    rows = []
    for eid in range(n_rows):
        op = rnd.choice(["CREATE", "UPDATE", "UPDATE", "DELETE", "RESTORE"])
        desc = rnd.choice(["d0", "d1", None, " "]) if op in ("CREATE", "UPDATE") else None
        rows.append((rnd.randrange(n_ids), eid, at(rnd.randint(0, 3000)), op, desc))
    return rows


@pytest.mark.parametrize("cut", [60, 1000, 2500])
@pytest.mark.parametrize("max_ids", [0, 1000])
def test_incremental_equals_full_fold_of_any_log(spark, cut, max_ids):
    rows = [(99, 5000, at(0), "DELETE", None), (99, 5001, at(2900), "CREATE", "late")] + any_log(40, 300, seed=cut)
    log = spark.createDataFrame(rows, schemas.CHANGE)
    t = F.lit(at(cut))
    snap = lifecycle.fold(log.where(F.col("ts") < t), resumable=True)
    inc = lifecycle.fold_incremental(snap, log.where(F.col("ts") >= t), max_broadcast_ids=max_ids)
    assert inc.columns == snap.columns
    assert as_dict(inc) == as_dict(lifecycle.fold(log))


@pytest.mark.parametrize("cut", [0, 1, 2500, 5001])
def test_bursts_cut_by_count(spark, cut):
    """Half of the log is on id 0, all of it in few slices of a whole day."""
    rows = random_log(8, 3000, seed=21, hot_share=0.5)
    log = spark.createDataFrame(rows, schemas.CHANGE)
    want = brute_force(rows)
    day = 86_400
    if not cut:
        assert as_dict(lifecycle.fold(log, day, max_slice_rows=50)) == want
        return
    before, after = log.where(F.col("ts") < F.lit(at(cut))), log.where(F.col("ts") >= F.lit(at(cut)))
    snapshot = lifecycle.fold(before, day, resumable=True, max_slice_rows=50)
    assert as_dict(lifecycle.fold_incremental(snapshot, after, day, max_slice_rows=50)) == want
    late = lifecycle.apply_late_changes(lifecycle.fold(after, day, True, 50), after, before, day, max_slice_rows=50)
    assert as_dict(late) == want


def test_no_slice_of_a_burst_is_large(spark):
    rows = spark.range(40_000).select((F.col("id") % 2 * F.col("id")).alias("id"), F.col("id").alias("event_id"),
                                      F.lit(T0).cast("timestamp_ntz").alias("ts"), F.lit(7).cast("bigint").alias("bucket"))
    parts = lifecycle._cut_bursts(rows, 1000)
    sizes = {(r["id"], r["bucket"]): r["count"] for r in parts.groupBy("id", "bucket").count().collect()}
    hot = sorted((b["part"], n) for (i, b), n in sizes.items() if i == 0)
    assert sum(n for _, n in hot) == 20_000 and len(hot) >= 15 and max(n for _, n in hot) <= 3000
    assert parts.count() == 40_000 and parts.select("event_id").distinct().count() == 40_000
    order = [tuple(r) for r in parts.where("id = 0").groupBy("bucket").agg(F.min("event_id"), F.max("event_id")).orderBy("bucket").select(
        "min(event_id)", "max(event_id)").collect()]
    assert all(a[1] < b[0] for a, b in zip(order, order[1:]))  # parts follow the order of changes
    assert dict(lifecycle._cut_bursts(rows, 20_000).dtypes)["bucket"] == "bigint"  # nothing to cut
