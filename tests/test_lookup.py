import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerline import schemas
from ledgerline.operators import lookup, validate
from ledgerline.operators.envelope import flatten_envelope

T0 = dt.datetime(2024, 1, 1)


def entities(spark, rows):
    full = [(i, n, d, T0, T0, deleted) for i, n, d, deleted in rows]
    return spark.createDataFrame(full, schemas.ENTITY)


def answer(spark, ents, raws, **kw):
    req = spark.createDataFrame(list(enumerate(raws)), schemas.REQUEST)
    checked = validate.check_key(req)
    checked = checked.withColumn("error_type", F.when(F.col("error_kind").isNotNull(), F.lit("BAD_REQUEST")))
    out = flatten_envelope(lookup.answer(checked.drop("error_kind"), ents, **kw))
    return {r["request_id"]: r for r in out.collect()}


def test_find_returns_row_including_soft_deleted(spark):
    ents = entities(spark, [(1, "a", "x", None), (2, "b", "y", T0)])
    assert [r.id for r in lookup.find(ents, 2).collect()] == [2]
    assert lookup.find(ents, 3).count() == 0


@pytest.mark.parametrize("max_rows", [0, 1000])
def test_find_many_hits_only(spark, max_rows):
    ents = entities(spark, [(1, "a", "x", None), (2, "b", "y", T0)])
    keys = spark.createDataFrame([(2,), (2,), (9,), (None,)], "id long")
    got = sorted(r.id for r in lookup.find_many(ents, keys, max_broadcast_rows=max_rows).collect())
    assert got == [2]  # once, although requested twice; soft-deleted rows are found


@pytest.mark.parametrize("max_rows,strategy", [(0, "auto"), (1000, "auto"), (1000, "broadcast_requests"),
                                               (1000, "shuffle")])
def test_hit_miss_and_type_errors(spark, max_rows, strategy):
    ents = entities(spark, [(7, "seven", "lucky", None), (8, "eight", "round", T0)])
    out = answer(spark, ents, ["7", "999", "-1", "일곱", None, " +8 ", "7"], max_broadcast_rows=max_rows,
                 strategy=strategy)
    assert out[0]["result"] == "SUCCESS" and out[0]["data_name"] == "seven" and out[0]["status"] == 200
    assert out[0]["error_code"] is None and out[0]["message"] is None
    assert out[1]["result"] == "FAIL" and out[1]["status"] == 404 and "999" in out[1]["message"]
    assert out[1]["data_id"] is None
    # -1 is a well-formed key that misses, not a type error
    assert out[2]["status"] == 404 and out[2]["error_code"] == "Not Found"
    assert out[3]["status"] == 400 and "일곱" in out[3]["message"]
    assert out[4]["status"] == 400 and "missing" in out[4]["message"]
    # soft-deleted rows are still found; padding and sign accepted
    assert out[5]["result"] == "SUCCESS" and out[5]["data_id"] == 8
    # duplicates kept: one answer per request
    assert out[6]["data_id"] == 7 and len(out) == 7


def test_projection_prunes_audit_columns(spark, tmpdir_fresh):
    ents = entities(spark, [(1, "a", "x", None)])
    ents.write.mode("overwrite").parquet(tmpdir_fresh + "/e")
    scanned = spark.read.parquet(tmpdir_fresh + "/e")
    plan = lookup.project(lookup.find(scanned, 1))._jdf.queryExecution().executedPlan().toString()
    assert "created_at" not in plan
    assert "PushedFilters: [IsNotNull(id), EqualTo(id,1)]" in plan


def test_hot_request_key_is_split_by_aqe(spark):
    """A third of the requests ask for one id. On the shuffle path AQE's skew
    join splits that partition; answers stay whole and correct."""
    conf = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        n = 30000
        req = spark.range(n).select(
            F.col("id").alias("request_id"),
            F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") % 5000 + 1).alias("id"))
        ents = spark.range(1, 4001).select("id", F.concat(F.lit("n"), F.col("id").cast("string")).alias("name"),
                                           F.lit("d").alias("description"))
        out = lookup.lookup(req, ents, max_broadcast_rows=0).select("request_id", "id", "found")
        rows = out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert len(rows) == n
        assert sum(r.found for r in rows) == sum(1 for r in rows if r.id <= 4000)
        assert "isSkewJoin=true" in plan or "skew=true" in plan
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_bucketed_entities_are_not_shuffled(spark):
    from ledgerline.sources.tables import save_bucketed

    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        ents = spark.range(1, 2001).select("id", F.lit("n").alias("name"), F.lit("d").alias("description"))
        save_bucketed(ents, "entities_bucketed", buckets=8)
        req = spark.range(5000).select(F.col("id").alias("request_id"), (F.col("id") % 3000).alias("id"))
        out = lookup.lookup(req, spark.table("entities_bucketed"), max_broadcast_rows=0)
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1  # requests only
        assert out.where("found").count() == sum(1 for i in range(5000) if 1 <= i % 3000 <= 2000)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize("strategy", ["broadcast_requests", "shuffle"])
def test_random_requests_match_brute_force(spark, strategy):
    import random
    import re as _re

    r = random.Random(11)
    ents = {i: (f"n{i}", f"d{i}", r.random() < 0.3) for i in r.sample(range(1, 400), 150)}
    raws = [r.choice([str(r.randint(-5, 420)), f" +{r.randint(0, 400)} ", "x1", "5.0", None, "", "99999999999999999999",
                      str(r.choice(list(ents)))]) for _ in range(600)]
    got = answer(spark, entities(spark, [(i, n, d, T0 if dead else None) for i, (n, d, dead) in ents.items()]),
                 raws, strategy=strategy)
    for i, raw in enumerate(raws):
        row = got[i]
        ok_key = raw is not None and _re.fullmatch(r" *[+-]?[0-9]+ *", raw) and -2 ** 63 <= int(raw) < 2 ** 63
        if raw is None:
            want = (400, "FAIL", "Required parameter 'id' (type Long) is missing.", None)
        elif not ok_key:
            want = (400, "FAIL", f"Parameter 'id' (type Long) has an invalid value '{raw}'.", None)
        elif int(raw) in ents:
            want = (200, "SUCCESS", None, ents[int(raw)][0])  # soft-deleted rows are found too
        else:
            want = (404, "FAIL", f"No item was found for id {int(raw)}.", None)
        assert (row.status, row.result, row.message, row.data_name) == want, raw
        assert row.error_code == (None if want[0] == 200 else {400: "Bad Request", 404: "Not Found"}[want[0]])


def test_requests_without_a_key_are_spread(spark):
    ents = entities(spark, [(i, "n", "d", None) for i in range(20)])
    req = spark.range(4000).select(F.col("id").alias("request_id"), F.when(F.col("id") % 40 == 0, F.col("id") % 20).alias("id"))
    out = lookup.lookup(req, ents, strategy="shuffle")
    assert out.where("found").count() == 100 and out.count() == 4000
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = lookup.lookup(req, ents, strategy="shuffle")
        parts = out.where("id IS NULL").groupBy(F.spark_partition_id()).count().collect()
        assert len(parts) == 8 and max(r["count"] for r in parts) < 1000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_broadcast_of_requests_checks_their_number(spark):
    ents = entities(spark, [(1, "a", "x", None)])
    req = spark.range(10).select(F.col("id").alias("request_id"), "id")
    with pytest.raises(ValueError):
        lookup.lookup(req, ents, max_broadcast_rows=9, strategy="broadcast_requests")


@pytest.mark.parametrize("bucketed", [False, True])
def test_hot_keys_are_split_off(spark, bucketed):
    from ledgerline.sources.tables import save_bucketed

    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        ents = spark.range(1, 2001).select("id", F.lit("n").alias("name"), F.lit("d").alias("description"))
        if bucketed:
            save_bucketed(ents, "entities_hot", buckets=8)
            ents = spark.table("entities_hot")
        # Half of the requests on key 7, a tenth on a key without an entity, some without a key.
        key = F.when(F.col("id") % 2 == 0, 7).when(F.col("id") % 10 == 1, -5).when(F.col("id") % 10 != 3, F.col("id") % 3000)
        req = spark.range(0, 8000, numPartitions=8).select(F.col("id").alias("request_id"), key.cast("bigint").alias("id"))
        assert {7, -5} <= set(lookup.hot_keys(req)) and len(lookup.hot_keys(req)) <= 100
        out = lookup.lookup(req, ents, strategy="split_hot")
        got = {r["request_id"]: (r["id"], r["found"], r["entity"] and r["entity"]["id"]) for r in out.collect()}
        keys = {i: 7 if i % 2 == 0 else -5 if i % 10 == 1 else i % 3000 if i % 10 != 3 else None for i in range(8000)}
        hit = {i: k is not None and 1 <= k <= 2000 for i, k in keys.items()}
        assert got == {i: (k, hit[i], k if hit[i] else None) for i, k in keys.items()}
        spark.conf.set("spark.sql.adaptive.enabled", "false")  # tiny partitions would be merged
        out = lookup.lookup(req, ents, strategy="split_hot")
        shares = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
        assert max(shares) < 8000 / 8  # half of the requests met in one task otherwise
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == (1 if bucketed else 2)  # a bucketed table stays in place
        assert lookup.lookup(req.limit(0), ents, strategy="split_hot").count() == 0
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
