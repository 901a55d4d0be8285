import datetime as dt

from pyspark.sql import functions as F

from ledgerline import schemas
from ledgerline.operators import metrics, runs

SF = "/root/testdata/sf0.001"


def test_daily_job_requires_date(spark):
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    assert runs.run_daily(orders, "o_orderdate", None).status == runs.FAILED
    res = runs.run_daily(orders, "o_orderdate", "1997-06-15")
    assert res.status == runs.COMPLETED
    days = {r.d for r in res.rows.select(F.to_date("o_orderdate").alias("d")).distinct().collect()}
    assert days <= {dt.date(1997, 6, 15)}


def test_daily_job_pushes_range_to_scan(spark):
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    plan = runs.run_daily(orders, "o_orderdate", "1997-06-15").rows._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate" in plan and "LessThan(o_orderdate" in plan


def test_daily_job_overwrites_only_its_date(spark, tmpdir_fresh):
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    out = tmpdir_fresh + "/daily"
    d1, d2 = [r.d.isoformat() for r in orders.select(F.to_date("o_orderdate").alias("d")).distinct()
              .orderBy("d").limit(2).collect()]
    for d in [d1, d2, d1]:
        runs.run_daily(orders, "o_orderdate", d, out_path=out)
    back = spark.read.parquet(out)
    expected = runs.date_scope(orders, "o_orderdate", d1).count() + runs.date_scope(orders, "o_orderdate", d2).count()
    assert back.count() == expected


def test_duration_parts_do_not_wrap_hours(spark):
    df = spark.createDataFrame([(1, "j", 0, 93784999)], schemas.RUN_LOG)
    r = runs.run_durations(df).first()
    assert (r.hours, r.minutes, r.seconds) == (26, 3, 4)
    assert r.start_local == dt.datetime(1970, 1, 1, 9, 0)


def test_step_status(spark):
    t = dt.datetime(2024, 1, 1)
    rows = [
        (1, 3, t + dt.timedelta(hours=5), True, "late"),
        (1, 1, t, True, "first"),
        (1, 2, t + dt.timedelta(minutes=1), True, None),
        (1, 4, t + dt.timedelta(minutes=2), False, "ignored"),
        (2, 5, t, False, "fine"),
        (3, 6, t, True, None),
    ]
    got = {r.step_id: r for r in runs.step_status(spark.createDataFrame(rows, schemas.STEP_LOG), 3600).collect()}
    assert got[1].status == runs.FAILED and got[1].messages == "first\nlate" and got[1].n_failures == 3
    assert got[2].status == runs.COMPLETED and got[2].messages == ""
    assert got[3].status == runs.FAILED and got[3].messages == ""


def test_observe_counts(spark):
    df, obs = runs.observe_counts(spark.range(17))
    df.write.format("noop").mode("overwrite").save()
    assert obs.get["read_count"] == 17


def test_histogram_is_cumulative(spark):
    df = spark.createDataFrame([("a", 0.5), ("a", 5.0), ("a", 7.0), ("a", 300.0), ("b", 1.0)], "t string, v double")
    got = {r.t: r for r in metrics.latency_histogram(df, "v", ["t"], "app", bounds=(1.0, 5.0, 2.5)).collect()}
    a = got["a"]
    assert (a.le_1, a.le_2_5, a.le_5, a["count"], a["sum"], a.application) == (1, 1, 2, 4, 312.5, "app")
    assert got["b"].le_1 == 1


def test_failure_texts_concatenate_to_step_messages(spark):
    t = dt.datetime(2024, 1, 1)
    rows = [(1, i, t + dt.timedelta(minutes=37 * i), i % 2 == 0, f"m{i}") for i in range(40)]
    steps = spark.createDataFrame(rows, schemas.STEP_LOG)
    parts = runs.step_failure_texts(steps, 3600).orderBy("slice").collect()
    assert len(parts) > 1 and sum(p.n_messages for p in parts) == 20
    whole = runs.step_status(steps, 3600).first().messages
    assert whole == "\n".join(p.text for p in parts) == "\n".join(f"m{i}" for i in range(0, 40, 2))


def test_daily_job_appends_run_log(spark, tmpdir_fresh):
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    log = tmpdir_fresh + "/runs"
    d = orders.select(F.to_date("o_orderdate").alias("d")).first().d.isoformat()
    runs.run_daily(orders, "o_orderdate", None, run_log_path=log)
    runs.run_daily(orders, "o_orderdate", d, out_path=tmpdir_fresh + "/out", run_log_path=log)
    got = sorted((r.status, r.request_date, r.write_count) for r in spark.read.parquet(log).collect())
    expected = runs.date_scope(orders, "o_orderdate", d).count()
    assert got == [("COMPLETED", d, expected), ("FAILED", None, None)] and expected > 0
    durations = runs.run_durations(spark.read.parquet(log).select("run_id", "job_name", "start_ms", "end_ms"))
    assert all(r.total_ms >= 0 for r in durations.collect())


def test_epoch_millis_is_zone_free(spark):
    from ledgerline.functions.timefmt import utc_epoch_millis, utc_wall_from_millis

    ts = [dt.datetime(2024, 1, 1, 0, 0, 7, 179575), dt.datetime(2024, 7, 1, 12, 30), dt.datetime(1970, 1, 1)]
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ["UTC", "Pacific/Apia", "America/New_York"]:
            spark.conf.set("spark.sql.session.timeZone", zone)
            df = spark.createDataFrame([(t,) for t in ts], "ts timestamp_ntz")
            got = df.select(utc_epoch_millis(F.col("ts")).alias("ms")).withColumn(
                "back", utc_wall_from_millis(F.col("ms"))).collect()
            want = [int((t - dt.datetime(1970, 1, 1)) / dt.timedelta(milliseconds=1)) for t in ts]
            assert [r.ms for r in got] == want
            assert [r.back for r in got] == [t.replace(microsecond=t.microsecond // 1000 * 1000) for t in ts]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_daily_job_logs_every_failure(spark, tmpdir_fresh):
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    log, blocked = tmpdir_fresh + "/runs", tmpdir_fresh + "/file"
    open(blocked, "w").close()
    bad = runs.run_daily(orders, "o_orderdate", "15.06.1997", run_log_path=log)
    assert bad.status == runs.FAILED and "15.06.1997" in bad.message
    unwritten = runs.run_daily(orders, "o_orderdate", "1997-06-15", out_path=blocked + "/x", run_log_path=log)
    assert unwritten.status == runs.FAILED and unwritten.rows is None
    got = spark.read.parquet(log)
    assert [r.status for r in got.collect()] == [runs.FAILED] * 2 and got.select("run_id").distinct().count() == 2


def test_histogram_sum_of_small_and_large_values(spark):
    df = spark.createDataFrame([("s", 4e-7)] * 1000 + [("l", 1e15)] * 3, "t string, v double")
    got = {r.t: r for r in metrics.latency_histogram(df, "v", ["t"], "app").collect()}
    assert (got["s"]["sum"], got["l"]["sum"]) == (0.0004, 3e15) and got["l"].le_inf == 3 and got["l"].le_250 == 0
