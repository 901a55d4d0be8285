"""Costly steps run once: the nested decode, the shuffle below it, the guarded log."""

from conftest import SF001
from pyspark.sql import functions as F

from ledgerline.operators import guard
from ledgerline.plans import inputs, registry


def _jobs(spark, group, build):
    sc = spark.sparkContext
    sc.setJobGroup(group, group)
    try:
        return build(), len(sc.statusTracker().getJobIdsForGroup(group))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def test_nested_bodies_are_parsed_once(spark):
    plan = registry.json_nested(spark, SF001)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson") == 1


def test_planning_the_nested_decode_runs_no_shuffle(spark):
    _, reading = _jobs(spark, "payloads", lambda: inputs.nested_payloads(spark, SF001))
    _, decoding = _jobs(spark, "decode", lambda: registry._nested(spark, SF001))
    assert decoding == reading


def test_the_log_is_derived_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def marked(x):
        seen.add(1)
        return x

    n = 500
    ids = spark.range(n, numPartitions=2)
    changes = ids.select(
        F.lit(1).alias("id"), F.col("id").alias("event_id"), F.timestamp_seconds("id").cast("timestamp_ntz").alias("ts"),
        F.when(F.col("id") == 0, "CREATE").otherwise("UPDATE").alias("op"), F.udf(marked, "string")(F.lit("d1")).alias("description"))
    got = guard.guard(changes, [], F.lit(0), 1, slice_rows=40, rows_per_range=200).where("rule IS NULL").collect()
    assert len(got) == n and seen.value == n
