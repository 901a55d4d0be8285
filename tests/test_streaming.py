import os
import time

import pytest

from pyspark.sql import functions as F

from ledgerline import schemas
from ledgerline.streaming import ingest


def records(spark, n):
    df = spark.range(n).select(
        F.col("id").cast("string").cast("binary").alias("key"),
        F.concat(F.lit('{"k": '), F.col("id").cast("string"), F.lit("}")).cast("binary").alias("value"),
        F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.col("id").alias("offset"),
        F.current_timestamp().alias("timestamp"))
    return df


def transform(batch):
    return ingest.decode_value(batch).select(F.col("key").cast("bigint").alias("id"),
                                             F.get_json_object("value", "$.k").cast("bigint").alias("k"))


def test_stream_delivers_everything_once_per_batch(spark, tmpdir_fresh):
    src, out, counts, ckpt = (os.path.join(tmpdir_fresh, x) for x in ["in", "out", "counts", "ckpt"])
    ingest.write_records(records(spark, 500), src, n_files=5)
    fn = ingest.idempotent_batch_writer(transform, out, "s", counts)
    ingest.ingest_available(spark, ingest.file_stream(spark, src, files_per_trigger=2), fn, ckpt)
    back = spark.read.parquet(out)
    assert back.count() == 500 and back.select("id").distinct().count() == 500
    c = spark.read.parquet(counts).agg(F.sum("read_count"), F.sum("write_count"), F.count("*")).first()
    assert (c[0], c[1], c[2]) == (500, 500, 3)


def test_replaying_a_batch_leaves_output_unchanged(spark, tmpdir_fresh):
    src, out = os.path.join(tmpdir_fresh, "in"), os.path.join(tmpdir_fresh, "out")
    ingest.write_records(records(spark, 100), src, n_files=2)
    batch = spark.read.schema(schemas.STREAM_RECORD).parquet(src)
    fn = ingest.idempotent_batch_writer(transform, out, "s")
    fn(batch, 0)
    first = sorted(tuple(r) for r in spark.read.parquet(out).collect())
    fn(batch, 0)  # redelivered after a crash before the offsets were committed
    assert sorted(tuple(r) for r in spark.read.parquet(out).collect()) == first


def test_restart_resumes_after_committed_batches(spark, tmpdir_fresh):
    src, out, ckpt = (os.path.join(tmpdir_fresh, x) for x in ["in", "out", "ckpt"])
    ingest.write_records(records(spark, 60), src, n_files=2)
    fn = ingest.idempotent_batch_writer(transform, out, "s")
    ingest.ingest_available(spark, ingest.file_stream(spark, src), fn, ckpt)
    ingest.ingest_available(spark, ingest.file_stream(spark, src), fn, ckpt)  # nothing new
    assert spark.read.parquet(out).count() == 60


def test_streams_do_not_erase_each_other(spark, tmpdir_fresh):
    src, out, one, two = (os.path.join(tmpdir_fresh, x) for x in ["in", "out", "one", "two"])
    ingest.write_records(records(spark, 20), src, n_files=1)
    ingest.ingest_available(spark, ingest.file_stream(spark, src), ingest.idempotent_batch_writer(transform, out, "a"), one)
    with pytest.raises(ValueError):  # a new checkpoint would start at batch 0 again
        ingest.ingest_available(spark, ingest.file_stream(spark, src), ingest.idempotent_batch_writer(transform, out, "a"), two)
    ingest.ingest_available(spark, ingest.file_stream(spark, src), ingest.idempotent_batch_writer(transform, out, "b"), two)
    assert spark.read.parquet(out).count() == 40


def test_replay_replaces_every_partition_of_its_batch(spark, tmpdir_fresh):
    out = os.path.join(tmpdir_fresh, "out")
    ingest.write_records(records(spark, 2), os.path.join(tmpdir_fresh, "in"), n_files=1)
    batch = spark.read.schema(schemas.STREAM_RECORD).parquet(os.path.join(tmpdir_fresh, "in"))
    for limit in (1, 5):  # the second attempt, with other code, sends every row to one verdict
        fn = ingest.idempotent_batch_writer(lambda b, limit=limit: transform(b).withColumn(
            "verdict", F.when(F.col("id") < limit, "accepted").otherwise("rejected")), out, "s", partition_by=("verdict",))
        fn(batch, 0)
    assert [(r.id, r.verdict) for r in spark.read.parquet(out).orderBy("id").collect()] == [(0, "accepted"), (1, "accepted")]


def test_timeout_stops_the_stream(spark, tmpdir_fresh):
    src = os.path.join(tmpdir_fresh, "in")
    ingest.write_records(records(spark, 5), src, n_files=1)
    with pytest.raises(TimeoutError):
        ingest.ingest_available(spark, ingest.file_stream(spark, src), lambda b, i: time.sleep(8),
                                os.path.join(tmpdir_fresh, "ckpt"), timeout_s=1)
    assert not spark.streams.active


def test_kafka_options():
    src = ingest.kafka_source_options("b:9092", "topic")
    assert src["maxOffsetsPerTrigger"] == "9000" and src["minPartitions"] == "3"
    assert src["startingOffsets"] == "latest" and src["failOnDataLoss"] == "true"
    sink = ingest.kafka_sink_options("b:9092", "topic")
    assert sink["kafka.retries"] == "3" and sink["topic"] == "topic"


def test_kafka_records_shape(spark):
    df = spark.createDataFrame([(1, "a", None)], "id long, name string, note string")
    r = ingest.to_kafka_records(df, "id").first()
    assert bytes(r.key) == b"1" and bytes(r.value) == b'{"id":1,"name":"a"}'
