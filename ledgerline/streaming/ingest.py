"""S2, S3, S4, B4: at-least-once micro-batch ingestion and Kafka shaping.

Consumption (S2) is a Structured Streaming source; delivery (S3) is
``foreachBatch`` with a checkpoint: offsets are committed only after the
batch function returns, so a crash redelivers the batch (at-least-once), and
the batch function writes idempotently, keyed by stream and ``batch_id``, so
a redelivered batch replaces its own output instead of duplicating it.

No Kafka connector ships with this PySpark install, so the tests drive the
same code with a Parquet file stream carrying the Kafka record schema
(``key, value, topic, partition, offset, timestamp``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerline import schemas
from ledgerline.operators.jsonio import encode

# Consumer settings (records per poll and consumers per group)
# and the producer's retry count.
RECORDS_PER_POLL = 3000
CONSUMERS = 3
PRODUCER_RETRIES = 3


def waiting_options(least_records: int, longest_wait: str = "5 seconds") -> dict[str, str]:
    """Overrides for :func:`kafka_source_options`: a batch waits for
    ``least_records``, but no longer than ``longest_wait``."""
    return {"minOffsetsPerTrigger": str(least_records), "maxTriggerDelay": longest_wait}


def kafka_source_options(bootstrap_servers: str, topic: str, **overrides: str) -> dict[str, str]:
    """Options for ``spark.readStream.format("kafka")``.

    A trigger takes at most what all consumers would poll together; the topic
    is read by at least as many tasks as there were consumers; reading starts
    at the latest offset on first start (the checkpoint rules afterwards), and
    missing data fails the query instead of being skipped.

    The defaults mirror the service's consumer settings. At cluster scale pass
    larger ``maxOffsetsPerTrigger`` / ``minPartitions`` as overrides: a trigger
    should carry enough records to keep every executor core busy.
    """
    return {
        "kafka.bootstrap.servers": bootstrap_servers,
        "subscribe": topic,
        "startingOffsets": "latest",
        "maxOffsetsPerTrigger": str(RECORDS_PER_POLL * CONSUMERS),
        "minPartitions": str(CONSUMERS),
        "failOnDataLoss": "true",
        **{k: str(v) for k, v in overrides.items()},
    }


def kafka_sink_options(bootstrap_servers: str, topic: str) -> dict[str, str]:
    """Options for ``df.write.format("kafka")`` (string key, JSON value)."""
    return {
        "kafka.bootstrap.servers": bootstrap_servers,
        "topic": topic,
        "kafka.retries": str(PRODUCER_RETRIES),
        "kafka.acks": "all",
    }


def read_kafka(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    return spark.readStream.format("kafka").options(**options).load()


def to_kafka_records(df: DataFrame, key: str, value_columns: list[str] | None = None,
                     as_binary: bool = True) -> DataFrame:
    """S4: rows -> (key, value) with the key as text and the value as J2 JSON
    (nulls omitted, plain decimals, no type headers)."""
    encoded = encode(df, value_columns, alias="_json")
    k = F.col(key).cast("string")
    v = F.col("_json")
    if as_binary:
        k, v = k.cast("binary"), v.cast("binary")
    return encoded.select(k.alias("key"), v.alias("value"))


def publish(df: DataFrame, key: str, options: dict[str, str], value_columns: list[str] | None = None) -> None:
    """S4: write rows to Kafka as (text key, J2 JSON value), no type headers.
    ``options`` from :func:`kafka_sink_options`. Needs the Kafka connector on
    the classpath (absent from this install, so untested here)."""
    to_kafka_records(df, key, value_columns).write.format("kafka").options(**options).save()


def decode_value(records: DataFrame) -> DataFrame:
    """Key and value bytes as UTF-8 text."""
    return records.withColumns({"key": F.col("key").cast("string"), "value": F.col("value").cast("string")})


BatchFn = Callable[[DataFrame, int], None]


def stream_path(out_path: str, stream: str) -> str:
    """Where ``stream`` writes below ``out_path``: no other stream's output is there."""
    return f"{out_path.rstrip('/')}/stream={stream}"


def idempotent_batch_writer(transform: Callable[[DataFrame], DataFrame], out_path: str, stream: str,
                            counts_path: str | None = None, partition_by: tuple[str, ...] = ()) -> BatchFn:
    """A ``foreachBatch`` function: ``transform`` the batch and overwrite the
    whole folder ``stream=<name>/batch_id=<id>`` of the output. A replayed
    batch replaces all of its own output, in every partition below it, and
    nothing else. ``stream`` names one checkpoint's output.

    With ``counts_path`` (B4) the counts observed during the same pass are
    recorded per batch: rows read, rows written, and, if the output has an
    ``accepted`` column, how many of them were accepted and rejected.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        folder = f"batch_id={batch_id}"
        if counts_path is None:
            out = transform(batch)
        else:
            seen, kept = Observation(f"read_{batch_id}"), Observation(f"written_{batch_id}")
            out = transform(batch.observe(seen, F.count(F.lit(1)).alias("n")))
            accepted = F.count_if("accepted") if "accepted" in out.columns else F.count(F.lit(1))
            out = out.observe(kept, F.count(F.lit(1)).alias("n"), accepted.alias("accepted"))
        out.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*partition_by).parquet(
            f"{stream_path(out_path, stream)}/{folder}")
        if counts_path is not None:
            n, ok = kept.get.get("n", 0), kept.get.get("accepted", 0)
            counts = batch.sparkSession.createDataFrame(
                [(seen.get.get("n", 0), n, ok, n - ok)],
                "read_count bigint, write_count bigint, accepted_count bigint, rejected_count bigint")
            counts.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(
                f"{stream_path(counts_path, stream)}/{folder}")

    run.output = stream_path(out_path, stream)
    return run


def _exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def ingest_available(spark: SparkSession, source: DataFrame, batch_fn: BatchFn, checkpoint: str,
                     timeout_s: float | None = None) -> None:
    """Run a streaming source through ``batch_fn`` until all available input
    is consumed (``availableNow``), then stop. Restarting with the same
    checkpoint resumes after the last committed batch. A new checkpoint would
    number its batches from 0 again, so it is refused where the stream's
    output already exists. Past ``timeout_s`` the stream is stopped and
    ``TimeoutError`` raised; a later call resumes."""
    _refuse_restart(spark, batch_fn, checkpoint)
    q = (source.writeStream.foreachBatch(batch_fn).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    finished = q.awaitTermination(timeout_s) if timeout_s is not None else (q.awaitTermination() or True)
    if q.exception() is not None:
        raise q.exception()
    if not finished:
        q.stop()
        raise TimeoutError(f"the stream did not finish in {timeout_s} s")


def _refuse_restart(spark: SparkSession, batch_fn: BatchFn, checkpoint: str) -> None:
    output = getattr(batch_fn, "output", None)
    if output and _exists(spark, output) and not _exists(spark, checkpoint):
        raise ValueError(f"{output} holds another checkpoint's batches; name a new stream")


def ingest_continuously(spark: SparkSession, source: DataFrame, batch_fn: BatchFn, checkpoint: str,
                        every: str = "5 seconds"):
    """Start a running stream with a micro-batch every ``every`` (the longest
    wait for a batch); returns the query. This is the mode for a source that
    starts at its latest offsets."""
    _refuse_restart(spark, batch_fn, checkpoint)
    return (source.writeStream.foreachBatch(batch_fn).option("checkpointLocation", checkpoint)
            .trigger(processingTime=every).start())


def catch_up(query) -> int:
    """Let a running stream take all that has arrived, then stop it; returns
    the id of its last batch that had rows (-1: none). A later start with the
    same checkpoint goes on after that batch."""
    try:
        query.processAllAvailable()
        batches = [p["batchId"] for p in query.recentProgress if p["numInputRows"]]
    finally:
        query.stop()
    return max(batches, default=-1)


class FailOnce:
    """A batch function that writes batch ``batch_id`` and then fails, once:
    the crash between writing and committing after which a batch is delivered
    again. Every delivery is appended to ``log_path`` (batch_id)."""

    def __init__(self, batch_fn: BatchFn, batch_id: int, log_path: str):
        self.batch_fn, self.batch_id, self.log_path, self.failed = batch_fn, batch_id, log_path, False
        self.output = getattr(batch_fn, "output", None)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        self.batch_fn(batch, batch_id)
        batch.sparkSession.createDataFrame([(batch_id,)], "batch_id bigint").write.mode("append").parquet(self.log_path)
        if batch_id == self.batch_id and not self.failed:
            self.failed = True
            raise RuntimeError(f"stopped after writing batch {batch_id}, before its commit")


def ingest_through_failure(spark: SparkSession, source: Callable[[], DataFrame], batch_fn: FailOnce, checkpoint: str) -> None:
    """Consume everything available through ``batch_fn``; after its failure
    start again from the checkpoint, as a supervisor would."""
    try:
        ingest_available(spark, source(), batch_fn, checkpoint)
    except Exception:
        if not batch_fn.failed:
            raise
        ingest_available(spark, source(), batch_fn, checkpoint)


def audit_offsets(records: DataFrame) -> DataFrame:
    """S3: per (topic, partition) of delivered records: how many there are,
    their first and last offset, how many offsets between those are missing
    (``gaps``) and how many records repeat one (``repeats``). Offsets are made
    distinct across tasks first, so a hot partition is no hot task."""
    each = records.groupBy("topic", "partition", "offset").agg(F.count(F.lit(1)).alias("n"))
    found = each.groupBy("topic", "partition").agg(
        F.sum("n").alias("n_records"), F.min("offset").alias("first_offset"), F.max("offset").alias("last_offset"),
        F.count(F.lit(1)).alias("distinct"))
    return found.select("topic", "partition", "n_records", "first_offset", "last_offset",
                        (F.col("last_offset") - F.col("first_offset") + 1 - F.col("distinct")).alias("gaps"),
                        (F.col("n_records") - F.col("distinct")).alias("repeats"))


def redelivered(log: DataFrame) -> DataFrame:
    """S3: (batch_id, deliveries) of the batches delivered more than once."""
    return log.groupBy("batch_id").agg(F.count(F.lit(1)).alias("deliveries")).filter("deliveries > 1")


def file_stream(spark: SparkSession, path: str, files_per_trigger: int = 2) -> DataFrame:
    """Stand-in for the Kafka source: Parquet files with the record schema."""
    return (spark.readStream.schema(schemas.STREAM_RECORD).option("maxFilesPerTrigger", files_per_trigger)
            .parquet(path))


def write_records(records: DataFrame, path: str, n_files: int) -> None:
    """Write stream input as ``n_files`` files (a fixture writer for tests and
    the registered stream jobs)."""
    records.repartition(n_files).write.mode("overwrite").parquet(path)
