"""B1-B4: a date-scoped batch job and accounting over run and step logs."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ledgerline.functions.timefmt import duration_parts, render_local, time_slice
from ledgerline.operators import keys

# Run outcomes.
COMPLETED = "COMPLETED"
FAILED = "FAILED"

DEFAULT_GRAIN_SECONDS = 3600
DEFAULT_CHUNK_ROWS = 1000
DEFAULT_PART_BYTES = 16 << 20
DEFAULT_PART_MESSAGES = 100_000


@dataclass
class JobResult:
    status: str
    rows: DataFrame | None
    message: str | None = None


def date_scope(df: DataFrame, date_col: str, request_date: str | dt.date) -> DataFrame:
    """Rows whose ``date_col`` falls on ``request_date``.

    Stated as a half-open range on the raw column so the predicate reaches
    the Parquet scan (row-group skipping) and prunes date partitions.
    """
    day = dt.date.fromisoformat(str(request_date))
    lo = F.lit(day.isoformat()).cast("timestamp_ntz")
    hi = F.lit((day + dt.timedelta(days=1)).isoformat()).cast("timestamp_ntz")
    c = F.col(date_col)
    return df.where((c >= lo) & (c < hi))


def run_daily(df: DataFrame, date_col: str, request_date: str | dt.date | None,
              columns: list[str] | None = None, out_path: str | None = None,
              run_log_path: str | None = None, job_name: str = "daily") -> JobResult:
    """B1: the job needs ``request_date``; without it, with a text that is no
    date, or when the write raises, the run FAILS and says why.

    With ``out_path`` the slice is written with dynamic partition overwrite,
    so re-running a date replaces only that date; the rows written are
    counted during the write (B4). With ``run_log_path`` the run appends one
    row (run_id, job_name, start_ms, end_ms, status, request_date,
    write_count) that B2 and B3 read, whatever its outcome. Without ``out_path``
    nothing is run here: COMPLETED then only says that the slice is defined. Only written rows are observed: an
    observation on the scan would stop the date filter reaching the reader.
    """
    import time
    import uuid

    start_ms = int(time.time() * 1000)
    write_count = None
    if request_date is None:
        result = JobResult(FAILED, None, "Required job parameter 'requestDate' is missing.")
    else:
        try:
            rows = date_scope(df, date_col, request_date)
            if columns:
                rows = rows.select(*columns)
            if out_path is not None:
                observed, obs = observe_counts(rows.withColumn("request_date", F.lit(str(request_date))), "written",
                                               metric="write_count")
                (observed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                 .partitionBy("request_date").parquet(out_path))
                write_count = obs.get.get("write_count", 0)
            result = JobResult(COMPLETED, rows)
        except Exception as error:  # the outcome of a run, not swallowed: in the result and the run log
            result = JobResult(FAILED, None, f"{type(error).__name__}: {error}")
    if run_log_path is not None:
        end_ms = int(time.time() * 1000)
        row = [(uuid.uuid4().int >> 65, job_name, start_ms, end_ms, result.status,
                None if request_date is None else str(request_date), write_count)]
        (df.sparkSession.createDataFrame(
            row, "run_id bigint, job_name string, start_ms bigint, end_ms bigint, status string, request_date string, "
                 "write_count bigint")
         .write.mode("append").parquet(run_log_path))
    return result


def run_durations(runs: DataFrame) -> DataFrame:
    """B2: local start/end (service zone), total ms and h/m/s parts."""
    total = (F.col("end_ms") - F.col("start_ms")).cast("bigint")
    parts = duration_parts(total)
    return runs.select(
        "run_id", "job_name",
        render_local(F.col("start_ms")).alias("start_local"),
        render_local(F.col("end_ms")).alias("end_local"),
        total.alias("total_ms"),
        parts["hours"].alias("hours"), parts["minutes"].alias("minutes"), parts["seconds"].alias("seconds"),
    )


def step_status(steps: DataFrame, grain_seconds: int = DEFAULT_GRAIN_SECONDS) -> DataFrame:
    """B3: per step, FAILED if any row failed, with the failures' non-null
    messages joined by newline in (ts, event_id) order; else COMPLETED.

    Two levels so a step holding a large share of the log is not sorted in
    one task: messages are ordered and joined per (step, time slice), then
    the slices' texts are joined in slice order. Only failed rows with a
    message travel past the first aggregation.
    """
    part = step_failure_texts(steps, grain_seconds).select(
        "step_id", F.col("slice").alias("_slice"), F.col("text").alias("_text"))
    texts = part.groupBy("step_id").agg(
        F.array_join(F.sort_array(F.collect_list(F.struct("_slice", "_text")))["_text"], "\n").alias("messages"))
    counts = steps.groupBy("step_id").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("failed")).alias("n_failures"),
    )
    out = counts.join(texts, "step_id", "left")
    return out.select(
        "step_id", "n_rows", "n_failures",
        F.when(F.col("n_failures") > 0, F.lit(FAILED)).otherwise(F.lit(COMPLETED)).alias("status"),
        F.coalesce(F.col("messages"), F.lit("")).alias("messages"),
    )


def step_failure_texts(steps: DataFrame, grain_seconds: int = DEFAULT_GRAIN_SECONDS) -> DataFrame:
    """B3 without the final join: one row per (step, time slice) with that
    slice's failure messages in order. Each row is bounded by the slice, so
    this is the form to keep when a step's failures are too many for one
    value (Spark values are limited to 2 GB); ordering by (step_id, slice)
    and concatenating gives ``step_status``'s ``messages``."""
    failed = steps.where(F.col("failed") & F.col("message").isNotNull())
    return failed.groupBy("step_id", time_slice(F.col("ts"), grain_seconds).alias("slice")).agg(
        F.count(F.lit(1)).alias("n_messages"),
        F.array_join(F.sort_array(F.collect_list(F.struct("ts", "event_id", "message")))["message"], "\n")
        .alias("text"))


def observe_counts(df: DataFrame, name: str = "chunk", metric: str = "read_count") -> tuple[DataFrame, Observation]:
    """B4: row count of a batch, collected as a side effect of the action
    that consumes ``df`` (no second pass); ``obs.get[metric]`` after it."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias(metric)), obs


def chunk_log(df: DataFrame, order_by: list[str], written: Column, rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """B4 per chunk: ``df`` in chunks of ``rows`` rows in ``order_by`` order
    (the last may be shorter), one row a chunk: ``chunk`` (from 0),
    ``read_count`` and ``write_count``, the rows that ``written`` holds for.

    Rows are numbered in parallel (ranges and offsets), so no task sees more
    than its range; the counts are partial aggregates."""
    marked = df.withColumn("_written", F.coalesce(written, F.lit(False))).select(*order_by, "_written")
    numbered = keys.assign_ids(marked, order_by, -1, "_n")
    return numbered.groupBy(F.expr(f"_n div {int(rows)}").alias("chunk")).agg(
        F.count(F.lit(1)).alias("read_count"), F.count_if("_written").alias("write_count"))


def step_parts(steps: DataFrame, max_bytes: int = DEFAULT_PART_BYTES, max_messages: int = DEFAULT_PART_MESSAGES) -> DataFrame:
    """B3 bounded by size: each step's failure messages in (ts, event_id)
    order, cut into numbered parts by running bytes, whatever share of the log
    one step or one hour holds. (step_id, part, n_messages, text): a part has
    at most ``max_bytes`` and one more message, and at most ``max_messages``
    (and one more); numbers ascend, with gaps after messages longer than a
    part. Concatenated by newline in their order they are ``step_status``'s
    ``messages``.

    The log is read once. A message weighs its bytes and line end, but at
    least its share of a part, and the weights before it are added up in
    parallel; only parts are grouped."""
    failed = steps.where(F.col("failed") & F.col("message").isNotNull()).select("step_id", "ts", "event_id", "message")
    least = -(-max_bytes // max_messages)
    weighed = failed.withColumn("_weight", F.greatest(F.octet_length("message") + 1, F.lit(least)).cast("bigint"))
    placed = keys.running_totals(weighed, ["step_id", "ts", "event_id"], "_weight", "_at")
    first = placed.groupBy("step_id").agg(F.min("_at").alias("_first"))
    placed = placed.join(first, "step_id").withColumn("part", F.expr(f"(_at - _first) div {int(max_bytes)}"))
    return placed.groupBy("step_id", "part").agg(
        F.count(F.lit(1)).alias("n_messages"),
        F.array_join(F.sort_array(F.collect_list(F.struct("ts", "event_id", "message")))["message"], "\n").alias("text"))
