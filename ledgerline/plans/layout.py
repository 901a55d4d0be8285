"""Input layout checks for plans that only scan; a plan with a shuffle would
run its stages here under adaptive execution."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin ``df`` over at least ``min_partitions`` (default: the
    cluster's default parallelism) when its scan yields fewer splits.

    A large input already has thousands of splits, so this is a no-op there.
    It matters for a small file written as one row group, which Parquet
    cannot split: CPU-heavy per-row work (JSON, regex) would run in one task.
    """
    try:
        want = min_partitions or df.sparkSession.sparkContext.defaultParallelism
        have = df.rdd.getNumPartitions()
    except Exception:  # no RDD view of the plan (e.g. Spark Connect): leave the layout alone
        return df
    return df.repartition(want) if have < want else df
