"""M1: cumulative latency histogram tagged with the application name."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Bucket upper bounds (inclusive). The reference enables a histogram without
# naming its bounds, so they are a parameter; this is our default.
DEFAULT_BOUNDS = (1.0, 5.0, 10.0, 25.0, 50.0, 100.0, 250.0)


def bound_name(b: float) -> str:
    return "le_" + (str(int(b)) if float(b).is_integer() else str(b).replace(".", "_"))


def latency_histogram(df: DataFrame, value: str, by: list[str], application: str,
                      bounds: tuple[float, ...] = DEFAULT_BOUNDS, scale: int = 12) -> DataFrame:
    """Per group: ``le_<b>`` = count of values <= b, ``le_inf`` = all values,
    plus count and sum.

    One aggregate with partial aggregation: each task ships one row per
    group, so a group holding most of the data is no hotter than any other.
    Each value is rounded to ``scale`` decimals and summed as DECIMAL(38), so
    the sum does not depend on the order of rows; it is returned as DOUBLE.
    Sums of up to 38 - ``scale`` whole digits fit.
    """
    v = F.col(value)
    aggs = [F.count_if(v <= F.lit(b)).alias(bound_name(b)) for b in sorted(bounds)]
    aggs += [F.count(v).alias("le_inf"), F.count(v).alias("count"),
             F.sum(v.cast(f"decimal(38,{scale})")).cast("double").alias("sum")]
    return df.groupBy(*by).agg(*aggs).withColumn("application", F.lit(application))


def histogram_state(df: DataFrame, value: str, by: list[str], bounds: tuple[float, ...] = DEFAULT_BOUNDS, scale: int = 12) -> DataFrame:
    """M1 in parts: the histogram of some rows as a state that can be stored
    and merged: cumulative counts and ``total``, the exact sum of the values
    rounded to ``scale`` decimals, as DECIMAL(38)."""
    v = F.col(value)
    counts = [F.count_if(v <= F.lit(b)).alias(bound_name(b)) for b in sorted(bounds)]
    return df.groupBy(*by).agg(*counts, F.count(v).alias("count"), F.sum(v.cast(f"decimal(38,{scale})")).alias("total"))


def merge_histograms(states: DataFrame, by: list[str], application: str, bounds: tuple[float, ...] = DEFAULT_BOUNDS) -> DataFrame:
    """The histogram of all rows behind ``states``, which may come from any
    batches, in any order and number; the same columns as ``latency_histogram``."""
    names = [bound_name(b) for b in sorted(bounds)]
    merged = states.groupBy(*by).agg(*[F.sum(n).alias(n) for n in (*names, "count")], F.sum("total").cast("double").alias("sum"))
    return merged.select(*by, *names, F.col("count").alias("le_inf"), "count", "sum", F.lit(application).alias("application"))
