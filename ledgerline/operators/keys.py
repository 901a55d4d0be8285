"""L6: dense identity keys for appended rows, assigned in parallel.

``id = start + rank`` where rank is the row's 1-based position in a total
order. A global ``row_number()`` would sort everything in one task and
``monotonically_increasing_id()`` leaves gaps that depend on partitioning, so:

1. Spark's range partitioner deals the rows by all ordering columns, with the
   row's place in its input as the last one, so that neither a hot leading
   key nor rows that tie in every column pile up in one range. Any orderable
   type will do; nulls come first. The ranged rows are written to the
   shared checkpoint folder, which fixes the ranges for every later step and
   retry;
2. rows per range are counted and turned into offsets by a window over one
   row per range;
3. ``row_number()`` inside each range.

Rows that tie in all ordering columns get neighbouring ids in any order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.session import scratch_path

DEFAULT_ROWS_PER_RANGE = 4_000_000


def _ranged(df: DataFrame, order_by: list[str], rows_per_range: int) -> tuple[DataFrame, list[str]]:
    """``df`` dealt to written ranges (``_range``) of about ``rows_per_range``, and the columns that order all rows."""
    n_ranges = max(1, -(-df.count() // rows_per_range))
    order = [*order_by, "_place"]
    path = scratch_path(df.sparkSession, "ranged")
    placed = df.withColumn("_place", F.monotonically_increasing_id())
    placed.repartitionByRange(n_ranges, *order).withColumn("_range", F.spark_partition_id()).write.parquet(path)
    return df.sparkSession.read.parquet(path), order


def running_totals(df: DataFrame, order_by: list[str], weight: str, out: str,
                   rows_per_range: int = DEFAULT_ROWS_PER_RANGE) -> DataFrame:
    """Add ``out``, the sum of ``weight`` over all rows before this one in
    ``order_by`` order, in parallel as ``assign_ids`` numbers them."""
    ranged, order = _ranged(df, order_by, rows_per_range)
    sums = ranged.groupBy("_range").agg(F.sum(weight).alias("_sum"))  # one row per range
    offsets = sums.select("_range", F.coalesce(F.sum("_sum").over(
        Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    within = F.coalesce(F.sum(weight).over(Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    summed = ranged.join(F.broadcast(offsets), "_range").withColumn(out, (F.col("_before") + within).cast("bigint"))
    return summed.drop("_range", "_before", "_place")


def assign_ids(df: DataFrame, order_by: list[str], start: int, id_col: str = "id",
               rows_per_range: int = DEFAULT_ROWS_PER_RANGE) -> DataFrame:
    """Add ``id_col`` = ``start`` + 1, 2, ... in ``order_by`` order; every row keeps its place, nulls first."""
    ranged, order = _ranged(df, order_by, rows_per_range)
    # One row per range: rows / rows_per_range of them, a size fixed by the count above.
    counts = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(
        "_range",
        F.coalesce(F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("_before"),
    )
    within = Window.partitionBy("_range").orderBy(*order)
    out = ranged.join(F.broadcast(offsets), "_range").withColumn(
        id_col, (F.lit(start) + F.col("_before") + F.row_number().over(within)).cast("bigint"))
    return out.drop("_range", "_before", "_place")


def max_id(existing: DataFrame, id_col: str = "id") -> int:
    """Largest id in use (0 for an empty table); aggregated on the cluster."""
    return existing.agg(F.coalesce(F.max(id_col), F.lit(0)).cast("bigint")).first()[0]


def next_ids(new_rows: DataFrame, existing: DataFrame, order_by: list[str], id_col: str = "id",
             rows_per_range: int = DEFAULT_ROWS_PER_RANGE) -> DataFrame:
    """Ids for ``new_rows`` continuing after the largest id in ``existing``."""
    return assign_ids(new_rows, order_by, max_id(existing, id_col), id_col, rows_per_range)
