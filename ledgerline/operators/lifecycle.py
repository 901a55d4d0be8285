"""L1-L5: fold a change log into an entity snapshot; L6: identity keys.

Change log: ``(id, event_id, ts, op, description)``, op one of CREATE,
UPDATE, DELETE, RESTORE. Order within an id is ``(ts, event_id)``.

Semantics, per id:
* an UPDATE with a blank description is rejected (L3) and changes nothing;
* CREATE stamps created_at (L1); created_at never moves;
* a change is *effective* when it changes state: CREATE always; UPDATE when
  its description differs from the previous value; DELETE when the previous
  mark is RESTORE or there is none (soft delete is idempotent, a second
  DELETE keeps the first time, L4); RESTORE when the previous mark is DELETE
  (restoring a live row is a no-op, L5);
* updated_at is the time of the last effective change (L2);
* deleted_at is the time of the last effective mark if it is a DELETE;
* description is the last accepted value.

Scale. A per-id window would put an id holding a third of the log into one
task. Instead the "previous element" is found in two levels:
1. ``lag`` inside ``(id, kind, bucket)`` windows, where ``bucket`` is a time
   slice of ``grain_seconds`` (order preserving, so an id spreads over as
   many tasks as it has slices);
2. the first row of each slice takes the last value of the id's previous
   slice from a per-slice summary (one row per slice, tiny next to the log).
A log with bursts (many changes of one id within a slice) is folded with
``max_slice_rows``: the changes of every (id, slice) with more rows are dealt by
Spark's range partitioner on ``(id, slice, ts, event_id)`` into written ranges of about
that many rows, and each range is a slice of its own, so slices are bounded
by count however dense the log is. It costs a count of the rows of each slice.

The final per-id aggregate is partial-aggregated before its shuffle. The log
itself is shuffled once.

The per-id aggregate keeps a string (the last description), so Spark
aggregates by sorting each partition locally instead of hashing. Taking the
description from the slice heads and joining it instead was tried: column
pruning then gives that branch its own, second shuffle and window sort of the
log, which costs more than the local sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.text import is_blank
from ledgerline.functions.timefmt import time_slice
from ledgerline.session import scratch_path

MARKS = ["DELETE", "RESTORE"]
DEFAULT_GRAIN_SECONDS = 3600


def blank_update(op: Column, description: Column) -> Column:
    return (op == "UPDATE") & F.coalesce(is_blank(description), F.lit(True))


def rejected_changes(changes: DataFrame) -> DataFrame:
    """L3 rejects: UPDATEs whose description is blank, with their error."""
    return changes.where(blank_update(F.col("op"), F.col("description"))).withColumns(
        {"error_type": F.lit("BAD_REQUEST"), "message": F.lit("Description must not be blank.")})


def _cut_bursts(rows: DataFrame, max_slice_rows: int, max_broadcast: int = 1_000_000) -> DataFrame:
    """``rows`` with ``bucket`` cut into parts (bucket, part) where one id has
    more than about ``max_slice_rows`` rows in it; other buckets have one part."""
    spark, group = rows.sparkSession, ["id", "bucket"]
    path = scratch_path(spark, "bursts")
    rows.groupBy(*group).count().where(F.col("count") > max_slice_rows).write.parquet(path)
    bursts = spark.read.parquet(path)
    n, total = bursts.agg(F.count(F.lit(1)), F.sum("count")).first()
    if not n:
        return rows
    # Above the bound both joins shuffle, and AQE splits the crowded groups.
    keep = bursts.select(*group)
    keep = F.broadcast(keep) if n <= max_broadcast else keep.hint("merge")

    def part(df: DataFrame, c: Column) -> DataFrame:
        return df.withColumn("bucket", F.struct("bucket", c.alias("part")))

    path = scratch_path(spark, "ranges")
    part(rows.join(keep, group, "left_semi").repartitionByRange(-(-total // max_slice_rows), *group, "ts", "event_id"),
         F.spark_partition_id()).write.parquet(path)
    return part(rows.join(keep, group, "left_anti"), F.lit(0)).unionByName(spark.read.parquet(path))


def _with_effective(changes: DataFrame, grain_seconds: int, prior: DataFrame | None,
                    max_slice_rows: int | None = None) -> DataFrame:
    """Accepted changes with ``kind``, ``x`` (the compared value) and ``effective``.

    ``prior`` (id, prev_value, prev_mark) seeds the first slice of each id
    (incremental fold); without it an id starts with no previous element.
    """
    op = F.col("op")
    rows = changes.where(~blank_update(op, F.col("description"))).select(
        "id", "event_id", "ts", "op",
        F.when(op.isin(MARKS), F.lit("mark")).otherwise(F.lit("value")).alias("kind"),
        F.when(op.isin(MARKS), op).otherwise(F.col("description")).alias("x"),
        time_slice(F.col("ts"), grain_seconds).alias("bucket"),
    )
    if max_slice_rows:
        rows = _cut_bursts(rows, max_slice_rows)
    in_slice = Window.partitionBy("id", "kind", "bucket").orderBy("ts", "event_id")
    whole_slice = in_slice.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.withColumns({"lag_x": F.lag("x").over(in_slice),
                             "first_in_slice": F.lag("event_id").over(in_slice).isNull(),
                             "last_x": F.last("x").over(whole_slice)})
    cols = ["id", "event_id", "ts", "op", "kind", "x"]

    # Rows after the first of their slice: the previous element is in the slice.
    inner = rows.where(~F.col("first_in_slice")).select(
        *cols, F.col("lag_x").alias("prev"), F.lit(True).alias("has_prev"))

    # The first row of each slice (one per slice, few next to the log) takes
    # the last value of the id's previous slice. Both branches read the same
    # shuffle of the log.
    heads = rows.where("first_in_slice").select(*cols, "bucket", "last_x")
    across = Window.partitionBy("id", "kind").orderBy("bucket")
    heads = heads.withColumns({"prev": F.lag("last_x").over(across),
                               "has_prev": F.lag("bucket").over(across).isNotNull()})
    if prior is not None:
        seed = prior.select("id", F.col("prev_value"), F.col("prev_mark"))
        heads = heads.join(seed, "id", "left").withColumns({
            "prev": F.when(F.col("has_prev"), F.col("prev"))
                     .when(F.col("kind") == "mark", F.col("prev_mark"))
                     .otherwise(F.col("prev_value")),
            "has_prev": F.col("has_prev") | F.col("prev_mark").isNotNull(),
        })
    rows = inner.unionByName(heads.select(*cols, "prev", "has_prev"))

    prev, has_prev = F.col("prev"), F.col("has_prev")
    x = F.col("x")
    effective = (
        F.when(op == "CREATE", F.lit(True))
        .when(op == "UPDATE", ~has_prev | ~x.eqNullSafe(prev))
        .when(op == "DELETE", ~has_prev | (prev == "RESTORE"))
        .when(op == "RESTORE", has_prev & (prev == "DELETE"))
        .otherwise(F.lit(False))
    )
    return rows.select("id", "event_id", "ts", "op", "kind", "x", effective.alias("effective"))


def _summarise(rows: DataFrame) -> DataFrame:
    k = F.struct("ts", "event_id")
    is_value = F.col("kind") == "value"
    eff_mark = (F.col("kind") == "mark") & F.col("effective")
    agg = rows.groupBy("id").agg(
        F.min(F.when(F.col("op") == "CREATE", F.col("ts"))).alias("created_at"),
        F.min("ts").alias("first_ts"),
        F.max(F.when(F.col("effective"), F.col("ts"))).alias("updated_at"),
        F.max_by(F.when(is_value, F.col("x")), F.when(is_value, k)).alias("description"),
        F.max_by(F.when(eff_mark, F.col("op")), F.when(eff_mark, k)).alias("last_mark"),
        F.max(F.when(eff_mark, F.col("ts"))).alias("last_mark_ts"),
        F.bool_or(F.col("op") == "CREATE").alias("has_create"),
        F.bool_or(is_value).alias("has_value"),
    )
    return agg.select(
        "id", "description",
        F.coalesce("created_at", "first_ts").alias("created_at"),
        "updated_at",
        F.when(F.col("last_mark") == "DELETE", F.col("last_mark_ts")).alias("deleted_at"),
        "last_mark", "has_create", "has_value",
    )


def fold(changes: DataFrame, grain_seconds: int = DEFAULT_GRAIN_SECONDS, resumable: bool = False,
         max_slice_rows: int | None = None) -> DataFrame:
    """Snapshot ``(id, description, created_at, updated_at, deleted_at)``.

    ``resumable`` adds ``has_create``: whether created_at is a CREATE's time or
    only the first change's, which a later CREATE replaces. The incremental
    fold needs it for logs in which an id's first change is not a CREATE.
    ``max_slice_rows`` (a million is a fair choice): see above."""
    out = _summarise(_with_effective(changes, grain_seconds, None, max_slice_rows)).drop("last_mark", "has_value")
    return out if resumable else out.drop("has_create")


def _few_ids(changes: DataFrame, most: int) -> bool:
    """Whether about ``most`` ids or fewer change: one sketch per task, a few per cent off."""
    return most > 0 and changes.agg(F.approx_count_distinct("id")).first()[0] <= most


def fold_incremental(snapshot: DataFrame, changes: DataFrame,
                     grain_seconds: int = DEFAULT_GRAIN_SECONDS, max_broadcast_ids: int = 1_000_000,
                     max_slice_rows: int | None = None) -> DataFrame:
    """Apply a slice of later changes to an existing snapshot.

    The snapshot seeds each id's previous value and mark; ids untouched by
    the slice pass through. Equal to the fold of the whole log for a snapshot
    of ``fold(resumable=True)``; one without ``has_create`` is taken to be made
    from CREATEs. When the slice touches about ``max_broadcast_ids`` ids or
    fewer (checked), those ids are broadcast and the
    snapshot is split into touched and untouched rows while it is scanned, so
    the snapshot is never shuffled and only the touched rows are merged.
    Otherwise the whole snapshot is merged with a shuffle join on id.
    Changes older than the snapshot need :func:`apply_late_changes` instead.
    """
    ids = changes.select("id").distinct()
    if _few_ids(changes, max_broadcast_ids):
        keep = F.broadcast(ids)
        untouched = snapshot.join(keep, "id", "left_anti")
        touched = snapshot.join(keep, "id", "left_semi")
        return untouched.unionByName(_merge(touched, changes, grain_seconds, max_slice_rows).select(*untouched.columns))
    return _merge(snapshot, changes, grain_seconds, max_slice_rows)


def _merge(snapshot: DataFrame, changes: DataFrame, grain_seconds: int, max_slice_rows: int | None = None) -> DataFrame:
    prior = snapshot.select(
        "id",
        F.col("description").alias("prev_value"),
        F.when(F.col("deleted_at").isNotNull(), F.lit("DELETE")).otherwise(F.lit("RESTORE")).alias("prev_mark"),
    )
    delta = _summarise(_with_effective(changes, grain_seconds, prior, max_slice_rows))
    state = "has_create" in snapshot.columns
    if not state:
        snapshot = snapshot.withColumn("has_create", F.lit(True))
    s, d = snapshot.alias("s"), delta.alias("d")
    merged = s.join(d, "id", "full_outer")
    before, now = (F.coalesce(F.col(f"{side}.has_create"), F.lit(False)) for side in "sd")
    out = merged.select(
        "id",
        F.when(F.col("d.has_value"), F.col("d.description")).otherwise(F.col("s.description")).alias("description"),
        F.when(now & ~before, F.col("d.created_at"))
        .otherwise(F.coalesce(F.col("s.created_at"), F.col("d.created_at"))).alias("created_at"),
        F.greatest(F.col("s.updated_at"), F.col("d.updated_at")).alias("updated_at"),
        F.when(F.col("d.last_mark").isNotNull(), F.col("d.deleted_at")).otherwise(F.col("s.deleted_at"))
        .alias("deleted_at"),
        (before | now).alias("has_create"),
    )
    return out if state else out.drop("has_create")


def apply_late_changes(snapshot: DataFrame, log: DataFrame, late: DataFrame,
                       grain_seconds: int = DEFAULT_GRAIN_SECONDS, max_broadcast_ids: int = 1_000_000,
                       max_slice_rows: int | None = None) -> DataFrame:
    """Changes older than the snapshot cannot be applied on top of it: re-fold
    the affected ids from their whole history (``log`` plus ``late``) and
    swap them into the snapshot. Untouched ids are carried over as they are.

    The affected id set is broadcast to filter the log while it is scanned
    when it has about ``max_broadcast_ids`` ids or fewer (checked); otherwise the
    semi and anti joins shuffle on id.
    """
    ids = late.select("id").distinct()
    keep = F.broadcast(ids) if _few_ids(late, max_broadcast_ids) else ids
    history = log.unionByName(late).join(keep, "id", "left_semi")
    refolded = fold(history, grain_seconds, "has_create" in snapshot.columns, max_slice_rows)
    return snapshot.join(keep, "id", "left_anti").unionByName(refolded.select(*snapshot.columns))
