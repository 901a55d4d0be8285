"""L1/L2 guard: rules evaluated against the state that a change meets.

A change that breaks a rule is rejected and leaves the state as it was, so
whether a later change is accepted depends on every verdict before it: a scan
over the changes of an id, not a row filter.

Rules see a bounded state: whether the entity exists, whether it is deleted,
and a class of its value (an int below ``n_classes`` that the caller derives from
the description, or None). Each change is then a map from states to states,
an array with one entry a state, and maps compose. So an id with any share of
the log is scanned in parallel:
1. the changes of an id are cut into runs of at most ``slice_rows``, and
   each run is composed into one map;
2. the runs of an id, now ``slice_rows`` times fewer, are scanned the same
   way, which gives the state at which each run begins;
3. each run is walked from there.
Where no id has more than ``slice_rows`` changes, step 3 alone is left.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.operators.keys import _ranged
from ledgerline.operators.lifecycle import blank_update
from ledgerline.session import scratch_path

DEFAULT_SLICE_ROWS = 1000
DEFAULT_ROWS_PER_RANGE = 200_000  # a range is sorted by one task, and its rows carry a map each


@dataclass(frozen=True)
class State:
    """What a rule may know of an entity before a change."""

    exists: bool
    deleted: bool
    value: int | None


@dataclass(frozen=True)
class Rule:
    """``broken(state)`` is a condition on the columns of a change that meets
    ``state``, and on ``value_class``, the class of its own value; null is not broken."""

    name: str
    message: str
    broken: Callable[[State], Column]


# L3, always the first rule.
NOT_BLANK = Rule("not_blank", "Description must not be blank.", lambda was: blank_update(F.col("op"), F.col("description")))


def _composed(items: Column, n_states: int) -> Column:
    """The map of all steps in ``items``, first to last."""
    same = F.array(*[F.lit(k) for k in range(n_states)])
    return F.aggregate(items, same, lambda m, item: F.transform(m, lambda s: F.get(item["step"], s)))


def _walked(items: Column, start: Column) -> Column:
    """The state that each of ``items`` meets."""
    begin = F.struct(start.alias("now"), F.array().cast("array<int>").alias("met"))
    return F.aggregate(items, begin, lambda a, item: F.struct(
        F.get(item["step"], a["now"]).alias("now"), F.concat(a["met"], F.array(a["now"])).alias("met")))["met"]


def _met(rows: DataFrame, n_states: int, slice_rows: int, rows_per_range: int) -> DataFrame:
    """(id, ord, step, row) -> (row, met): the state that each row meets in ``ord`` order."""
    run = F.sort_array(F.collect_list(F.struct("ord", "step", "row"))).alias("items")
    most = rows.groupBy("id").count().agg(F.max("count")).first()[0] or 0
    if most <= slice_rows:
        runs = rows.groupBy("id").agg(run).withColumn("start", F.lit(0))
    else:
        ranged, _ = _ranged(rows, ["id", "ord"], rows_per_range)
        place = F.row_number().over(Window.partitionBy("_range").orderBy("id", "ord"))
        cut = ranged.withColumn("_run", F.floor((place - 1) / slice_rows))
        path = scratch_path(rows.sparkSession, "runs")
        cut.groupBy("id", "_range", "_run").agg(run).write.parquet(path)
        runs = rows.sparkSession.read.parquet(path)
        key = F.struct("_range", "_run")
        totals = runs.select("id", key.alias("ord"), _composed(F.col("items"), n_states).alias("step"), F.struct("id", "_range", "_run").alias("row"))
        starts = _met(totals, n_states, slice_rows, rows_per_range).select("row.*", F.col("met").alias("start"))
        r, s = runs.alias("r"), starts.alias("s")
        runs = r.join(s, F.col("r.id").eqNullSafe(F.col("s.id")) & (F.col("r._range") == F.col("s._range"))
                      & (F.col("r._run") == F.col("s._run"))).select("items", "start")
    return runs.select(F.inline(F.zip_with("items", _walked(F.col("items"), F.col("start")), lambda item, s: F.struct(
        item["row"].alias("row"), s.alias("met")))))


def guard(changes: DataFrame, rules: Sequence[Rule], value_class: Column, n_classes: int,
          slice_rows: int = DEFAULT_SLICE_ROWS, rows_per_range: int = DEFAULT_ROWS_PER_RANGE) -> DataFrame:
    """``changes`` (id, event_id, ts, op, description) with ``rule`` and ``message``
    of the first broken rule, null where the change is accepted.

    ``fold(guard(...).where("rule IS NULL"))`` is the snapshot. CREATE and UPDATE
    set the value, DELETE and RESTORE the mark; other operations change nothing. A
    ``value_class`` that is null or not in 0 .. ``n_classes`` - 1 is the class None.
    """
    rules = [NOT_BLANK, *rules]
    states = [State(False, False, None)] + [State(True, d, v) for d in (False, True) for v in (*range(n_classes), None)]
    number = {s: k for k, s in enumerate(states)}
    op, cls = F.col("op"), F.col("value_class")
    own = F.when(cls.between(0, n_classes - 1), cls).otherwise(n_classes)

    def verdict(was: State) -> Column:
        """1 for the first rule broken, 2 for the second ...; 0 for none."""
        first = F.when(F.lit(False), 0)
        for k, rule in enumerate(rules, 1):
            first = first.when(rule.broken(was), k)
        return first.otherwise(0)

    def after(was: State) -> Column:
        return (F.when(verdict(was) > 0, number[was])
                .when(op.isin("CREATE", "UPDATE"), own + number[State(True, was.deleted, 0 if n_classes else None)])
                .when(op == "DELETE", number[State(True, True, was.value)])
                .when(op == "RESTORE", number[State(True, False, was.value)]).otherwise(number[was]))

    fields = ["id", "event_id", "ts", "op", "description"]
    # Written once: the runs, their count and the ranges' bounds would each derive the log anew.
    path = scratch_path(changes.sparkSession, "changes")
    changes.select(*fields, value_class.cast("int").alias("value_class")).write.parquet(path)
    rows = changes.sparkSession.read.parquet(path).select(
        "id", F.struct("ts", "event_id").alias("ord"), F.array(*[after(s) for s in states]).alias("step"),
        F.struct(*fields, "value_class").alias("row"))
    met = _met(rows, len(states), slice_rows, rows_per_range).select("row.*", "met")
    broken = met.withColumn("_rule", F.get(F.array(*[verdict(s) for s in states]), F.col("met")))
    return broken.select(*fields, *[
        F.get(F.array(F.lit(None).cast("string"), *[F.lit(getattr(r, c)) for r in rules]), F.col("_rule")).alias(out)
        for out, c in (("rule", "name"), ("message", "message"))])
