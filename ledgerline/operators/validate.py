"""V1, V2, V3, V5: ordered validation and reject messages.

A rule is ``(name, predicate, error_type, message)``; the predicate is true
when the row is *rejected*. Rules are checked in order and the first that
fires wins, as a single CASE expression evaluated once per row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.keys import parse_key
from ledgerline.functions.text import is_blank, quoted_token


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Column
    error_type: str
    message: Column


def entity_rules(name: str = "name", description: str = "description") -> list[Rule]:
    """V1: name must not be blank, then description must not be blank.
    A missing (null) value counts as blank."""
    def blank(c: str) -> Column:
        return F.coalesce(is_blank(F.col(c)), F.lit(True))

    return [
        Rule("name_blank", blank(name), "BAD_REQUEST", F.lit("Name must not be blank.")),
        Rule("description_blank", blank(description), "BAD_REQUEST", F.lit("Description must not be blank.")),
    ]


def _first(rules: list[Rule], pick) -> Column:
    out = None
    for r in rules:
        cond = F.coalesce(r.rejects, F.lit(False))
        out = F.when(cond, pick(r)) if out is None else out.when(cond, pick(r))
    return out


def apply_rules(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Annotate each row with ``accepted``, ``rule``, ``error_type``, ``custom_message``."""
    rule = _first(rules, lambda r: F.lit(r.name))
    return df.withColumns(
        {
            "rule": rule,
            "error_type": _first(rules, lambda r: F.lit(r.error_type)),
            "custom_message": _first(rules, lambda r: r.message),
        }
    ).withColumn("accepted", F.col("rule").isNull())


def split(df: DataFrame, rules: list[Rule]) -> tuple[DataFrame, DataFrame]:
    """Accepted rows (original columns) and rejected rows (with reason).

    Both are lazy views of one annotated plan. To materialise both from a
    single scan use :func:`write_split`.
    """
    annotated = apply_rules(df, rules)
    accepted = annotated.where("accepted").select(*df.columns)
    rejected = annotated.where(~F.col("accepted")).drop("accepted")
    return accepted, rejected


def verdict(accepted: Column) -> Column:
    """Partition value for a split table: text, so it reads back unchanged
    (partition discovery does not infer booleans)."""
    return F.when(accepted, F.lit("accepted")).otherwise(F.lit("rejected"))


def write_split(df: DataFrame, rules: list[Rule], path: str, mode: str = "overwrite") -> None:
    """Write accepted and rejected rows in one pass, as ``verdict=accepted``
    and ``verdict=rejected`` partitions of one table (``accepted`` stays a
    boolean column in the files)."""
    out = apply_rules(df, rules)
    out.withColumn("verdict", verdict(F.col("accepted"))).write.mode(mode).partitionBy("verdict").parquet(path)


def check_key(df: DataFrame, raw: str = "raw_id", out: str = "id",
              param_name: str = "id", param_type: str = "Long") -> DataFrame:
    """V3 then V2 on a raw request parameter.

    Adds ``out`` (BIGINT or null), ``error_kind`` (``missing_parameter`` /
    ``type_mismatch`` / null) and ``custom_message``.
    """
    r = F.col(raw)
    parsed = parse_key(r)
    kind = F.when(r.isNull(), F.lit("missing_parameter")).when(parsed.isNull(), F.lit("type_mismatch"))
    msg = (
        F.when(r.isNull(), F.format_string("Required parameter '%s' (type %s) is missing.",
                                           F.lit(param_name), F.lit(param_type)))
        .when(parsed.isNull(), F.format_string("Parameter '%s' (type %s) has an invalid value '%s'.",
                                               F.lit(param_name), F.lit(param_type), F.coalesce(r, F.lit("null"))))
    )
    return df.withColumns({out: parsed, "error_kind": kind, "custom_message": msg})


def missing_value_message(reason: Column) -> Column:
    """V5: a message naming the first quoted token of ``reason``, or null
    (so the catalogue default applies) when there is no token."""
    tok = quoted_token(F.coalesce(reason, F.lit("")))
    return F.when(tok != F.lit(""), F.format_string("Required value '%s' is missing.", tok))
