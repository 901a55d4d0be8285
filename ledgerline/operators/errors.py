"""Q6, Q7, V6: the error catalogue, message fallback and error routing.

The catalogue has four fixed rows, so a lookup is a CASE expression compiled
into the surrounding stage: no join, no broadcast, no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline import schemas

# Error type, HTTP status, reason phrase, default message.
ERROR_CATALOGUE = [
    ("INTERNAL_ERROR", 500, "Internal Server Error", "A temporary error occurred."),
    ("BAD_REQUEST", 400, "Bad Request", "The request is not valid."),
    ("NOT_FOUND", 404, "Not Found", "The requested item does not exist."),
    ("CONFLICT", 409, "Conflict", "The item already exists."),
]

# Error kinds that are the caller's fault and become BAD_REQUEST.
BAD_REQUEST_KINDS = ["type_mismatch", "missing_parameter", "unreadable_body", "input_error"]
DOMAIN_KIND = "domain"
NO_RESOURCE_KIND = "no_resource"


def catalogue_df(spark: SparkSession) -> DataFrame:
    """The catalogue as a four-row table, for users who want to join it."""
    return spark.createDataFrame(ERROR_CATALOGUE, schema=schemas.ERROR_CATALOGUE)


def _case(error_type: Column, field: int) -> Column:
    out = None
    for row in ERROR_CATALOGUE:
        out = (F.when(error_type == row[0], F.lit(row[field])) if out is None
               else out.when(error_type == row[0], F.lit(row[field])))
    return out


def default_message(error_type: str) -> str:
    """The catalogue's default message for a known type (driver-side constant)."""
    return {t: m for t, _, _, m in ERROR_CATALOGUE}[error_type]


def status_of(error_type: Column) -> Column:
    return _case(error_type, 1)


def code_of(error_type: Column) -> Column:
    return _case(error_type, 2)


def default_message_of(error_type: Column) -> Column:
    return _case(error_type, 3)


def resolve_message(error_type: Column, custom_message: Column) -> Column:
    """Q7: the custom message when present, else the type's default.

    Only null falls back; an empty custom message is kept.
    """
    return F.coalesce(custom_message, default_message_of(error_type))


def with_error_details(df: DataFrame, error_type: str = "error_type", custom_message: str = "custom_message") -> DataFrame:
    """Q6 + Q7: add ``status``, ``code`` and ``message`` for each row's error type."""
    t = F.col(error_type)
    return df.withColumns(
        {
            "status": status_of(t),
            "code": code_of(t),
            "message": resolve_message(t, F.col(custom_message)),
        }
    )


def route_error_type(kind: Column, domain_type: Column) -> Column:
    """V6: an error kind to an error type.

    A domain error keeps its own type; caller errors become BAD_REQUEST; a
    missing resource becomes NOT_FOUND; everything else INTERNAL_ERROR.
    """
    return (
        F.when(kind == DOMAIN_KIND, domain_type)
        .when(kind.isin(BAD_REQUEST_KINDS), F.lit("BAD_REQUEST"))
        .when(kind == NO_RESOURCE_KIND, F.lit("NOT_FOUND"))
        .otherwise(F.lit("INTERNAL_ERROR"))
    )


def route_custom_message(kind: Column, detail: Column) -> Column:
    """V6: which detail survives. Internal errors hide theirs, and a missing
    resource uses the default text."""
    return F.when(kind == DOMAIN_KIND, detail).when(kind.isin(BAD_REQUEST_KINDS), detail)


def route_errors(df: DataFrame, kind: str = "kind", domain_type: str = "domain_type", detail: str = "detail") -> DataFrame:
    """V6 then Q6/Q7 over a rejects table."""
    k = F.col(kind)
    routed = df.withColumns(
        {
            "error_type": route_error_type(k, F.col(domain_type)),
            "custom_message": route_custom_message(k, F.col(detail)),
        }
    )
    return with_error_details(routed).drop("custom_message")


def catalogue_counts(routed: DataFrame, error_type: str = "error_type") -> DataFrame:
    """Q6 as a table: every catalogue type with its status, reason phrase,
    default message and how many rows of ``routed`` carry it (0 if none).

    The counts are partial-aggregated to at most one row per type, and both
    sides of the join are that small.
    """
    counts = routed.groupBy(F.col(error_type).alias("error_type")).agg(F.count(F.lit(1)).alias("n_errors"))
    cat = catalogue_df(routed.sparkSession)
    return cat.join(counts, "error_type", "left").select(
        "error_type", "status", "code", "message", F.coalesce("n_errors", F.lit(0)).alias("n_errors"))
