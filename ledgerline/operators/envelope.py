"""Q4 / Q5: the response envelope as one expression.

``meta = (SUCCESS, null, null)`` with the payload, or ``(FAIL, code, message)``
with a null payload. Success and failure are a single ``when`` so a mixed
batch of requests is answered in one narrow projection.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.errors import code_of, resolve_message

# The two outcomes.
SUCCESS = "SUCCESS"
FAIL = "FAIL"


def envelope(ok: Column, data: Column, error_type: Column, custom_message: Column) -> Column:
    """STRUCT<meta: STRUCT<result, error_code, message>, data: ...>."""
    meta = F.when(
        ok,
        F.struct(F.lit(SUCCESS).alias("result"), F.lit(None).cast("string").alias("error_code"),
                 F.lit(None).cast("string").alias("message")),
    ).otherwise(
        F.struct(F.lit(FAIL).alias("result"), code_of(error_type).alias("error_code"),
                 resolve_message(error_type, custom_message).alias("message"))
    )
    return F.struct(meta.alias("meta"), F.when(ok, data).alias("data"))


def flatten_envelope(df: DataFrame, col: str = "response", data_fields: tuple[str, ...] = ("id", "name", "description")) -> DataFrame:
    """Envelope struct -> flat columns (``result``, ``error_code``, ``message``, ``data_*``)."""
    r = F.col(col)
    return df.withColumns(
        {
            "result": r["meta"]["result"],
            "error_code": r["meta"]["error_code"],
            "message": r["meta"]["message"],
            **{f"data_{f}": r["data"][f] for f in data_fields},
        }
    ).drop(col)
