"""Helpers shared by the operators: scratch tables and text as byte arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.session import scratch_path

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = "abcdefghijklmnopqrstuvwxyz"

# Words as runs of anything but blanks (space, tab to carriage return).
BLANKS = r"[\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read back: cuts the
    lineage at a table that survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ascii_lower(c: Column) -> Column:
    """A-Z to a-z, everything else unchanged."""
    return F.translate(c, ASCII_UPPER, ASCII_LOWER)


def spans_text(spans: Column) -> Column:
    """array<struct<..., kind, start, end>> -> ``kind:start:end`` joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def slices(batch: pa.RecordBatch, column: int, size: int) -> Iterator[pa.RecordBatch]:
    """``batch`` in slices with about ``size`` bytes of text in ``column`` (and
    the rest of the last text): bounds what a worker derives from them."""
    if not batch.num_rows:
        return
    _, off = text_bytes(batch.column(column))
    cuts = [*np.flatnonzero(np.diff(off[:-1] // size, prepend=-1)), batch.num_rows]
    for start, end in zip(cuts[:-1], cuts[1:], strict=True):
        yield batch.slice(start, end - start)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and its n + 1 offsets, without a copy;
    a null row is empty."""
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]] if len(off) else raw, off - (off[0] if len(off) else 0)
