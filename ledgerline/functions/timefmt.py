"""Time rendering (L7, B2).

Instants are stored in UTC and shown in the service zone. The test tables
load as TIMESTAMP_NTZ (wall time in UTC), on which the session zone has no
effect, so every conversion names its zones.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the zone every application renders local times in.
SERVICE_ZONE = "Asia/Seoul"


def to_service_zone(ts_utc_ntz: Column, zone: str = SERVICE_ZONE) -> Column:
    """UTC wall time (TIMESTAMP_NTZ) -> wall time in ``zone``."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), ts_utc_ntz)


_EPOCH_NTZ = "1970-01-01 00:00:00"


def utc_epoch_millis(ts_utc_ntz: Column) -> Column:
    """Milliseconds since the epoch of a UTC wall time, truncated.

    Built from the wall-clock fields only; ``timestampdiff`` would cast the
    NTZ value through the session zone and shift across DST changes.
    """
    days = F.datediff(F.to_date(ts_utc_ntz), F.lit("1970-01-01").cast("date")).cast("bigint")
    ms_of_second = F.floor(F.date_part(F.lit("SECOND"), ts_utc_ntz) * F.lit(1000)).cast("bigint")
    return (days * F.lit(86_400_000) + F.hour(ts_utc_ntz).cast("bigint") * F.lit(3_600_000)
            + F.minute(ts_utc_ntz).cast("bigint") * F.lit(60_000) + ms_of_second)


def utc_epoch_seconds(ts_utc_ntz: Column) -> Column:
    return F.floor(utc_epoch_millis(ts_utc_ntz) / F.lit(1000)).cast("bigint")


def utc_wall_from_millis(epoch_ms: Column) -> Column:
    """Epoch milliseconds -> UTC wall time (TIMESTAMP_NTZ); adding to an NTZ
    value is wall-clock arithmetic, independent of the session zone."""
    return F.timestamp_add("MILLISECOND", epoch_ms, F.lit(_EPOCH_NTZ).cast("timestamp_ntz"))


def render_local(epoch_ms: Column, zone: str = SERVICE_ZONE) -> Column:
    """Epoch milliseconds -> local wall time in ``zone`` (TIMESTAMP_NTZ),
    independent of the session zone."""
    return to_service_zone(utc_wall_from_millis(epoch_ms), zone)


def duration_parts(total_ms: Column) -> dict[str, Column]:
    """Hours in total (not wrapped at 24), minutes mod 60, seconds mod 60.

    ``total_ms`` is a non-negative BIGINT; integer division keeps it exact.
    """
    ms = total_ms.cast("bigint")
    return {
        "hours": F.call_function("div", ms, F.lit(3_600_000)),
        "minutes": F.pmod(F.call_function("div", ms, F.lit(60_000)), F.lit(60)).cast("bigint"),
        "seconds": F.pmod(F.call_function("div", ms, F.lit(1_000)), F.lit(60)).cast("bigint"),
    }


def time_slice(ts_utc_ntz: Column, grain_seconds: int) -> Column:
    """Index of the ``grain_seconds``-long slice holding ``ts`` (order
    preserving, never null so both uses of a sliced plan stay identical)."""
    return F.coalesce(F.floor(utc_epoch_seconds(ts_utc_ntz) / F.lit(grain_seconds)).cast("bigint"),
                      F.lit(0).cast("bigint"))
