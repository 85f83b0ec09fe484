"""Clock arithmetic that gives the same answer under every session time zone.

Spark renders ``TIMESTAMP`` in the session zone, and date parts, casts to text
and interval subtraction follow that zone. Everything here goes through epoch
microseconds or a UTC ``TIMESTAMP_NTZ`` instead, so a job does not change its
result with the cluster's configuration. Both timestamp types are accepted:
an NTZ value is read as a UTC wall clock.

Like all of this package, these functions take and give SQL expression text:
operators touch dozens of fields, and one parsed expression plans much faster
than hundreds of single column calls.
"""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame
from pyspark.sql import types as T

PARIS = "Europe/Paris"
HOUR_MICROS = 3_600_000_000
INSTANT = T.TimestampType()
WALL = T.TimestampNTZType()
_EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)
_EPOCH_SQL = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def type_of(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def is_instant(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.TimestampType)


def utc_wall(value: str, dtype: T.DataType) -> str:
    """UTC wall clock (NTZ) of a timestamp of either type."""
    return wall_from_micros(f"unix_micros({value})") if is_instant(dtype) else value


def micros(value: str, dtype: T.DataType) -> str:
    """Epoch microseconds of a timestamp of either type.

    A wall clock is taken apart field by field: TIMESTAMPDIFF would cast it through
    the session zone.
    """
    if is_instant(dtype):
        return f"unix_micros({value})"
    return (
        f"(unix_date(CAST({value} AS date)) * 86400000000L + hour({value}) * 3600000000L "
        f"+ minute({value}) * 60000000L + CAST(extract(SECOND FROM {value}) * 1000000 AS bigint))"
    )


def wall_from_micros(value: str) -> str:
    return f"timestampadd(MICROSECOND, {value}, {_EPOCH_SQL})"


def from_micros(value: str, dtype: T.DataType) -> str:
    """Inverse of :func:`micros`, in the wanted timestamp type."""
    return f"timestamp_micros({value})" if is_instant(dtype) else wall_from_micros(value)


def local_day(value: str, dtype: T.DataType, zone: str = PARIS) -> str:
    """Calendar day of the instant in ``zone``, across both DST offsets."""
    return f"CAST(convert_timezone('UTC', '{zone}', {utc_wall(value, dtype)}) AS date)"


def utc_day(value: str, dtype: T.DataType) -> str:
    return f"CAST({utc_wall(value, dtype)} AS date)"


def micros_of(moment: datetime) -> int:
    """Epoch microseconds of a driver-side moment; naive moments are refused."""
    if moment.tzinfo is None:
        raise ValueError("moments must be timezone-aware")
    return (moment - _EPOCH) // timedelta(microseconds=1)


def moment_of(value: int | None) -> datetime | None:
    return None if value is None else _EPOCH + timedelta(microseconds=value)


def literal(moment: datetime, dtype: T.DataType) -> str:
    """Foldable literal of the column's own type, so comparisons reach the scan."""
    return from_micros(f"{micros_of(moment)}L", dtype)


def minute_text(wall: str) -> str:
    """``yyyy-mm-dd hh:mm``; casts of wall clocks, unlike DATE_FORMAT, know no session zone."""
    return f"substring(CAST({wall} AS string), 1, 16)"


def text(wall: str) -> str:
    """``yyyy-mm-dd hh:mm:ss+00:00``, with six fraction digits only when there are any."""
    plain = f"CAST({wall} AS string)"
    return f"concat(if(length({plain}) > 19, rpad({plain}, 26, '0'), {plain}), '+00:00')"


def iso_text(wall: str) -> str:
    """ISO 8601 with the UTC offset, as a payload carries it."""
    return f"concat(replace(CAST({wall} AS string), ' ', 'T'), '+00:00')"
