"""Key and cursor predicates.

Every predicate compares a bare column with a literal of the column's own type, so it reaches the
Parquet reader or the JDBC source unchanged.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TEMPORAL = (T.DateType, T.TimestampType, T.TimestampNTZType)
TIMES = (dt.date, dt.datetime, dt.time)


def plain(value: Any) -> str:
    """A value as the text that casts back to it; times carry their zone if they have one."""
    return value.isoformat() if isinstance(value, TIMES) else str(value)


def literal(value: Any, data_type: T.DataType) -> Column:
    """A literal of the given type; times go through text so that no time zone is applied.

    Text for a binary column is base64, as stored bounds are.
    """
    if isinstance(value, str) and isinstance(data_type, T.BinaryType):
        return F.unbase64(F.lit(value))
    if isinstance(value, TIMES):
        value = value.isoformat()
    return F.lit(value).cast(data_type)


def bound(df: DataFrame, name: str, value: Any) -> Column:
    return literal(value, df.schema[name].dataType)


def _beyond(df: DataFrame, keys: Sequence[str], values: Sequence[Any], up: bool, closed: bool) -> Column:
    """Rows whose key tuple lies beyond ``values``: the first key decides unless it is equal."""
    name, value = keys[0], bound(df, keys[0], values[0])
    column = F.col(name)
    strict = column > value if up else column < value
    loose = column >= value if up else column <= value
    if len(keys) == 1:
        return loose if closed else strict
    rest = _beyond(df, keys[1:], values[1:], up, closed)
    # The loose test on the leading key is implied; it gives sources a plain range to seek on.
    return loose & (strict | ((column == value) & rest))


def key_after(df: DataFrame, keys: Sequence[str], values: Sequence[Any], inclusive: bool = False) -> Column:
    return _beyond(df, keys, values, up=True, closed=inclusive)


def key_until(df: DataFrame, keys: Sequence[str], values: Sequence[Any]) -> Column:
    return _beyond(df, keys, values, up=False, closed=True)


def key_range(
    df: DataFrame,
    keys: Sequence[str],
    lower: Sequence[Any] | None = None,
    upper: Sequence[Any] | None = None,
    inclusive: bool = False,
) -> Column:
    """Key tuple in (lower, upper]; a missing bound leaves that side open."""
    condition = F.lit(True)
    if lower is not None:
        condition = key_after(df, keys, lower, inclusive)
    if upper is not None:
        until = key_until(df, keys, upper)
        condition = until if lower is None else condition & until
    return condition


def sql_literal(value: Any) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, (bool, int, float)):
        return str(value)
    if isinstance(value, (bytes, bytearray)):
        return "0x" + bytes(value).hex()
    if isinstance(value, TIMES):
        value = value.isoformat()
    return "'" + str(value).replace("'", "''") + "'"


def _sql_beyond(keys: Sequence[str], values: Sequence[Any], sign: str, closed: bool) -> str:
    name, value = keys[0], sql_literal(values[0])
    if len(keys) == 1:
        return f"{name} {sign}{'=' if closed else ''} {value}"
    rest = _sql_beyond(keys[1:], values[1:], sign, closed)
    return f"{name} {sign}= {value} AND ({name} {sign} {value} OR ({name} = {value} AND {rest}))"


def sql_range(keys: Sequence[str], lower: Sequence[Any] | None, upper: Sequence[Any] | None) -> str:
    """The same range as text, for the ``predicates`` of a JDBC read. Names are used as given."""
    parts = []
    if lower is not None:
        parts.append(f"({_sql_beyond(keys, lower, '>', False)})")
    if upper is not None:
        parts.append(f"({_sql_beyond(keys, upper, '<', True)})")
    return " AND ".join(parts) or "1 = 1"


def cutoff(df: DataFrame, cursor: str, now: dt.datetime, logical_type: str | None = None) -> dt.date | dt.datetime | dt.time | str | None:
    """Start of the UTC day of ``now`` when the cursor is a date or a time, else None.

    Of a time of the day that is midnight, which no time lies before. Such a column is text, ``HH:mm:ss`` with a fraction or
    without, where the session has no type for it; ``logical_type="time"`` tells it from other text.
    """
    if now.tzinfo is not None:
        now = now.astimezone(dt.timezone.utc).replace(tzinfo=None)
    data_type = df.schema[cursor].dataType
    if isinstance(data_type, T.DateType):
        return now.date()
    if isinstance(data_type, T.TimestampNTZType):
        return dt.datetime.combine(now.date(), dt.time())
    if isinstance(data_type, T.TimestampType):
        return dt.datetime.combine(now.date(), dt.time(), dt.timezone.utc)
    if isinstance(data_type, T.TimeType):
        return dt.time()
    return "00:00:00" if logical_type == "time" else None


def before(df: DataFrame, cursor: str, limit: dt.date | dt.datetime | dt.time | str | None) -> Column:
    """Rows below the cutoff; no cutoff keeps all rows, also those without a cursor."""
    return F.lit(True) if limit is None else F.col(cursor) < bound(df, cursor, limit)
