"""Snapshot reads of tables and collections."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.predicates import before, key_after, key_range
from tidemark.operators.ranges import Key, max_key, random_rows


@dataclass(frozen=True)
class Read:
    """Rows of one read and the state to store once they are written."""

    rows: DataFrame
    state: dict[str, Any] = field(default_factory=dict)


def snapshot(df: DataFrame, fields: Sequence[str]) -> Read:
    """The whole table, not resumable."""
    return Read(df.select(*fields), {"status": "completed"})


def snapshot_range(
    df: DataFrame, fields: Sequence[str], keys: Sequence[str], lower: Key | None = None, upper: Key | None = None
) -> Read:
    """Keys in (lower, upper]; without ``upper``, up to the largest key at the start.

    The key columns are always part of the rows, so that any prefix of them can be a checkpoint.
    """
    upper = upper or max_key(df, keys)
    columns = list(dict.fromkeys([*fields, *keys]))
    state = {"pk_name": list(keys), "pk_val": upper, "status": "completed" if upper is None else "checkpoint"}
    if upper is None or lower == upper:
        return Read(df.select(*columns).where(F.lit(False)), {**state, "pk_val": upper or lower})
    return Read(df.where(key_range(df, keys, lower, upper)).select(*columns), state)


def snapshot_with_cursor(
    df: DataFrame,
    fields: Sequence[str],
    cursor: str,
    keys: Sequence[str] = (),
    lower: Key | None = None,
    cutoff: Any = None,
    upper: Any = None,
) -> Read:
    """Snapshot that hands the largest cursor value to the later incremental reads.

    With ``keys`` it resumes after ``lower``; tables without keys and views are read whole. The cursor bound is
    taken before the rows are read, so rows added meanwhile are read again later, never missed. A resumed
    snapshot gets the bound of its first start as ``upper`` for the same reason.
    """
    shown = visible(df, cursor, cutoff)
    top = (upper,) if upper is not None else max_key(shown, [cursor])
    rows = shown if not keys or lower is None else shown.where(key_after(df, keys, lower))
    columns = list(dict.fromkeys([*fields, *keys]))
    value = top and top[0]
    if keys:
        value = next_cursor(cutoff, value, None)
    return Read(rows.select(*columns), {"cursor_field": [cursor], "cursor": value})


def visible(df: DataFrame, cursor: str, cutoff: Any) -> DataFrame:
    """Rows below the cutoff; without one all rows, also those without a cursor."""
    return df if cutoff is None else df.where(before(df, cursor, cutoff))


def next_cursor(cutoff: Any, upper: Any, stored: Any) -> Any:
    """The smaller of cutoff and upper bound, else the upper bound, else the stored value."""
    if upper is None:
        return stored
    if cutoff is None:
        return upper
    return min(cutoff, upper)


def versioned_snapshot(
    df: DataFrame, fields: Sequence[str], version: int, keys: Sequence[str] = (), lower: Key | None = None
) -> Read:
    """Snapshot under a change version captured before reading; changes after that version are read later.

    Resumes after ``lower`` when the table has keys. Tables without keys and views are read whole.
    """
    rows = df if lower is None or not keys else df.where(key_after(df, keys, lower))
    columns = list(dict.fromkeys([*fields, *keys]))
    return Read(rows.select(*columns), {"ct_version": version, "pk_name": None, "pk_val": None})


def sample_rows(
    df: DataFrame, rows: int, rate: float = 1.0, keys: Sequence[str] = (), seed: int = 7
) -> DataFrame:
    """At most ``rows`` rows in key order: of a random part when ``rate`` is below 1, else the first ones.

    Without keys, the first rows found.
    """
    if not keys:
        return df.limit(rows)
    if rate >= 1:
        return df.orderBy(*keys).limit(rows)
    return random_rows(df.sample(rate, seed), rows, seed).orderBy(*keys)
