"""Incremental reads: by cursor column, by versioned change table and by current images."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.predicates import before, bound, key_range
from tidemark.names import DELETED_AT
from tidemark.operators.joins import fits_broadcast, keep_keys, lookup, may_hold
from tidemark.operators.ranges import max_key
from tidemark.operators.snapshot import Read, next_cursor
from tidemark.session import settle


def max_cursor(df: DataFrame, cursor: str, cutoff: Any = None) -> Any:
    """Largest cursor value below the cutoff, None for no rows."""
    top = max_key(df.where(before(df, cursor, cutoff)), [cursor])
    return top and top[0]


def cursor_increment(
    df: DataFrame, fields: Sequence[str], cursor: str, stored: Any, upper: Any = None, cutoff: Any = None
) -> Read:
    """Rows whose cursor lies in (stored, upper], below the cutoff.

    ``upper`` is the largest value when the read starts. Rows that arrive later with the stored value itself
    are not seen, and rows without a cursor value are read by snapshots only. Nothing stored, as after the
    snapshot of an empty table, reads from the start.
    """
    upper = max_cursor(df, cursor, cutoff) if upper is None else upper
    state = {"cursor_field": [cursor], "cursor": next_cursor(cutoff, upper, stored)}
    low = None if stored is None else (stored,)
    high = None if upper is None else (upper,)
    new = F.lit(False) if upper is None or stored == upper else key_range(df, [cursor], low, high) & before(df, cursor, cutoff)
    return Read(df.where(new).select(*dict.fromkeys([*fields, cursor])), state)


# Rank of an operation among changes of one key and one version, and back.
OPERATIONS = ("D", "I", "U")


def net_changes(
    changes: DataFrame,
    keys: Sequence[str],
    since: int,
    until: int | None = None,
    version: str = "sys_change_version",
    operation: str = "sys_change_operation",
) -> DataFrame:
    """The last change of every key after version ``since``.

    Version and operation travel as one number, so that keys with many changes shrink inside each map task
    before the shuffle. Within one version a delete gives way to the row that replaced it. Operations may be in
    lower case; any other operation, also null, fails the job, for its key's state would be unknown.
    """
    window = F.col(version) > bound(changes, version, since)
    if until is not None:
        window = window & (F.col(version) <= bound(changes, version, until))
    ranks = F.create_map(*[F.lit(x) for i, op in enumerate(OPERATIONS) for x in (op, i)])
    unknown = F.raise_error(F.concat(F.lit("unknown change operation: "), F.coalesce(F.col(operation), F.lit("null"))))
    rank = F.coalesce(F.element_at(ranks, F.upper(operation)), unknown.cast("int"))
    packed = F.max(F.col(version).cast("bigint") * len(OPERATIONS) + rank)
    last = changes.where(window).groupBy(*keys).agg(packed.alias("_last"))
    at = F.pmod(F.col("_last"), F.lit(len(OPERATIONS))).cast("int")
    return last.select(
        *keys,
        ((F.col("_last") - at) / len(OPERATIONS)).cast("bigint").alias(version),
        F.element_at(F.array(*[F.lit(op) for op in OPERATIONS]), at + 1).alias(operation),
    )


def deleted_text(now: dt.datetime) -> str:
    """UTC time of a soft delete: ISO with milliseconds, the fraction only when it is not zero."""
    if now.tzinfo is not None:
        now = now.astimezone(dt.timezone.utc).replace(tzinfo=None)
    millis = now.microsecond // 1000
    return now.strftime("%Y-%m-%dT%H:%M:%S") + (f".{millis:03d}" if millis else "")


def change_increment(
    changes: DataFrame,
    current: DataFrame,
    fields: Sequence[str],
    keys: Sequence[str],
    since: int,
    next_version: int,
    now: dt.datetime,
    few_changes: bool | None = None,
    version: str = "sys_change_version",
    operation: str = "sys_change_operation",
) -> Read:
    """Current rows of all keys changed after ``since``, with a soft-delete time on deleted ones.

    Values come from the current table, not from the version of the change; a key that is gone keeps only its
    key columns. ``next_version`` is the version captured before the read, and becomes the new state.
    The current table is first reduced to the changed keys: when these are few, it is not shuffled at all, else only the
    rows that pass a filter of the keys.
    """
    net = settle(net_changes(changes, keys, since, version=version, operation=operation))
    few = fits_broadcast(net.select(*keys)) if few_changes is None else few_changes
    columns = list(dict.fromkeys([*keys, *fields]))
    known = current.select(*columns)
    # Many keys cut it down by a filter, before the join shuffles it.
    known = keep_keys(known, net, keys, small=True) if few else may_hold(known, net, keys)
    deleted: Column = F.when(F.col(operation) == "D", F.lit(deleted_text(now)))
    # The join on column names yields the change's key, which the current row's key equals where it exists.
    rows = net.join(known, list(keys), "left").select(*fields, deleted.alias(DELETED_AT), version)
    return Read(rows, {"ct_version": next_version, "pk_name": None, "pk_val": None})


def current_images(
    events: DataFrame, current: DataFrame, on: Sequence[str], document: str = "document", image: str = "after"
) -> DataFrame:
    """Lookup capture: updates carry the document as it is now instead of their own image.

    Updates of documents that are gone have no image. Events of one document may be many, so the current
    documents are reduced to the touched ones and joined by :func:`lookup`.
    """
    updates = F.col("op") == "u"
    touched = settle(events.where(updates).select(*on).distinct())
    few = fits_broadcast(touched)
    docs = current.select(*on, F.col(document).alias("_current"))
    # Read once here; the copy is what is weighed and joined.
    docs = settle(keep_keys(docs, touched, on, small=few))
    joined = lookup(events, docs, on, "left")
    return joined.withColumn(image, F.when(updates, F.col("_current")).otherwise(F.col(image))).drop("_current")
