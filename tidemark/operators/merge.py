"""Applying changes to a current-state table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.names import DELETED_AT
from tidemark.operators.joins import drop_keys, fits_broadcast, keep_keys
from tidemark.session import settle


def latest_per_key(changes: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of every key by the ``order`` columns.

    An aggregate, not a window: each map task keeps one row per key, so keys with most of the changes, and
    changes that were delivered twice, shrink before the shuffle.
    """
    others = [c for c in changes.columns if c not in keys]
    # Spread over named fields once, ordered by the position.
    row = F.max_by(F.struct(*others), F.struct(*order))
    return changes.groupBy(*keys).agg(row.alias("_row")).select(*[c if c in keys else f"_row.{c}" for c in changes.columns])


def apply_changes(
    target: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    deleted: str = DELETED_AT,
    hard: bool = False,
) -> DataFrame:
    """The target after the changes: changed keys take their last change, all other rows stay.

    Deleted keys stay with their delete time, or go away when ``hard``. Applying the same changes again gives
    the same table. When the changed keys are few, the target is only filtered, without a shuffle.

    A target that has the ``order`` columns keeps its row where that is newer, so that changes may come again, late or
    in any order; rows without an order are older than all changes. A target without them takes every change, and hard
    deletes forget the order of what they deleted: such a key comes back if an older change is applied again.
    """
    return apply_last(target, settle(latest_per_key(changes, keys, order)), keys, order, deleted, hard)


def apply_last(
    target: DataFrame, last: DataFrame, keys: Sequence[str], order: Sequence[str], deleted: str = DELETED_AT, hard: bool = False
) -> DataFrame:
    """The target after the last change of every changed key; ``last`` is read several times."""
    small = fits_broadcast(last.select(*keys))
    kept = drop_keys(target, last, keys, small=small)
    if set(order) <= set(target.columns):
        touched = keep_keys(target, last, keys, small=small)
        last = latest_per_key(last.select(*target.columns).unionByName(touched), keys, order)
    alive = last.where(F.col(deleted).isNull()) if hard else last
    return kept.unionByName(alive.select(*target.columns))
