"""Next phase of every collection: snapshot first, changes first, or changes only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STREAM = ["namespace", "stream"]


def snapshot_selection(streams: DataFrame, states: DataFrame, offset_valid: Column | bool) -> DataFrame:
    """Which incremental streams take a snapshot and which read changes before it.

    With an invalid offset all stored states are void and every stream starts over. Else a snapshot is taken by
    the streams in progress and by the new ones, and changes of the started streams are read before it.
    """
    valid = F.lit(offset_valid) if isinstance(offset_valid, bool) else offset_valid
    known = streams.where(F.col("sync_mode") == "incremental").join(states.select(*STREAM, "status"), STREAM, "left")
    status = F.when(valid, F.col("status"))
    snapshot = status.isNull() | (status == "IN_PROGRESS")
    return known.withColumns({"status": status, "snapshot": snapshot, "started": status.isNotNull()})


def phases(selection: DataFrame) -> DataFrame:
    """The order of work of one run: a single row from all selected streams.

    Nothing started: snapshot, then the changes of all. No snapshot left: changes of all. Else the changes of
    the started streams first, so that the log is not lost, then the snapshot.
    """
    seen = selection.agg(
        F.coalesce(F.bool_or("started"), F.lit(False)).alias("_started"),
        F.coalesce(F.bool_or("snapshot"), F.lit(False)).alias("_snapshot"),
        F.count_if("snapshot").alias("snapshots"),
        F.count_if("started").alias("started_streams"),
    )
    order = (
        F.when(~F.col("_started"), F.lit("snapshot, changes"))
        .when(~F.col("_snapshot"), F.lit("changes"))
        .otherwise(F.lit("changes, snapshot"))
    )
    return seen.select(order.alias("phases"), "snapshots", "started_streams")


def offset_check(log: DataFrame, offsets: DataFrame, by: list[str], position: str = "position") -> DataFrame:
    """Whether the log still holds everything after the stored position.

    True if the oldest kept position is not past the stored one. Without a stored position, or with an empty
    log, there is nothing to resume from.
    """
    oldest = log.groupBy(*by).agg(F.min(position).alias("oldest"))
    held = F.col("oldest").isNotNull() & F.col("stored").isNotNull() & (F.col("oldest") <= F.col("stored"))
    return offsets.join(oldest, by, "left").withColumn("valid", F.coalesce(held, F.lit(False)))
