"""A stored change log that streams resume from a position."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.events import position_literal, with_position
from tidemark.plans.state import append_state, read_state
from tidemark.session import children, remove

Position = tuple[int, int]


class ExpiredPosition(Exception):
    """The log no longer holds what comes after the stored position."""


def append_log(events: DataFrame, path: str) -> None:
    """Adds change events to the log: a folder for each day of their positions."""
    placed = with_position(events).withColumn("day", F.date_from_unix_date(F.floor(F.col("position.seconds") / 86_400).cast("int")))
    placed.write.mode("append").partitionBy("day").parquet(path)


def _day(position: Sequence[int]) -> str:
    return (dt.date(1970, 1, 1) + dt.timedelta(days=position[0] // 86_400)).isoformat()


def _end(spark: SparkSession, path: str, schema: T.StructType, last: bool) -> Position | None:
    """The first or the last position of the log; of all its days, only that one is read."""
    days = sorted((name for name in children(spark, path) if name.startswith("day=")), reverse=last)
    for day in days:
        held = spark.read.schema(schema).parquet(f"{path}/{day}")
        found = held.agg((F.max if last else F.min)("position").alias("end")).first()["end"]
        if found is not None:
            return tuple(found)
    return None


def log_bounds(spark: SparkSession, path: str, schema: T.StructType) -> tuple[Position | None, Position | None]:
    """The first and the last position of the log, from its folders and one day at either end."""
    return _end(spark, path, schema, False), _end(spark, path, schema, True)


def resumed(spark: SparkSession, path: str, schema: T.StructType, after: Position | None, until: Position | None = None) -> DataFrame:
    """The stream of events after a stored position, all of them without one, up to and including ``until``.

    Fails if the first position of the log is past the stored one, for then events may be missing. Days before it are not
    read. ``schema`` is that of the events with their position.
    """
    if after is not None:
        first = _end(spark, path, schema, False)
        if first is None or first > tuple(after):
            raise ExpiredPosition(f"the log begins at {first}, after the stored position {tuple(after)}")
    rows = spark.readStream.schema(T.StructType([*schema.fields, T.StructField("day", T.DateType())])).parquet(path)
    if after is not None:
        rows = rows.where((F.col("day") >= F.lit(_day(after)).cast("date")) & (F.col("position") > position_literal(after)))
    if until is not None:
        rows = rows.where((F.col("day") <= F.lit(_day(until)).cast("date")) & (F.col("position") <= position_literal(until)))
    return rows.drop("day")


def resume_run(
    spark: SparkSession, path: str, schema: T.StructType, out: str, state: str, namespace: str, stream: str, until: Position | None = None
) -> Position | None:
    """One bounded run: the events after the stored position go to a batch of ``out``; then the new position is stored.

    The end is taken when the run starts, so later events belong to the next run. A run that dies before its position is
    stored is done again and replaces its batch.
    """
    latest = read_state(spark, state).where((F.col("namespace") == namespace) & (F.col("stream") == stream)).first()
    after = tuple(json.loads(latest["offset"])) if latest and latest["offset"] else None
    number = latest["batch"] + 1 if latest else 0
    last = _end(spark, path, schema, True)
    end = last if until is None or (last is not None and last < tuple(until)) else tuple(until)
    if end is None or (after is not None and end <= after):
        return after
    rows = resumed(spark, path, schema, after, end)

    def store(batch: DataFrame, part: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}/part={part}")

    # Progress within the run; a position, not this folder, is what the next run goes on from. A run that died before had
    # another end, so nothing of it is taken over.
    progress = f"{out}/_progress/batch={number}"
    remove(spark, progress)
    remove(spark, f"{out}/batch={number}")
    rows.writeStream.foreachBatch(store).option("checkpointLocation", progress).trigger(availableNow=True).start().awaitTermination()
    append_state(spark, state, [{"namespace": namespace, "stream": stream, "batch": number, "status": "offset", "offset": json.dumps(end)}])
    return end
