"""Keeps the current state of a collection from a stream of change rows.

A micro-batch never rewrites the base table. It stores the last change of every key it saw in a folder of its
own, named by the batch, so a replayed batch replaces itself. Readers merge base and batches; ``fold`` does so
once and writes a new base.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.names import DELETED_AT
from tidemark.operators.merge import apply_changes, latest_per_key


def store_changes(
    rows: DataFrame,
    path: str,
    checkpoint: str,
    keys: Sequence[str],
    order: Sequence[str],
    available_now: bool = True,
) -> StreamingQuery:
    """Starts the stream; ``available_now`` reads what is there at the start and stops (a bounded run)."""

    def store(batch: DataFrame, number: int) -> None:
        latest_per_key(batch, keys, order).write.mode("overwrite").parquet(f"{path}/batch={number}")

    writer = rows.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def stored_changes(spark: SparkSession, path: str, schema=None, after_batch: int = -1) -> DataFrame:
    """Changes of all batches after one; older folders are not listed as input."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    rows = reader.parquet(path)
    return rows.where(F.col("batch") > after_batch).drop("batch")


def current(
    base: DataFrame, changes: DataFrame, keys: Sequence[str], order: Sequence[str], hard: bool = False
) -> DataFrame:
    """The state of the collection now."""
    return apply_changes(base, changes, keys, order, DELETED_AT, hard)


def fold(
    base: DataFrame,
    changes: DataFrame,
    path: str,
    keys: Sequence[str],
    order: Sequence[str],
    hard: bool = False,
) -> DataFrame:
    """Writes the state now to a new folder and returns it as the next base."""
    current(base, changes, keys, order, hard).write.mode("errorifexists").parquet(path)
    return base.sparkSession.read.parquet(path)
