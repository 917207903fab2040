"""The state table: an append-only log of rows per stream; the newest row of a stream is its state."""

from __future__ import annotations

import base64
import datetime as dt
import json
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import remove

STREAM = ["namespace", "stream"]
SCHEMA = (
    "namespace string, stream string, batch bigint, saved_at timestamp, state string, status string, "
    "ct_version bigint, key_name array<string>, key array<string>, cursor_field string, cursor string, "
    "id_type string, binary_subtype tinyint, schema_enforced boolean, offset string"
)


def latest_state(log: DataFrame, by: Sequence[str] = STREAM, order: Sequence[str] = ("batch", "saved_at")) -> DataFrame:
    """The newest row per stream. Streams with long histories shrink to one row inside each map task."""
    others = [c for c in log.columns if c not in by]
    newest = F.max_by(F.struct(*others), F.struct(*order))
    latest = log.groupBy(*by).agg(newest.alias("_row")).select(*by, "_row.*")
    if "schema_enforced" in others:
        latest = latest.withColumn("schema_enforced", F.coalesce("schema_enforced", F.lit(True)))
    return latest


def read_state(spark: SparkSession, path: str) -> DataFrame:
    """Newest state of all streams; a folder that does not exist yet holds none."""
    try:
        log = spark.read.schema(SCHEMA).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        log = spark.createDataFrame([], SCHEMA)
    return latest_state(log)


def append_state(spark: SparkSession, path: str, rows: Sequence[Mapping[str, Any]]) -> None:
    """Adds state rows; call it after the rows they speak of are written, so that a crash replays them."""
    names = spark.createDataFrame([], SCHEMA).columns
    saved = dt.datetime.now(dt.timezone.utc)
    values = [tuple({"saved_at": saved, **row}.get(name) for name in names) for row in rows]
    spark.createDataFrame(values, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def compact_state(spark: SparkSession, path: str) -> None:
    """Replaces the files of the log by one with the newest row of every stream.

    The new file is added before the old ones go, and says what they say, so that a crash in between does no harm.
    """
    old = spark.read.schema(SCHEMA).parquet(path).inputFiles()
    names = spark.createDataFrame([], SCHEMA).columns
    read_state(spark, path).select(*names).coalesce(1).write.mode("append").parquet(path)
    for name in old:
        remove(spark, name)


def text(value: Any) -> str | None:
    """Stored form of a bound; reading casts it back to the column's type."""
    if value is None:
        return None
    if isinstance(value, (bytes, bytearray)):
        return base64.b64encode(value).decode()
    if isinstance(value, (dt.date, dt.datetime, dt.time)):
        return value.isoformat()
    if isinstance(value, (list, tuple, dict)):
        return json.dumps(value, default=str)
    return str(value)
