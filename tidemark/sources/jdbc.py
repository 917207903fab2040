"""Tables and change tables over JDBC. The driver jar is the deployment's to add."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from tidemark.functions.predicates import sql_range
from tidemark.operators.ranges import Key

FETCH_ROWS = 1_024


def options(url: str, **more: Any) -> dict[str, str]:
    """Reader options; pushed-down predicates, limits and aggregates are left to Spark."""
    return {"url": url, "fetchsize": str(FETCH_ROWS), "pushDownAggregate": "true", "pushDownLimit": "true"} | {
        k: str(v) for k, v in more.items()
    }


def read_table(spark: SparkSession, table: str, settings: Mapping[str, str]) -> DataFrame:
    """One table as one partition: for bounds, small tables and tables without a key."""
    return spark.read.format("jdbc").options(**settings).option("dbtable", table).load()


def range_predicates(keys: Sequence[str], ranges: Sequence[tuple[Key | None, Key | None]]) -> list[str]:
    """One condition per key range; together they cover every key once."""
    return [sql_range(keys, low, high) for low, high in ranges]


def read_ranges(
    spark: SparkSession,
    table: str,
    settings: Mapping[str, str],
    keys: Sequence[str],
    ranges: Sequence[tuple[Key | None, Key | None]],
) -> DataFrame:
    """One partition, and so one query at a time per task, for each key range."""
    rest = {k: v for k, v in settings.items() if k != "url"}
    return spark.read.jdbc(settings["url"], table, predicates=range_predicates(keys, ranges), properties=rest)


def change_table(
    spark: SparkSession, table: str, keys: Sequence[str], since: int, settings: Mapping[str, str]
) -> DataFrame:
    """Net changes after a version: the key columns, the version and the operation of each change."""
    columns = ", ".join([*(f"c.{key}" for key in keys), "c.SYS_CHANGE_VERSION", "c.SYS_CHANGE_OPERATION"])
    query = f"SELECT {columns} FROM CHANGETABLE(CHANGES {table}, {int(since)}) AS c"
    read = spark.read.format("jdbc").options(**settings).option("query", query).load()
    return read.withColumnsRenamed(
        {"SYS_CHANGE_VERSION": "sys_change_version", "SYS_CHANGE_OPERATION": "sys_change_operation"}
    )
