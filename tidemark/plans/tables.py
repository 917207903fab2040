"""Next read of every table: one row per stream in, one read instruction per stream out.

Input rows hold the stream's settings, its metadata and its stored state side by side, see the column lists of
:func:`tracking_reads` and :func:`cursor_reads`. :func:`with_state` adds the stored part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STREAM = ["namespace", "stream"]


def with_state(streams: DataFrame, latest: DataFrame) -> DataFrame:
    """Streams with their latest rows of the state table, in the columns that the plans read."""
    stored = latest.where(F.col("status").isNotNull()).select(
        *STREAM,
        F.lit("ok").alias("state"),
        (F.col("status") == "completed").alias("completed"),
        F.col("ct_version").alias("stored_version"),
        F.element_at("key_name", 1).alias("stored_key_name"),
        F.col("key").alias("stored_key"),
        F.col("cursor_field").alias("stored_cursor_field"),
        F.col("cursor").alias("stored_cursor"),
    )
    return streams.join(stored, STREAM, "left")


def _yes(name: str) -> Column:
    """A flag that counts as false where it is unknown."""
    return F.coalesce(F.col(name), F.lit(False))


def _no_order() -> Column:
    return _yes("is_view") | F.col("ordered_column").isNull()


def expired() -> Column:
    """The stored version is older than the changes the table still keeps; unknown tables are not checked."""
    known = F.col("object_known") & F.col("stored_version").isNotNull() & F.col("min_valid_version").isNotNull()
    return F.coalesce(known & (F.col("stored_version") < F.col("min_valid_version")), F.lit(False))


def tracking_reads(streams: DataFrame, fail_expired: bool = False) -> DataFrame:
    """Change-tracking mode.

    Reads: state (none, null, unreadable or ok), stored_version, stored_key_name, stored_key, object_known,
    min_valid_version, current_version, ordered_column, is_view, primary_key, tracked.
    Adds: rule (the row of the decision table that applied), read, after_key, since_version, next_version.
    """
    state = F.coalesce("state", F.lit("none"))
    resuming = F.col("stored_key_name").isNotNull()
    unchanged = F.col("current_version") == F.col("stored_version")
    keyed = F.coalesce(F.size("primary_key") > 0, F.lit(False)) & _yes("tracked")
    rule = (
        F.when(state == "null", 0)
        .when(state != "ok", 1)
        .when(expired(), 2)
        .when(resuming & F.col("ordered_column").isNull(), 3)
        .when(resuming, 4)
        .when(~keyed, 5)
        .when(unchanged, 6)
        .otherwise(7)
    )
    start = F.when(_no_order(), F.lit("whole")).otherwise(F.lit("keyed"))
    if fail_expired:
        failure = F.concat(F.lit("change version expired: "), F.concat_ws(".", *STREAM))
        old = F.raise_error(failure).cast("string")
    else:
        old = start
    rule_is = F.col("rule")
    read = (
        F.when(rule_is == 0, F.lit("done"))
        .when(rule_is == 1, start)
        .when(rule_is == 2, old)
        .when(rule_is == 3, F.lit("whole"))
        .when(rule_is == 4, F.lit("keyed"))
        .when(rule_is == 5, F.when(unchanged, F.lit("done")).otherwise(F.lit("whole")))
        .when(rule_is == 6, F.lit("done"))
        .otherwise(F.lit("changes"))
    )
    # Resuming keeps the version of the snapshot's start; every other read captures the current one.
    captured = F.when(rule_is == 4, F.col("stored_version")).when(F.col("read") != "done", F.col("current_version"))
    return (
        streams.withColumn("rule", rule)
        .withColumn("read", read)
        .withColumn("after_key", F.when(rule_is == 4, F.col("stored_key")))
        .withColumn("since_version", F.when(F.col("read") == "changes", F.col("stored_version")))
        .withColumn("next_version", captured)
    )


def cursor_reads(streams: DataFrame) -> DataFrame:
    """Cursor mode.

    Reads: state (none, null or ok), full_refresh, completed (a finished read without key), stored_key_name,
    stored_key, max_key, stored_cursor_field, stored_cursor, max_cursor, cursor_field (the chosen one),
    cursor_known (the stored field still exists), ordered_column, is_view.
    Adds: rule, read, after_key, after_cursor.
    """
    state = F.coalesce("state", F.lit("none"))
    full = _yes("full_refresh")
    resuming = F.col("stored_key_name").isNotNull()
    finished = F.col("stored_key").isNotNull() & (F.col("stored_key") == F.col("max_key"))
    rule = (
        F.when(state == "null", 0)
        .when((state == "none") & full, 1)
        .when((state == "none") & F.col("cursor_field").isNull(), 2)
        .when(state == "none", 3)
        .when(full & _no_order(), 4)
        .when(full, 5)
        .when(resuming, 6)
        .when(F.col("stored_cursor_field").isNull(), 7)
        .when(~_yes("cursor_known"), 8)
        .when(F.coalesce(F.col("stored_cursor") == F.col("max_cursor"), F.lit(False)), 9)
        .otherwise(10)
    )
    missing = F.col("cursor_field").isNull()
    table = F.when(_no_order(), F.lit("whole")).otherwise(F.lit("keyed"))
    with_cursor = F.when(missing, F.lit("no_cursor")).otherwise(F.concat(table, F.lit("_cursor")))
    rule_is = F.col("rule")
    read = (
        F.when(rule_is.isin(0, 7, 9), F.lit("done"))
        .when(rule_is == 1, table)
        .when(rule_is == 2, F.lit("no_cursor"))
        .when(rule_is.isin(3, 6, 8), with_cursor)
        .when(rule_is == 4, F.when(_yes("completed"), F.lit("done")).otherwise(F.lit("whole")))
        .when(rule_is == 5, F.when(F.coalesce(finished, F.lit(False)), F.lit("done")).otherwise(F.lit("keyed")))
        .otherwise(F.lit("increment"))
    )
    resumed = rule_is.isin(5, 6) & F.col("read").startswith("keyed")
    return (
        streams.withColumn("rule", rule)
        .withColumn("read", read)
        .withColumn("after_key", F.when(resumed, F.col("stored_key")))
        .withColumn("after_cursor", F.when(F.col("read") == "increment", F.col("stored_cursor")))
    )
