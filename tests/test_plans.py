import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.plans import collections, state, tables

TRACKING = {
    "namespace": "n",
    "stream": "s",
    "is_view": False,
    "ordered_column": "id",
    "primary_key": ["id"],
    "tracked": True,
    "object_known": True,
    "min_valid_version": 10,
    "current_version": 60,
    "state": "ok",
    "stored_version": 20,
    "stored_key_name": None,
    "stored_key": None,
}
TRACKING_SCHEMA = (
    "namespace string, stream string, is_view boolean, ordered_column string, primary_key array<string>, tracked boolean, "
    "object_known boolean, min_valid_version bigint, current_version bigint, state string, stored_version bigint, "
    "stored_key_name string, stored_key string"
)
RESUME = {"stored_key_name": "id", "stored_key": "7"}


@pytest.mark.parametrize(
    "given, rule, read, after, since, following",
    [
        ({"state": "null"}, 0, "done", None, None, None),
        ({"state": None}, 1, "keyed", None, None, 60),
        ({"state": "none"}, 1, "keyed", None, None, 60),
        ({"state": "bad"}, 1, "keyed", None, None, 60),
        ({"state": "none", "ordered_column": None}, 1, "whole", None, None, 60),
        ({"state": "none", "is_view": True}, 1, "whole", None, None, 60),
        ({"stored_version": 9}, 2, "keyed", None, None, 60),
        ({"stored_version": 9, "is_view": True}, 2, "whole", None, None, 60),
        ({"stored_version": 9, **RESUME}, 2, "keyed", None, None, 60),
        ({"stored_version": 9, "object_known": False}, 7, "changes", None, 9, 60),
        ({"stored_version": 9, "object_known": None}, 7, "changes", None, 9, 60),
        ({"stored_version": 10}, 7, "changes", None, 10, 60),
        ({**RESUME, "ordered_column": None}, 3, "whole", None, None, 60),
        (RESUME, 4, "keyed", "7", None, 20),
        ({**RESUME, "is_view": True}, 4, "keyed", "7", None, 20),
        ({"primary_key": []}, 5, "whole", None, None, 60),
        ({"primary_key": None}, 5, "whole", None, None, 60),
        ({"tracked": False}, 5, "whole", None, None, 60),
        ({"tracked": None, "stored_version": 60}, 5, "done", None, None, None),
        ({"stored_version": 60}, 6, "done", None, None, None),
        ({}, 7, "changes", None, 20, 60),
    ],
)
def test_tracking_decisions(spark, given, rule, read, after, since, following):
    row = tables.tracking_reads(spark.createDataFrame([{**TRACKING, **given}], TRACKING_SCHEMA)).first()
    assert (row["rule"], row["read"], row["after_key"], row["since_version"], row["next_version"]) == (
        rule,
        read,
        after,
        since,
        following,
    )


def test_expired_versions_can_fail(spark):
    df = spark.createDataFrame([{**TRACKING, "stored_version": 9}], TRACKING_SCHEMA)
    with pytest.raises(Exception, match="change version expired: n.s"):
        tables.tracking_reads(df, fail_expired=True).collect()
    fresh = spark.createDataFrame([TRACKING], TRACKING_SCHEMA)
    assert tables.tracking_reads(fresh, fail_expired=True).first()["read"] == "changes"


CURSOR = {
    "namespace": "n",
    "stream": "s",
    "is_view": False,
    "ordered_column": "id",
    "full_refresh": False,
    "cursor_field": "at",
    "cursor_known": True,
    "state": "ok",
    "completed": False,
    "stored_key_name": None,
    "stored_key": None,
    "max_key": 9,
    "stored_cursor_field": "at",
    "stored_cursor": "2024",
    "max_cursor": "2025",
}
CURSOR_SCHEMA = (
    "namespace string, stream string, is_view boolean, ordered_column string, full_refresh boolean, cursor_field string, "
    "cursor_known boolean, state string, completed boolean, stored_key_name string, stored_key bigint, max_key bigint, "
    "stored_cursor_field string, stored_cursor string, max_cursor string"
)
FULL = {"full_refresh": True}
KEY = {"stored_key_name": "id", "stored_key": 4}


@pytest.mark.parametrize(
    "given, rule, read, after_key, after_cursor",
    [
        ({"state": "null"}, 0, "done", None, None),
        ({"state": "none", **FULL}, 1, "keyed", None, None),
        ({"state": "none", **FULL, "is_view": True}, 1, "whole", None, None),
        ({"state": "none", **FULL, "ordered_column": None}, 1, "whole", None, None),
        ({"state": "none", "cursor_field": None}, 2, "no_cursor", None, None),
        ({"state": None}, 3, "keyed_cursor", None, None),
        ({"state": "none", "is_view": True}, 3, "whole_cursor", None, None),
        ({**FULL, "is_view": True}, 4, "whole", None, None),
        ({**FULL, "ordered_column": None, "completed": True}, 4, "done", None, None),
        ({**FULL, **KEY}, 5, "keyed", 4, None),
        ({**FULL, **KEY, "stored_key": 9}, 5, "done", None, None),
        (FULL, 5, "keyed", None, None),
        ({**FULL, **KEY, "max_key": None}, 5, "keyed", 4, None),
        (KEY, 6, "keyed_cursor", 4, None),
        ({**KEY, "ordered_column": None}, 6, "whole_cursor", None, None),
        ({**KEY, "cursor_field": None}, 6, "no_cursor", None, None),
        ({"stored_cursor_field": None}, 7, "done", None, None),
        ({"cursor_known": False}, 8, "keyed_cursor", None, None),
        ({"cursor_known": None, "is_view": True}, 8, "whole_cursor", None, None),
        ({"cursor_known": False, "cursor_field": None}, 8, "no_cursor", None, None),
        ({"stored_cursor": "2025"}, 9, "done", None, None),
        ({}, 10, "increment", None, "2024"),
        ({"max_cursor": None}, 10, "increment", None, "2024"),
    ],
)
def test_cursor_decisions(spark, given, rule, read, after_key, after_cursor):
    row = tables.cursor_reads(spark.createDataFrame([{**CURSOR, **given}], CURSOR_SCHEMA)).first()
    assert (row["rule"], row["read"], row["after_key"], row["after_cursor"]) == (rule, read, after_key, after_cursor)


STREAMS = [("n", "new"), ("n", "half"), ("n", "full"), ("n", "refresh")]


def selection(spark, states, valid):
    modes = [(*s, "full_refresh" if s[1] == "refresh" else "incremental") for s in STREAMS]
    streams = spark.createDataFrame(modes, "namespace string, stream string, sync_mode string")
    stored = spark.createDataFrame([("n", *s) for s in states], "namespace string, stream string, status string")
    return collections.snapshot_selection(streams, stored, valid)


@pytest.mark.parametrize(
    "states, valid, chosen, order",
    [
        ([], True, {"new", "half", "full"}, "snapshot, changes"),
        ([("half", "IN_PROGRESS"), ("full", "COMPLETE")], True, {"new", "half"}, "changes, snapshot"),
        ([("half", "IN_PROGRESS"), ("full", "COMPLETE")], False, {"new", "half", "full"}, "snapshot, changes"),
        ([("new", "COMPLETE"), ("half", "COMPLETE"), ("full", "COMPLETE")], True, set(), "changes"),
        ([("removed", "IN_PROGRESS")], True, {"new", "half", "full"}, "snapshot, changes"),
    ],
)
def test_snapshot_selection(spark, states, valid, chosen, order):
    found = selection(spark, states, valid)
    assert {r["stream"] for r in found.where("snapshot").collect()} == chosen
    assert collections.phases(found).first()["phases"] == order


def test_offsets(spark, rows):
    log = spark.createDataFrame([("a", 5), ("a", 9), ("b", 5), ("d", 5)], "s string, position int")
    stored = spark.createDataFrame([("a", 5), ("b", 4), ("c", 4), ("d", None)], "s string, stored int")
    found = collections.offset_check(log, stored, ["s"]).select("s", "valid")
    assert rows(found) == [("a", True), ("b", False), ("c", False), ("d", False)]


def test_state_log(spark, tmp_path):
    path = str(tmp_path / "state")
    assert state.read_state(spark, path).count() == 0
    name = {"namespace": "n", "stream": "s"}
    state.append_state(spark, path, [{**name, "batch": 0, "status": "checkpoint", "key": ["1"]}])
    state.append_state(spark, path, [{**name, "batch": 1, "status": "cursor", "schema_enforced": False}])
    state.append_state(spark, path, [{**name, "stream": "other", "batch": 0, "status": "cursor"}])
    found = {r["stream"]: r for r in state.read_state(spark, path).collect()}
    assert (found["s"]["batch"], found["s"]["status"], found["s"]["key"], found["s"]["schema_enforced"]) == (1, "cursor", None, False)
    assert found["other"]["schema_enforced"] is True


def test_state_text():
    assert state.text(dt.datetime(2024, 1, 2, 3)) == "2024-01-02T03:00:00"
    assert (state.text(None), state.text(b"\x01\x02"), state.text(5), state.text((1, 2))) == (None, "AQI=", "5", "[1, 2]")
