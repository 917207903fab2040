import datetime as dt
import random

import pytest

from tidemark.names import DELETED_AT
from tidemark.operators import increment, joins, snapshot

NOW = dt.datetime(2024, 1, 1, 2, 3, 4)


@pytest.fixture(scope="module")
def table(spark):
    rows = [(i, dt.datetime(2024, 1, 1 + i // 3)) for i in range(30)] + [(99, None)]
    return spark.createDataFrame(rows, "id bigint, at timestamp_ntz").cache()


def ids(df):
    return sorted(r["id"] for r in df.collect())


def test_cursor_increment(table):
    read = increment.cursor_increment(table, ["id"], "at", dt.datetime(2024, 1, 5))
    assert ids(read.rows) == list(range(15, 30))
    assert read.state["cursor"] == dt.datetime(2024, 1, 10)
    assert read.rows.columns == ["id", "at"]


def test_cursor_increment_below_a_cutoff(table):
    read = increment.cursor_increment(table, ["id"], "at", "2024-01-05T00:00:00", cutoff=dt.datetime(2024, 1, 8))
    assert ids(read.rows) == list(range(15, 21))
    assert read.state["cursor"] == dt.datetime(2024, 1, 7)


def test_given_upper_bound_past_the_cutoff(table):
    limit = dt.datetime(2024, 1, 8)
    read = increment.cursor_increment(table, ["id"], "at", "2024-01-05", upper=dt.datetime(2024, 1, 9), cutoff=limit)
    assert ids(read.rows) == list(range(15, 21)) and read.state["cursor"] == limit


def test_nothing_new_keeps_the_stored_cursor(table):
    top = dt.datetime(2024, 1, 10)
    read = increment.cursor_increment(table, ["id"], "at", top)
    assert ids(read.rows) == [] and read.state["cursor"] == top
    empty = increment.cursor_increment(table.where("false"), ["id"], "at", "old")
    assert ids(empty.rows) == [] and empty.state["cursor"] == "old"


def test_nothing_stored_reads_from_the_start(table):
    assert ids(increment.cursor_increment(table, ["id"], "at", None).rows) == list(range(30))


def test_snapshot_with_cursor(table):
    whole = snapshot.snapshot_with_cursor(table, ["id"], "at")
    assert 99 in ids(whole.rows) and whole.state["cursor"] == dt.datetime(2024, 1, 10)
    below = snapshot.snapshot_with_cursor(table, ["id"], "at", ["id"], (3,), dt.datetime(2024, 1, 3))
    assert ids(below.rows) == [4, 5] and below.state["cursor"] == dt.datetime(2024, 1, 2)
    first = dt.datetime(2024, 1, 4)
    resumed = snapshot.snapshot_with_cursor(table, ["id"], "at", ["id"], (20,), upper=first)
    assert resumed.state["cursor"] == first


def test_points_in_time_keep_their_zone(spark):
    df = spark.range(100).selectExpr("id", "timestamp_seconds(1709942400 + id * 3600) as at")
    limit = dt.datetime(2024, 3, 12, tzinfo=dt.timezone.utc)
    first = increment.cursor_increment(df.where("id <= 30"), ["id"], "at", None)
    assert first.state["cursor"] == dt.datetime(2024, 3, 10, 6, tzinfo=dt.timezone.utc)
    rest = increment.cursor_increment(df, ["id"], "at", first.state["cursor"].isoformat(), cutoff=limit)
    assert ids(rest.rows) == list(range(31, 72))
    assert rest.state["cursor"] == dt.datetime(2024, 3, 11, 23, tzinfo=dt.timezone.utc)


def changes(spark, *rows):
    return spark.createDataFrame(rows, "id bigint, sys_change_version bigint, sys_change_operation string")


def test_net_changes(spark, rows):
    log = changes(
        spark,
        (1, 5, "I"),
        (1, 9, "D"),
        (2, 8, "D"),
        (2, 9, "I"),
        (3, 9, "D"),
        (3, 9, "U"),
        (4, 4, "U"),
        (5, 11, "U"),
        (6, -2, "D"),
    )
    assert rows(increment.net_changes(log, ["id"], 4)) == [(1, 9, "D"), (2, 9, "I"), (3, 9, "U"), (5, 11, "U")]
    assert rows(increment.net_changes(log, ["id"], 4, until=10)) == [(1, 9, "D"), (2, 9, "I"), (3, 9, "U")]
    assert (6, -2, "D") in rows(increment.net_changes(log, ["id"], -5))


@pytest.mark.parametrize("few", [None, True, False])
def test_change_increment(spark, rows, few):
    log = changes(spark, (1, 5, "I"), (2, 6, "D"), (3, 7, "U"), (4, 2, "U"))
    current = spark.createDataFrame([(1, "a"), (4, "d"), (9, "x")], "id bigint, name string")
    read = increment.change_increment(log, current, ["name", "id"], ["id"], 2, 7, NOW, few)
    assert rows(read.rows) == [
        ("a", 1, None, 5),
        (None, 2, "2024-01-01T02:03:04", 6),
        (None, 3, None, 7),
    ]
    assert read.rows.columns == ["name", "id", DELETED_AT, "sys_change_version"]
    assert read.state["ct_version"] == 7


def test_change_increment_with_two_keys(spark, rows):
    log = spark.createDataFrame([(1, "x", 5, "U"), (1, "y", 6, "D")], "a int, b string, sys_change_version int, sys_change_operation string")
    current = spark.createDataFrame([(1, "x", 0.5), (2, "y", 1.5)], "a int, b string, v double")
    read = increment.change_increment(log, current, ["a", "b", "v"], ["a", "b"], 0, 6, NOW)
    assert rows(read.rows) == [(1, "x", 0.5, None, 5), (1, "y", None, "2024-01-01T02:03:04", 6)]


def test_few_changes_do_not_shuffle_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).selectExpr("id", "id as v").write.parquet(path)
    log = changes(spark, (1, 5, "I"), (2, 6, "D"))
    read = increment.change_increment(log, spark.read.parquet(path), ["id", "v"], ["id"], 0, 6, NOW)
    plan = read.rows._jdf.queryExecution().executedPlan().toString()
    scan = plan.index("FileScan")
    assert plan.rindex("BroadcastHashJoin", 0, scan) > plan.rindex("Exchange", 0, scan)


def test_deleted_text():
    assert increment.deleted_text(dt.datetime(2024, 1, 1, 0, 0, 0, 120_999)) == "2024-01-01T00:00:00.120"
    zoned = dt.datetime(2024, 1, 1, 2, tzinfo=dt.timezone(dt.timedelta(hours=2)))
    assert increment.deleted_text(zoned) == "2024-01-01T00:00:00"


@pytest.mark.parametrize("fits", [True, False])
@pytest.mark.parametrize("how", ["left", "left_semi"])
def test_lookup_with_a_hot_key(spark, rows, fits, how):
    random.seed(1)
    events = [(random.choice([0, 0, 0, random.randrange(9)]), i % 5) for i in range(500)]
    big = spark.createDataFrame(events, "k bigint, v bigint")
    small = spark.createDataFrame([(k, str(k)) for k in range(0, 9, 2)], "k bigint, name string")
    found = rows(joins.lookup(big, small, ["k"], how, fits=fits))
    if how == "left":
        expected = [(k, v, str(k) if k % 2 == 0 else None) for k, v in events]
    else:
        expected = [(k, v) for k, v in events if k % 2 == 0]
    assert found == sorted(expected, key=repr)


def test_a_hot_key_is_split(spark):
    """Both sides are shuffled for the join, also one that an aggregate has dealt out by the key before."""
    big = spark.range(1000).selectExpr("if(id < 600, 0, id) as k")
    small = spark.range(1000).selectExpr("id as k").groupBy("k").count()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    plan = joins.lookup(big, small, ["k"], fits=False)._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    above, below = plan.split("Coalesce")
    assert above.count("ENSURE_REQUIREMENTS") == 2 and "SortMergeJoin" in above


def test_sizes_are_measured(spark):
    df = spark.range(100).selectExpr("id", "repeat('x', 100) as s")
    assert joins.fits_broadcast(df)
    assert not joins.fits_broadcast(df, rows=99)
    assert not joins.fits_broadcast(df, size=1000)
    assert joins.fits_broadcast(df.select("id"), size=1600)


def test_operations_in_lower_case_and_unknown_ones(spark, rows):
    found = increment.net_changes(changes(spark, (1, 10, "I"), (1, 12, "d"), (2, 11, "u")), ["id"], 0)
    assert rows(found) == [(1, 12, "D"), (2, 11, "U")]
    for bad in ("X", None):
        with pytest.raises(Exception, match="unknown change operation"):
            increment.net_changes(changes(spark, (1, 10, "I"), (1, 12, bad)), ["id"], 0).collect()
