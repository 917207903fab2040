import dataclasses
import datetime as dt
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidemark.names import CURSOR, DELETED_AT
from tidemark.operators.events import ENVELOPE
from tidemark.plans.state import compact_state, read_state
from tidemark.sync import Collection, Store, SyncError, Table, current_rows, reset, sync_collections, sync_tables

NOW = dt.datetime(2024, 6, 1, 12)


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "out"), str(tmp_path / "state"))


def people(spark, rows):
    return spark.createDataFrame(rows, "id bigint, name string, at timestamp_ntz")


def day(n):
    return dt.datetime(2024, 1, n)


def table(spark, rows, **more):
    return Table("n", "people", people(spark, rows), ["id", "name", "at"], **{"keys": ["id"], "cursor": "at", **more})


def reads(plan):
    return [row["read"] for row in plan]


def saved(store, *columns):
    return sorted(tuple(r) for r in store.spark.read.parquet(store.folder("n", "people")).select(*columns).collect())


def test_cursor_runs(spark, store):
    rows = [(i, f"p{i}", day(1 + i // 10)) for i in range(100)]
    first = table(spark, rows)
    assert reads(sync_tables(store, [first], NOW, pieces=4)) == ["keyed_cursor"]
    assert saved(store, "id") == [(i,) for i in range(100)]
    assert {b for (b,) in saved(store, "batch")} == {0, 1, 2, 3}
    assert reads(sync_tables(store, [first], NOW)) == ["done"]

    later = table(spark, [*rows, (100, "new", day(20)), (101, "late", day(5))][1:])
    assert reads(sync_tables(store, [later], NOW)) == ["increment"]
    assert len(saved(store, "id")) == 101 and saved(store, "id")[-1] == (100,)
    changed = table(spark, [(3, "renamed", day(21))])
    sync_tables(store, [changed], NOW)
    newest = {r["id"]: r["name"] for r in current_rows(store, "n", "people", ["id"]).collect()}
    assert newest[3] == "renamed" and len(newest) == 101


def test_an_interrupted_snapshot_resumes(spark, store):
    rows = [(i, f"p{i}", day(1 + i // 10)) for i in range(100)]
    good = table(spark, rows)

    # The run dies while it writes the third piece.
    class Dying(Store):
        def save(self, namespace, stream, batch, frame, **state):
            if batch == 2:
                raise RuntimeError("lost")
            super().save(namespace, stream, batch, frame, **state)

    with pytest.raises(RuntimeError, match="lost"):
        sync_tables(Dying(spark, store.out, store.state), [good], NOW, pieces=5)
    half = len(saved(store, "id"))
    assert 0 < half < 100
    # Rows that changed in the part already read, after the bound taken at the first start.
    moved = table(spark, [*rows[1:], (0, "moved", day(25))])
    plan = sync_tables(store, [moved], NOW)
    assert reads(plan) == ["keyed_cursor"] and plan[0]["after_key"] is not None
    assert saved(store, "id") == [(i,) for i in range(100)]
    assert reads(sync_tables(store, [moved], NOW)) == ["increment"]
    assert {r["id"]: r["name"] for r in current_rows(store, "n", "people", ["id"]).collect()}[0] == "moved"


def test_full_refresh_and_reset(spark, store):
    rows = [(i, f"p{i}", day(1)) for i in range(20)]
    for keys, read in ((["id"], "keyed"), ([], "whole")):
        full = table(spark, rows, full_refresh=True, keys=keys)
        reset(store, "n", "people")
        assert reads(sync_tables(store, [full], NOW)) == [read]
        assert reads(sync_tables(store, [full], NOW)) == ["done"]


def test_today_is_left_out(spark, store):
    rows = [(1, "old", dt.datetime(2024, 5, 31)), (2, "today", dt.datetime(2024, 6, 1, 1)), (3, "none", None)]
    sync_tables(store, [table(spark, rows)], NOW, exclude_today=True)
    assert saved(store, "id") == [(1,)]
    sync_tables(store, [table(spark, rows)], NOW + dt.timedelta(days=1), exclude_today=True)
    assert saved(store, "id") == [(1,), (2,)]


def test_empty_tables_start_over(spark, store):
    assert reads(sync_tables(store, [table(spark, [])], NOW)) == ["keyed_cursor"]
    assert reads(sync_tables(store, [table(spark, [(1, "a", day(1))])], NOW)) == ["keyed_cursor"]
    assert saved(store, "id") == [(1,)]


def test_a_missing_cursor_is_an_error(spark, store):
    with pytest.raises(SyncError, match="people"):
        sync_tables(store, [table(spark, [], cursor=None)], NOW)


def test_tracking_runs(spark, store):
    schema = "id bigint, sys_change_version bigint, sys_change_operation string"
    rows = [(i, f"p{i}", day(1)) for i in range(10)]
    first = table(spark, rows, changes=spark.createDataFrame([], schema), version=5, min_valid_version=0)
    assert reads(sync_tables(store, [first], NOW, tracking=True, pieces=3)) == ["keyed"]
    assert reads(sync_tables(store, [first], NOW, tracking=True)) == ["done"]

    log = spark.createDataFrame([(2, 6, "D"), (3, 7, "U"), (50, 8, "I"), (4, 4, "U")], schema)
    now = [r for r in rows if r[0] != 2] + [(50, "new", day(2))]
    now[2] = (3, "changed", day(1))
    second = table(spark, now, changes=log, version=8, min_valid_version=0)
    assert reads(sync_tables(store, [second], NOW, tracking=True)) == ["changes"]
    newest = {r["id"]: (r["name"], r[DELETED_AT]) for r in current_rows(store, "n", "people", ["id"]).collect()}
    assert newest[2] == (None, "2024-06-01T12:00:00")
    assert newest[3] == ("changed", None) and newest[50] == ("new", None) and len(newest) == 11

    expired = dataclasses.replace(second, version=30, min_valid_version=9)
    with pytest.raises(Exception, match="expired"):
        sync_tables(store, [expired], NOW, tracking=True, fail_expired=True)
    plan = sync_tables(store, [expired], NOW, tracking=True)
    assert (plan[0]["rule"], plan[0]["read"]) == (2, "keyed")


def test_tables_without_keys_are_read_again_when_the_version_moves(spark, store):
    rows = [(1, "a", day(1)), (1, "a", day(1))]
    for version, read in ((5, "whole"), (5, "done"), (6, "whole")):
        plan = sync_tables(store, [table(spark, rows, keys=[], version=version)], NOW, tracking=True)
        assert reads(plan) == [read]
    assert len(saved(store, "id")) == 4


FIELDS = {"_id": "string", "v": "integer"}


def document(key, value):
    return json.dumps({"_id": key, "v": value})


def collection(spark, name, values, fields=FIELDS):
    docs = [(document(k, v),) for k, v in values.items()]
    return Collection("db", name, spark.createDataFrame(docs, "document string"), fields)


def log(spark, *rows):
    data = [
        (json.dumps(k), None, None if v is None else document(k, v), ("db", c, s * 1000, 1, "false"), "d" if v is None else "u")
        for c, k, v, s in rows
    ]
    return spark.createDataFrame(data, ENVELOPE)


def state_of(store, name):
    found = current_rows(store, "db", name, ["_id"])
    return {r["_id"]: (r["v"], r[DELETED_AT] is not None) for r in found.collect()}


def test_collection_runs(spark, store):
    one = collection(spark, "one", {"a": 1, "b": 2})
    old = ("one", "a", 1, 10)
    assert sync_collections(store, [one], log(spark, old), NOW) == "snapshot, changes"
    assert state_of(store, "one") == {"a": (1, False), "b": (2, False)}

    # One collection joins; the other reads its changes first.
    two = collection(spark, "two", {"x": 7})
    changes = [old, ("one", "a", 5, 11), ("one", "b", None, 12), ("one", "c", 3, 13), ("two", "x", 6, 13), ("three", "q", 1, 13)]
    assert sync_collections(store, [one, two], log(spark, *changes), NOW) == "changes, snapshot"
    assert state_of(store, "one") == {"a": (5, False), "b": (None, True), "c": (3, False)}
    assert state_of(store, "two") == {"x": (7, False)}

    more = [*changes[1:], ("one", "b", 9, 14), ("two", "x", 8, 15), ("two", "y", 1, 16)]
    assert sync_collections(store, [one, two], log(spark, *more), NOW) == "changes"
    assert state_of(store, "one")["b"] == (9, False)
    assert state_of(store, "two") == {"x": (8, False), "y": (1, False)}
    cursors = [r[CURSOR] for r in spark.read.parquet(store.folder("db", "two")).where("batch = 1").collect()]
    start = int(NOW.replace(tzinfo=dt.timezone.utc).timestamp()) * 100_000_000
    assert sorted(cursors) == [start + 1, start + 2]


def test_a_snapshot_that_died_goes_on_after_its_last_chunk(spark, store, monkeypatch):
    values = {f"k{i:02d}": i for i in range(25)}
    one = collection(spark, "one", values)
    write, seen = Store.write, []

    def dying(self, namespace, stream, batch, rows):
        if batch == 2:
            raise RuntimeError("lost")
        seen.append(batch)
        write(self, namespace, stream, batch, rows)

    monkeypatch.setattr(Store, "write", dying)
    with pytest.raises(RuntimeError, match="lost"):
        sync_collections(store, [one], log(spark, ("one", "k00", 0, 10)), NOW, chunk_rows=5)
    monkeypatch.setattr(Store, "write", write)
    state = {r["stream"]: r for r in read_state(spark, store.state).collect()}["one"]
    assert (state["status"], state["key"], state["id_type"], seen) == ("IN_PROGRESS", ["k09"], "string", [0, 1])

    # A document of the first chunk changes before the next run.
    changed = log(spark, ("one", "k00", 0, 10), ("one", "k03", 333, 11), ("one", "k20", 20, 12))
    assert sync_collections(store, [one], changed, NOW, chunk_rows=5) == "changes, snapshot"
    assert state_of(store, "one") == {k: (333 if k == "k03" else v, False) for k, v in values.items()}
    rows = spark.read.parquet(store.folder("db", "one"))
    found = rows.where("_id <> 'k03' and _id <> 'k20'").groupBy("_id").count().collect()
    assert len(found) == 23 and {r["count"] for r in found} == {1}
    assert {r["stream"]: r["status"] for r in read_state(spark, store.state).collect()}["one"] == "COMPLETE"


def test_unknown_events_are_set_aside(spark, store):
    one = collection(spark, "one", {"a": 1})
    sync_collections(store, [one], log(spark, ("one", "a", 1, 10)), NOW)
    more = log(spark, ("one", "a", 1, 10), ("one", "a", 2, 11)).withColumn("op", F.when(F.col("after").contains("2"), "u").otherwise("r"))
    odd = more.unionByName(log(spark, ("one", "b", 5, 12)).withColumn("op", F.lit("t")))
    with pytest.warns(UserWarning, match="unknown"):
        sync_collections(store, [one], odd, NOW)
    assert state_of(store, "one") == {"a": (2, False)}
    assert spark.read.parquet(f"{store.out}/_unknown").count() == 1


def test_a_run_adds_few_state_files(spark, store):
    three = [collection(spark, name, {"a": 1}) for name in ("one", "two", "three")]
    first = log(spark, ("one", "a", 1, 10))
    sync_collections(store, three, first, NOW)
    files = len(spark.read.parquet(store.state).inputFiles())
    sync_collections(store, three, first.unionByName(log(spark, ("two", "a", 2, 11))), NOW)
    assert len(spark.read.parquet(store.state).inputFiles()) == files + 2
    before = sorted(map(str, read_state(spark, store.state).collect()))
    compact_state(spark, store.state)
    assert len(spark.read.parquet(store.state).inputFiles()) == 1
    assert sorted(map(str, read_state(spark, store.state).collect())) == before
    assert sync_collections(store, three, first.unionByName(log(spark, ("two", "a", 3, 12))), NOW) == "changes"
    assert state_of(store, "two") == {"a": (3, False)}


def test_a_purged_log_fails_or_starts_over(spark, store):
    one = collection(spark, "one", {"a": 1})
    sync_collections(store, [one], log(spark, ("one", "a", 1, 10)), NOW)
    purged = log(spark, ("one", "a", 2, 50))
    with pytest.raises(SyncError, match="no longer holds"):
        sync_collections(store, [one], purged, NOW)
    again = collection(spark, "one", {"a": 2})
    assert sync_collections(store, [again], purged, NOW, fail_invalid=False) == "snapshot, changes"
    assert state_of(store, "one") == {"a": (2, False)}


def test_an_empty_log_loses_nothing(spark, store):
    one = collection(spark, "one", {"a": 1})
    sync_collections(store, [one], log(spark), NOW)
    assert sync_collections(store, [one], log(spark, ("one", "a", 4, 3)), NOW) == "changes"
    assert state_of(store, "one") == {"a": (4, False)}


def test_packed_collections(spark, store):
    one = collection(spark, "one", {"a": 1}, fields=None)
    sync_collections(store, [one], log(spark, ("one", "a", 1, 1)), NOW)
    sync_collections(store, [one], log(spark, ("one", "a", 1, 1), ("one", "a", 2, 2)), NOW)
    found = current_rows(store, "db", "one", ["_id"]).select("_id", F.to_json("data"))
    assert [tuple(r) for r in found.collect()] == [("a", '{"_id":"a","v":2}')]


def test_full_refresh_collections_have_no_stamps(spark, store):
    one = dataclasses.replace(collection(spark, "one", {"a": 1}), full_refresh=True)
    for _ in range(2):
        sync_collections(store, [one], log(spark, ("one", "a", 1, 1)), NOW)
    rows = spark.read.parquet(store.folder("db", "one"))
    assert rows.columns == ["_id", "v", "batch"] and rows.count() == 2


def test_unsupported_ids_are_an_error(spark, store):
    one = collection(spark, "one", {"a": 1})
    bad = dataclasses.replace(one, documents=spark.createDataFrame([('{"_id":1.5}',)], "document string"))
    with pytest.raises(SyncError, match="double"):
        sync_collections(store, [bad], log(spark), NOW)
    mixed = dataclasses.replace(one, documents=spark.createDataFrame([('{"_id":1}',), ('{"_id":"b"}',)], "document string"))
    with pytest.warns(UserWarning, match="several types"):
        sync_collections(store, [mixed], log(spark), NOW)


def test_runs_over_many_streams_keep_a_short_state_log(spark, store, monkeypatch):
    import tidemark.sync as sync

    monkeypatch.setattr(sync, "STATE_FILES", 6)
    tables = [Table("n", f"t{i}", people(spark, [(n, "x", day(1 + n)) for n in range(3)]), ["id", "name", "at"], keys=["id"], cursor="at") for i in range(9)]
    assert reads(sync_tables(store, tables, NOW)) == ["keyed_cursor"] * 9
    states = read_state(spark, store.state).collect()
    assert {(r["stream"], r["status"]) for r in states} == {(f"t{i}", "cursor") for i in range(9)}
    assert len(list(Path(store.state).glob("*.parquet"))) <= 6
    assert reads(sync_tables(store, tables, NOW)) == ["done"] * 9


def test_a_table_that_fails_leaves_the_others_alone(spark, store):
    good = table(spark, [(1, "a", day(1))])
    bad = dataclasses.replace(good, stream="bad", rows=good.rows.withColumn("name", F.raise_error(F.lit("broken"))))
    with pytest.raises(Exception, match="broken"):
        sync_tables(store, [bad, good], NOW)
    assert saved(store, "id") == [(1,)]
