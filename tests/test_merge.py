import json
import random

import pytest
from pyspark.sql import functions as F

from tidemark.names import DELETED_AT
from tidemark.operators.events import ENVELOPE, events_to_rows
from tidemark.operators.merge import apply_changes, latest_per_key
from tidemark.streaming import changes as streams

SCHEMA = "id bigint, v bigint, at bigint, _ab_cdc_deleted_at string"


def log(seed, count=3000):
    """A third of all changes hit one key; some changes come twice."""
    random.seed(seed)
    rows = []
    for at in range(count):
        key = 0 if random.random() < 0.34 else random.randrange(200)
        rows.append((key, random.randrange(1000), at, "now" if random.random() < 0.2 else None))
    return rows + random.sample(rows, count // 10)


def merged(base, changes, hard):
    state = {r[0]: r for r in base}
    for row in sorted(set(changes), key=lambda r: r[2]):
        state[row[0]] = row
    return sorted((r for r in state.values() if not (hard and r[3])), key=repr)


@pytest.mark.parametrize("hard", [False, True])
def test_apply_changes(spark, rows, hard):
    base = [(i, -i, -1, None) for i in range(0, 400, 3)]
    target, changes = spark.createDataFrame(base, SCHEMA), spark.createDataFrame(log(1), SCHEMA)
    once = apply_changes(target, changes, ["id"], ["at"], hard=hard)
    assert rows(once) == merged(base, log(1), hard)
    assert rows(apply_changes(once, changes, ["id"], ["at"], hard=hard)) == rows(once)


def test_latest_per_key_orders_by_all_columns(spark, rows):
    df = spark.createDataFrame([(1, 5, 1, "a"), (1, 5, 2, "b"), (1, 4, 9, "c"), (2, 0, 0, None)], "k int, s int, o int, v string")
    assert rows(latest_per_key(df, ["k"], ["s", "o"])) == [(1, 5, 2, "b"), (2, 0, 0, None)]
    assert latest_per_key(df, ["k"], ["s"]).columns == df.columns


FIELDS = {"_id": "string", "v": "integer", "tags": "array"}


def write_events(spark, folder, name, rows):
    """One file of change events: (id, value or None for a delete, order)."""
    data = []
    for key, value, order in rows:
        after = None if value is None else json.dumps({"_id": key, "v": value, "tags": [value]})
        data.append((key, None, after, ("db", "c", order * 1000, 1, "false"), "d" if value is None else "u"))
    spark.createDataFrame(data, ENVELOPE).coalesce(1).write.parquet(f"{folder}/{name}")


def test_stream_keeps_the_current_state(spark, rows, tmp_path):
    source, store, progress = (str(tmp_path / n) for n in ("in", "changes", "progress"))
    keys, order = ["_id"], ["position"]

    def run():
        # One folder per arrival, one file per batch.
        stream = spark.readStream.schema(ENVELOPE).option("maxFilesPerTrigger", 1).parquet(source + "/*")
        streams.store_changes(events_to_rows(stream, FIELDS), store, progress, keys, order).awaitTermination()
        return streams.stored_changes(spark, store)

    write_events(spark, source, "a", [("x", 1, 1), ("y", 2, 2), ("x", 3, 3)])
    write_events(spark, source, "b", [("y", None, 4)])
    first = run()
    assert first.count() == 3  # two keys in one batch, one in the other
    base = first.where("false").select("_id", "v", "tags", "_ab_cdc_updated_at", DELETED_AT)

    def shown(df):
        return rows(df.select("_id", "v", F.to_json("tags"), F.col(DELETED_AT).isNotNull()))

    state = streams.current(base, first, keys, order)
    assert shown(state) == [("x", 3, "[3]", False), ("y", None, None, True)]
    folded = streams.fold(base, first, str(tmp_path / "base"), keys, order)
    assert shown(folded) == shown(state)

    write_events(spark, source, "c", [("y", 7, 5), ("z", 8, 6)])
    later = run()
    newest = later.count()
    assert newest == 5
    fresh = streams.stored_changes(spark, store, after_batch=1)
    expected = [("x", 3, "[3]", False), ("y", 7, "[7]", False), ("z", 8, "[8]", False)]
    assert shown(streams.current(folded, fresh, keys, order)) == expected
    # Applying everything once more changes nothing.
    assert shown(streams.current(folded, later, keys, order)) == expected
    assert shown(streams.current(folded, later, keys, order, hard=True)) == expected


def test_an_older_change_does_not_replace_a_newer_row(spark, rows):
    shape = f"id int, v string, at int, {DELETED_AT} string"
    base = spark.createDataFrame([(1, "new", 9, None), (2, "old", 1, None), (3, "first", None, None), (4, "kept", 2, None)], shape)
    changes = spark.createDataFrame([(1, "late", 5, None), (2, "next", 3, None), (3, "next", 3, None), (5, None, 4, "gone")], shape)
    want = [(1, "new", 9, None), (2, "next", 3, None), (3, "next", 3, None), (4, "kept", 2, None), (5, None, 4, "gone")]
    once = apply_changes(base, changes, ["id"], ["at"])
    assert rows(once) == want and rows(apply_changes(once, changes, ["id"], ["at"])) == want
    assert rows(apply_changes(base, changes, ["id"], ["at"], hard=True)) == want[:4]


def test_deletes_by_binary_and_uuid_ids_meet_their_documents(spark, rows):
    keys = ['{"$binary":{"base64":"AQIDBA==","subType":"00"}}', '{"$uuid":"00112233-4455-6677-8899-aabbccddeeff"}', '{"$date":7}', '"plain"']
    source = ("db", "c", 1000, 1, "false")
    born = [(k, None, f'{{"_id":{k},"v":1}}', source, "c") for k in keys]
    gone = [(k, None, None, ("db", "c", 2000, 1, "false"), "d") for k in keys]
    log = spark.createDataFrame(born + gone, ENVELOPE)
    for fields in ({"_id": "string", "v": "integer"}, None):
        changes = events_to_rows(log, fields)
        base = changes.where("false").drop("position")
        assert apply_changes(base, changes, ["_id"], ["position"], hard=True).count() == 0
        assert apply_changes(base, changes, ["_id"], ["position"]).count() == len(keys)
