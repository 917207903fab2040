import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tidemark.names import CURSOR, DELETED_AT, UPDATED_AT
from tidemark.operators import events
from tidemark.operators.increment import current_images

OID = "64f24244f95155351c4185b1"
DOC = json.dumps(
    {
        "_id": {"$oid": OID},
        "name": "first",
        "doubleField": 42.42,
        "intField": 1,
        "data": "not declared",
        "objectField": {"key": "value"},
        "timestamp": {"$timestamp": {"t": 394, "i": 1381162128}},
    }
)
FIELDS = {
    "_id": "string",
    "name": "string",
    "doubleField": "number",
    "intField": "integer",
    "objectField": "object",
    "timestamp": "string",
}
KEY = f'{{"$oid": "{OID}"}}'
SOURCE = ("db", "coll", 1693598277000, 1, "false")
STAMP = "2023-09-01T19:57:57Z"
FULL = (OID, "first", 42.42, 1, '{"key":"value"}', "2023-09-01T19:57:56.752Z")
ONLY_ID = (OID, None, None, None, None, None)


def frame(spark, *rows):
    return spark.createDataFrame([(KEY, b, a, SOURCE, op) for op, b, a in rows], events.ENVELOPE)


def converted(df):
    shown = [F.to_json(c).alias(c) if c == "objectField" else c for c in FIELDS]
    return tuple(events.events_to_rows(df, FIELDS).select(*shown, UPDATED_AT, DELETED_AT).first())


@pytest.mark.parametrize(
    "op, before, after, expected",
    [
        ("c", None, DOC, (*FULL, STAMP, None)),
        ("i", None, DOC + '"', (*FULL, STAMP, None)),
        ("u", DOC.replace("first", "old"), DOC, (*FULL, STAMP, None)),
        ("u", DOC, None, (*FULL, STAMP, None)),
        ("u", None, None, (*ONLY_ID, STAMP, STAMP)),
        ("d", DOC, None, (*FULL, STAMP, STAMP)),
        ("d", None, None, (*ONLY_ID, STAMP, STAMP)),
    ],
)
def test_events_become_rows(spark, op, before, after, expected):
    assert converted(frame(spark, (op, before, after))) == expected


def test_packed_rows(spark):
    df = events.events_to_rows(frame(spark, ("d", None, None), ("c", None, DOC)))
    rows = df.select("_id", F.to_json("data"), DELETED_AT).collect()
    assert tuple(rows[0]) == (OID, f'{{"_id":"{OID}"}}', STAMP)
    packed = json.loads(rows[1][1])
    assert packed["data"] == "not declared" and packed["_id"] == OID


@pytest.mark.parametrize("op", ["r", "t", None])
def test_unknown_operations_fail_or_are_set_aside(spark, op):
    df = frame(spark, (op, None, DOC), ("c", None, DOC))
    with pytest.raises(Exception, match="unsupported change operation"):
        events.events_to_rows(df, FIELDS).collect()
    known, others = events.known_events(df)
    assert (events.events_to_rows(known, FIELDS).count(), others.count()) == (1, 1)


@pytest.mark.parametrize(
    "key, expected",
    [(KEY, OID), ('"quoted"', "quoted"), ("17", "17"), ('{"$numberLong": "5"}', "5"), ('{"$binary": "x"}', "x"), ('{"$binary":{"base64":"AQIDBA==","subType":"00"}}', "AQIDBA=="), ('{"$date":0}', "1970-01-01T00:00:00.000Z"),
     ('{"$uuid":"00112233-4455-6677-8899-aabbccddeeff"}', "ABEiM0RVZneImaq7zN3u/w=="), ("a text", "a text"), ('"a\\"b"', 'a"b')],
)
def test_key_ids(spark, key, expected):
    assert spark.range(1).select(events.key_id(F.lit(key))).first()[0] == expected


def test_envelopes_from_a_message_log(spark):
    body = json.dumps({"after": DOC, "op": "c", "source": {"db": "db", "collection": "coll", "ts_ms": 1, "ord": 2}})
    messages = spark.createDataFrame([(json.dumps({"id": KEY}).encode(), body.encode())], "key binary, value binary")
    row = events.parse_envelopes(messages, "value", "key").first()
    assert (row["key"], row["after"], row["op"], row["source"]["ord"]) == (KEY, DOC, "c", 2)


def positioned(spark, *rows):
    return spark.createDataFrame([(KEY, None, DOC, ("db", "c", ms, o, s), "u") for ms, o, s in rows], events.ENVELOPE)


def test_bounded_runs(spark):
    df = positioned(spark, (1000, 1, "false"), (1999, 2, None), (2000, 1, "false"), (2000, 2, "false"), (9000, 1, "true"), (9000, 1, "last"))
    kept = events.bounded(df, (2, 1), after=(1, 1))
    found = {(r["source"]["ts_ms"], r["source"]["ord"], r["source"]["snapshot"]) for r in kept.collect()}
    assert found == {(1999, 2, None), (2000, 1, "false"), (9000, 1, "true"), (9000, 1, "last")}
    assert kept.count() == 4
    # Snapshot events that an earlier run has met don't come again.
    assert events.bounded(df, (2, 1), after=(9, 1)).count() == 0
    assert events.latest_position(df) == (9, 1)
    assert events.latest_position(df.where("false")) is None


def test_streams_are_named_by_database_and_collection(spark):
    df = positioned(spark, (1, 1, "false"))
    wanted = spark.createDataFrame([("db", "c"), ("db", "c"), ("other", "c")], "namespace string, stream string")
    assert events.include_streams(df, wanted).count() == 1
    assert events.include_streams(df, wanted.where("namespace = 'other'")).count() == 0


def test_cursor_counts_from_one(spark):
    df = spark.range(1000).selectExpr("1000 - id as k")
    stamped = events.with_cursor(df, ["k"], dt.datetime(1970, 1, 1, 0, 0, 7, 900_000))
    assert [(r["k"], r[CURSOR]) for r in stamped.orderBy("k").collect()] == [(i, 700_000_000 + i) for i in range(1, 1001)]


def test_full_refresh_rows_get_no_stamps(spark):
    df = spark.range(3).selectExpr("cast(id as string) as _id")
    assert events.stamp_snapshot(df, 1, incremental=False).columns == ["_id"]
    row = events.stamp_snapshot(df, 1616775646886).orderBy("_id").first()
    assert (row[UPDATED_AT], row[DELETED_AT], row[CURSOR]) == ("2021-03-26T16:20:46.886Z", None, 161677564600000001)


def test_lookup_capture_takes_current_documents(spark):
    changed = frame(spark, ("u", None, DOC), ("c", None, DOC))
    now = spark.createDataFrame([(KEY, "NOW")], "key string, document string")
    found = current_images(changed, now, ["key"])
    assert sorted((r["op"], r["after"]) for r in found.collect()) == [("c", DOC), ("u", "NOW")]
    lost = current_images(changed, now.where("false"), ["key"])
    assert {r["op"]: r["after"] for r in lost.collect()} == {"c": DOC, "u": None}
