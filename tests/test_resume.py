import json
import random

import pytest
from pyspark.sql import functions as F

from tidemark.names import DELETED_AT
from tidemark.operators import ranges
from tidemark.operators.events import ENVELOPE, events_by_stream, with_position
from tidemark.operators.increment import cursor_increment
from tidemark.functions.predicates import cutoff
from tidemark.functions.values import stored_bound
from tidemark.streaming.once import newest_only
from tidemark.streaming.resume import ExpiredPosition, append_log, log_bounds, resume_run, resumed

DAY = 86_400_000


def events(spark, places):
    data = [(str(n), None, "{}", ("db", "c", ms, at, "false"), "c") for n, (ms, at) in enumerate(places)]
    return spark.createDataFrame(data, ENVELOPE)


@pytest.fixture
def log(spark, tmp_path):
    path = str(tmp_path / "log")
    first = events(spark, [(d * DAY + h * 3_600_000, h % 3) for d in range(4) for h in range(24)])
    append_log(first, path)
    return path, with_position(first).schema


def keys(spark, out, batch):
    return sorted(int(r.key) for r in spark.read.parquet(f"{out}/batch={batch}").collect())


def test_runs_go_on_from_the_stored_position(spark, log, tmp_path):
    path, schema = log
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    assert resume_run(spark, path, schema, out, state, "n", "s", until=(86_400 + 3_600, 1)) == (86_400 + 3_600, 1)
    assert keys(spark, out, 0) == list(range(26))
    # Later events belong to the next run.
    append_log(events(spark, [(9 * DAY, 1)]).withColumn("key", F.lit("96")), path)
    assert resume_run(spark, path, schema, out, state, "n", "s") == (9 * 86_400, 1)
    assert keys(spark, out, 1) == list(range(26, 97))
    assert resume_run(spark, path, schema, out, state, "n", "s") == (9 * 86_400, 1)
    assert log_bounds(spark, path, schema) == ((0, 0), (9 * 86_400, 1))


def test_a_run_that_died_is_done_again(spark, log, tmp_path):
    path, schema = log
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    resume_run(spark, path, schema, out, str(tmp_path / "lost"), "n", "s", until=(86_400, 0))
    # Its position was never stored; meanwhile the log has grown.
    append_log(events(spark, [(5 * DAY, 0)]).withColumn("key", F.lit("96")), path)
    resume_run(spark, path, schema, out, state, "n", "s")
    assert keys(spark, out, 0) == list(range(97))


def test_a_log_that_lost_its_start(spark, log):
    path, schema = log
    with pytest.raises(ExpiredPosition):
        resumed(spark, path, schema, (-5, 0))
    assert resumed(spark, path, schema, (0, 0)).isStreaming


def test_an_empty_log(spark, tmp_path):
    schema = with_position(events(spark, [(0, 0)])).schema
    assert log_bounds(spark, str(tmp_path / "none"), schema) == (None, None)
    assert resume_run(spark, str(tmp_path / "none"), schema, str(tmp_path / "o"), str(tmp_path / "s"), "n", "s") is None


def test_replays_and_older_changes_do_not_reach_storage(spark, tmp_path):
    rng = random.Random(2)
    rows = [(rng.randrange(6) if rng.random() < 0.5 else 0, n, n % 3, f"v{n}") for n in range(300)]
    shape = "id bigint, at bigint, ord int, v string"
    batches = [rows[:100], rows[:100], rows[100:200] + rows[:50], rows[250:], rows[200:250]]
    for n, batch in enumerate(batches):
        spark.createDataFrame(rng.sample(batch, len(batch)), shape).coalesce(1).write.parquet(str(tmp_path / "in" / str(n)))
    seen = []

    def store(batch, number):
        seen.append([tuple(r) for r in batch.collect()])

    stream = spark.readStream.schema(shape).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(str(tmp_path / "in"))
    newest = newest_only(stream, ["id"], ["at", "ord"])
    newest.writeStream.foreachBatch(store).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
    stored = [r for batch in seen for r in batch]
    assert len(stored) == len(set(stored)) < 40
    places = {}
    for r in stored:
        assert places.get(r[0], -1) < r[1]
        places[r[0]] = r[1]
    assert places == {k: max(r[1] for r in rows if r[0] == k) for k in {r[0] for r in rows}}


def test_order_columns_must_be_whole_numbers(spark):
    stream = spark.readStream.format("rate").load()
    with pytest.raises(ValueError):
        newest_only(stream, ["value"], ["timestamp"])


def test_records_have_the_fields_of_their_stream(spark):
    document = '{"_id":{"$oid":"aa"},"n":{"$numberLong":"5"},"s":{"a":[{"$date":7}],"gone":{"$minKey":1}},"t":"x\\"y","u":1.5,"z":null}'
    data = [(f'{{"$oid":"{n}"}}', None, document, ("db", c, 1000, 1, "false"), "u") for n, c in enumerate("abcd")]
    data += [('{"$oid":"zz"}', None, None, ("db", "a", 2000, 1, "false"), "d")]
    fields = [("db", "a", "_id", "string"), ("db", "a", "n", "integer"), ("db", "a", "t", "array"), ("db", "a", "s", "string")]
    fields += [("db", "b", "s", "object"), ("db", "b", "u", "Number"), ("db", "b", "z", "string"), ("db", "b", "missing", "string"), ("other", "c", "n", "number")]
    declared = spark.createDataFrame(fields, "namespace string, stream string, field string, type string")
    got = events_by_stream(spark.createDataFrame(data, ENVELOPE), declared, ["key"])
    found = {r.key[9:-2]: (r.stream, json.loads(r.text), r[DELETED_AT]) for r in got.withColumn("text", F.to_json("data")).collect()}
    inner = {"a": ["1970-01-01T00:00:00.007Z"]}
    assert found == {
        "0": ("a", {"_id": "aa", "n": 5, "t": ['x"y'], "s": json.dumps(inner, separators=(",", ":"))}, None),
        "1": ("b", {"s": inner, "u": 1.5, "z": None}, None),
        "2": ("c", {}, None),
        "3": ("d", {}, None),
        "zz": ("a", {"_id": "zz"}, "1970-01-01T00:00:02Z"),
    }


@pytest.mark.parametrize("kind", ["bigint", "int", "double", "date", "timestamp_ntz", "timestamp"])
def test_sketches_of_parts_cut_a_table_evenly(spark, kind):
    made = {"date": "date'1960-01-01' + cast(id as int)", "timestamp_ntz": "timestamp_ntz'1960-01-01 00:00:00.5' + make_dt_interval(id)"}
    made["timestamp"] = "timestamp_millis(id * 977 - 1000000)"
    df = spark.range(20_000).selectExpr(f"{made.get(kind, f'cast(id * 3 - 500 as {kind})')} as k", "id % 3 as part")
    parts = [ranges.key_sketch(df.where(F.col("part") == n), "k") for n in range(3)]
    merged = ranges.merge_sketches(parts[0].unionByName(parts[1]).unionByName(parts[2]))
    points = ranges.sketch_points(merged, 10)
    assert len(points) == 9 and points == sorted(points)
    counts = ranges.with_range(df, ["k"], points).groupBy("range").count().collect()
    assert len(counts) == 10 and max(r["count"] for r in counts) <= 2_100


def test_sketches_of_nothing(spark):
    none = spark.createDataFrame([(None,)], "k bigint")
    assert ranges.sketch_points(ranges.merge_sketches(ranges.key_sketch(none.limit(0), "k")), 4) == []
    assert ranges.sketch_points(ranges.key_sketch(none, "k"), 1) == []
    with pytest.raises(ValueError):
        ranges.key_sketch(spark.createDataFrame([("x",)], "k string"), "k")


def test_times_of_the_day_as_cursor(spark):
    import datetime as dt

    df = spark.createDataFrame([(1, "00:00:00"), (2, "06:00:00.5"), (3, "23:59:59"), (4, None)], "id int, at string")
    now = dt.datetime(2024, 5, 1, 12)
    assert cutoff(df, "at", now) is None and cutoff(df, "at", now, "time") == "00:00:00"
    read = cursor_increment(df, ["id"], "at", "06:00:00")
    assert sorted(r.id for r in read.rows.collect()) == [2, 3] and read.state["cursor"] == "23:59:59"
    none = cursor_increment(df, ["id"], "at", "06:00:00", cutoff="00:00:00")
    assert none.rows.collect() == [] and none.rows.columns == ["id", "at"] and none.state["cursor"] == "06:00:00"
    texts = spark.createDataFrame([("06:00:00",), ("06:00:00.25",), ("25:00:00",), ("soon",), ("",), (None,)], "t string")
    bounds = [r[0] for r in texts.select(stored_bound(F.col("t"), "time")).collect()]
    assert bounds == ["06:00:00.000000", "06:00:00.250000", "25:00:00", "soon", None, None]
