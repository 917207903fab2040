import bisect
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import ranges, snapshot


@pytest.fixture(scope="module")
def pairs(spark):
    random.seed(3)
    tuples = sorted({(random.randrange(40), "".join(random.choices("abcd", k=3))) for _ in range(600)})
    shuffled = random.sample(tuples, len(tuples))
    return tuples, spark.createDataFrame(shuffled, "a bigint, b string").repartition(5).cache()


@pytest.mark.parametrize("count", [1, 2, 3, 7, 50])
def test_range_numbers_match_bisect(pairs, count):
    tuples, df = pairs
    points = ranges.split_points(df, ["a", "b"], count)
    assert len(points) <= count - 1 and points == sorted(points)
    found = ranges.with_range(df, ["a", "b"], points).collect()
    assert all(n == bisect.bisect_left(points, (a, b)) for a, b, n in found)


@pytest.mark.parametrize(
    "kind", ["string", "double", "date", "timestamp", "timestamp_ntz", "decimal(9,2)", "binary", "int", "boolean"]
)
def test_ranges_of_all_types(spark, kind):
    sources = {"date": "date'2024-02-01' + cast(id as int)", "boolean": "id < 40", "binary": "cast(cast(id as string) as binary)"}
    times = "timestamp_ntz'2024-03-10 00:30:00.25' + make_dt_interval(0, cast(id as int))"
    value = sources.get(kind, times if kind.startswith("timestamp") else "id / 4")
    df = spark.range(80).selectExpr(f"cast({value} as {kind}) as k", "id")
    points = ranges.split_points(df, ["k"], 9)
    assert 0 < len(points) <= 8
    cut = ranges.split_ranges(points, upper=ranges.max_key(df, ["k"]))
    ids = [sorted(r["id"] for r in part.collect()) for part in ranges.read_ranges(df, ["k"], cut)]
    assert sorted(i for part in ids for i in part) == list(range(80))
    numbers = {r["id"]: r["range"] for r in ranges.with_range(df, ["k"], points).collect()}
    assert all(numbers[i] == place for place, part in enumerate(ids) for i in part)


def test_ranges_cover_every_key_once(pairs):
    tuples, df = pairs
    points = ranges.split_points(df, ["a", "b"], 6)
    cut = ranges.split_ranges(points, lower=tuples[10], upper=tuples[-5])
    found = [tuple(r) for part in ranges.read_ranges(df, ["a", "b"], cut) for r in part.collect()]
    assert sorted(found) == tuples[11:-4]


def test_points_outside_the_bounds_are_left_out():
    assert ranges.split_ranges([(1,), (5,), (9,)], (1,), (9,)) == [((1,), (5,)), ((5,), (9,))]
    assert ranges.split_ranges([], None, None) == [(None, None)]


@pytest.mark.parametrize("partitions", ["1", "4", "64"])
def test_dense_numbers(spark, pairs, partitions):
    tuples, df = pairs
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    numbered = ranges.with_dense_number(df, ["a", "b"], "n")
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert sorted((n, (a, b)) for a, b, n in numbered.collect()) == list(enumerate(tuples, 1))


def test_dense_numbers_of_a_hot_key(spark):
    """A third of the rows are copies of one row, some more share its key."""
    random.seed(5)
    rows = [(500, 0)] * 700 + [(500, i) for i in range(100)] + [(random.randrange(1000), 1) for _ in range(1300)]
    df = spark.createDataFrame(random.sample(rows, len(rows)), "k bigint, v bigint").repartition(6)
    numbered = ranges.with_dense_number(df, ["k"], "n")
    found = sorted(numbered.collect(), key=lambda r: r["n"])
    assert [r["n"] for r in found] == list(range(1, len(rows) + 1))
    assert [r["k"] for r in found] == sorted(k for k, _ in rows)
    assert sorted((r["k"], r["v"]) for r in found) == sorted(rows)
    # Numbers depend on the rows alone, not on how they are dealt out.
    again = ranges.with_dense_number(df.repartition(3), ["k"], "n").collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, found))


def test_a_hot_key_is_dealt_out(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    df = spark.range(4000).selectExpr("if(id % 2 = 0, 7, id) as k", "id as v")
    ranges_of = ranges.with_dense_number(df, ["k"], "n").where("k = 7").groupBy(F.spark_partition_id()).count().collect()
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(ranges_of) >= 3


def test_dense_numbers_of_times_and_nothing(spark):
    df = spark.range(300).selectExpr("timestamp_ntz'2024-03-10 00:00:00' + make_dt_interval(0, cast(299 - id as int)) as t")
    numbered = ranges.with_dense_number(df, ["t"], "n").orderBy("t").collect()
    assert [r["n"] for r in numbered] == list(range(1, 301))
    assert ranges.with_dense_number(df.where("false"), ["t"], "n").count() == 0


def test_chunks_are_those_of_limited_reads(pairs):
    tuples, df = pairs
    chunks = ranges.chunk_scan(df, ["a", "b"], 100, after=tuples[9])
    rest = tuples[10:]
    found = {(r["a"], r["b"]): r["chunk"] for r in chunks.collect()}
    assert found == {t: i // 100 for i, t in enumerate(rest)}
    saved = ranges.checkpoints(chunks, ["a", "b"]).orderBy("chunk").collect()
    assert [tuple(r["last_key"]) for r in saved] == [rest[min(i + 99, len(rest) - 1)] for i in range(0, len(rest), 100)]
    assert [r["status"] for r in saved] == ["IN_PROGRESS"] * (len(saved) - 1) + ["COMPLETE"]
    assert sum(r["rows"] for r in saved) == len(rest)


def test_largest_keys(spark, pairs):
    tuples, df = pairs
    assert ranges.max_key(df, ["a", "b"]) == tuples[-1]
    assert ranges.max_key(df, ["a"]) == (tuples[-1][0],)
    assert ranges.max_key(df.where("false"), ["a"]) is None


def test_snapshots_resume_and_stop(pairs):
    tuples, df = pairs
    read = snapshot.snapshot_range(df, ["b"], ["a", "b"], lower=tuples[99])
    assert read.rows.columns == ["b", "a"] and read.rows.count() == len(tuples) - 100
    assert read.state["pk_val"] == tuples[-1]
    again = snapshot.snapshot_range(df, ["b"], ["a", "b"], lower=tuples[-1])
    assert again.rows.count() == 0 and again.state["pk_val"] == tuples[-1]
    assert snapshot.snapshot_range(df.where("false"), ["b"], ["a", "b"]).rows.count() == 0


def test_samples(pairs):
    tuples, df = pairs
    first = snapshot.sample_rows(df, 20, keys=["a", "b"]).collect()
    assert [tuple(r) for r in first] == tuples[:20]
    part = [tuple(r) for r in snapshot.sample_rows(df, 20, 0.5, ["a", "b"]).collect()]
    assert len(part) == 20 and part == sorted(part) and set(part) <= set(tuples) and part != tuples[:20]
    assert snapshot.sample_rows(df, 7).count() == 7
