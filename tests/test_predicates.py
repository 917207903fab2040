import datetime as dt
import itertools

import pytest
from pyspark.sql import functions as F

from tidemark.functions.predicates import before, bound, cutoff, key_after, key_range, sql_range

KEYS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def cube(spark):
    tuples = list(itertools.product(range(4), "xyz", (0.5, 1.5)))
    return tuples, spark.createDataFrame(tuples, "a bigint, b string, c double").cache()


@pytest.mark.parametrize("lower", [None, (1, "y", 0.5), (3, "z", 1.5), (0, "", 0.0)])
@pytest.mark.parametrize("upper", [None, (2, "x", 0.5), (0, "x", 0.5), (9, "z", 1.5)])
def test_key_range_is_tuple_order(cube, lower, upper):
    tuples, df = cube
    expected = sorted(t for t in tuples if (lower is None or t > lower) and (upper is None or t <= upper))
    assert sorted(map(tuple, df.where(key_range(df, KEYS, lower, upper)).collect())) == expected
    assert sorted(map(tuple, df.where(sql_range(KEYS, lower, upper)).collect())) == expected


def test_inclusive_lower_bound(cube):
    tuples, df = cube
    at = (1, "y", 0.5)
    assert df.where(key_after(df, KEYS, at, inclusive=True)).count() == sum(t >= at for t in tuples)


def test_bounds_reach_the_parquet_reader(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).selectExpr("id", "timestamp_ntz'2024-01-01' + make_dt_interval(cast(id as int)) as at").write.parquet(path)
    df = spark.read.parquet(path)
    plan = df.where(key_range(df, ["at"], (dt.datetime(2024, 1, 5),), ("2024-02-01T00:00:00",)))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(at,2024-01-05T00:00" in text and "LessThanOrEqual(at,2024-02-01T00:00" in text
    assert plan.count() == 27


def test_quotes_and_missing_values_in_sql_ranges(spark):
    df = spark.createDataFrame([("o'b",), ("p",)], "k string")
    assert df.where(sql_range(["k"], ("o'a",), ("o'c",))).count() == 1
    assert df.where(sql_range(["k"], None, (None,))).count() == 0
    assert df.where(sql_range(["k"], None, None)).count() == 2


def test_binary_bounds_are_base64_text(spark):
    df = spark.createDataFrame([(b"\x01\x02",), (b"\x03",)], "k binary")
    assert df.where(F.col("k") == bound(df, "k", "AQI=")).count() == 1


def test_cutoff_is_the_start_of_the_utc_day(spark):
    df = spark.sql("select date'2024-01-01' d, timestamp_ntz'2024-01-01 00:00:00' n, timestamp'2024-01-01' t, 1 i")
    now = dt.datetime(2024, 5, 1, 22, 30, tzinfo=dt.timezone(dt.timedelta(hours=-5)))
    assert cutoff(df, "d", now) == dt.date(2024, 5, 2)
    assert cutoff(df, "n", now) == dt.datetime(2024, 5, 2)
    assert cutoff(df, "t", now) == dt.datetime(2024, 5, 2, tzinfo=dt.timezone.utc)
    assert cutoff(df, "i", now) is None


def test_no_cutoff_keeps_rows_without_cursor(spark):
    df = spark.createDataFrame([(1,), (None,)], "k int")
    assert df.where(before(df, "k", None)).count() == 2
    assert df.where(before(df, "k", 5)).count() == 1
