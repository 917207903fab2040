import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidemark.operators.buckets import BucketTable, bucket_of
from tidemark.operators.joins import may_hold

SHAPE = "id bigint, v string, at bigint, _ab_cdc_deleted_at string"


def files(folder):
    return {str(p): p.stat().st_mtime_ns for p in Path(folder).rglob("*.parquet")}


def table_of(spark, tmp_path, rows, buckets=8):
    stored = BucketTable(spark, str(tmp_path / "t"), ["id"], buckets)
    assert stored.create(spark.createDataFrame(rows, SHAPE)) == 0
    return stored


def test_only_touched_buckets_are_written(spark, rows, tmp_path):
    base = [(i, f"v{i}", 0, None) for i in range(200)]
    stored = table_of(spark, tmp_path, base)
    before = files(tmp_path)
    changes = spark.createDataFrame([(3, "new", 5, None), (3, "older", 4, None), (1000, "added", 1, None)], SHAPE)
    assert stored.apply(changes, ["at"]) == 1
    touched = {r[0] for r in changes.select(bucket_of(["id"], 8)).collect()}
    after = files(tmp_path)
    assert {p: after.get(p) for p in before} == before
    fresh = {int(p.split("bucket=")[1].split("/")[0]) for p in after.keys() - before.keys()}
    assert fresh == touched and len(touched) < 8
    want = sorted([r for r in base if r[0] != 3] + [(3, "new", 5, None), (1000, "added", 1, None)], key=repr)
    assert rows(stored.read()) == want
    assert rows(stored.read(0)) == sorted(base, key=repr)


@pytest.mark.parametrize("hard", [False, True])
def test_against_a_dictionary(spark, rows, tmp_path, hard):
    rng = random.Random(1)
    base = [(i, "base", -1, None) for i in range(50)]
    stored, state = table_of(spark, tmp_path, base, 5), {r[0]: r for r in base}
    for run in range(3):
        changes = [(rng.randrange(80), f"r{run}", run * 100 + n, "now" if rng.random() < 0.3 else None) for n in range(40)]
        stored.apply(spark.createDataFrame(changes, SHAPE), ["at"], hard=hard)
        for row in changes:
            state[row[0]] = row
        kept = [r for r in state.values() if not (hard and r[3])]
        assert rows(stored.read()) == sorted(kept, key=repr)
        state = {r[0]: r for r in kept} if hard else state
    if not hard:
        # The last changes again, and older ones: nothing is rolled back.
        stored.apply(spark.createDataFrame(changes + [(r[0], "old", -2, None) for r in kept], SHAPE), ["at"])
        assert rows(stored.read()) == sorted(kept, key=repr)


def test_a_run_that_dies_before_its_version_is_known(spark, rows, tmp_path):
    base = [(i, "base", 0, None) for i in range(20)]
    stored = table_of(spark, tmp_path, base)
    stored.apply(spark.createDataFrame([(1, "x", 1, None)], SHAPE), ["at"])
    # As if the second version had been written without its entry.
    for p in Path(tmp_path / "t" / "versions" / "1").iterdir():
        p.unlink()
    assert stored.version() == 0 and rows(stored.read()) == sorted(base, key=repr)
    assert stored.apply(spark.createDataFrame([(2, "y", 2, None)], SHAPE), ["at"]) == 1
    assert rows(stored.read()) == sorted([r for r in base if r[0] != 2] + [(2, "y", 2, None)], key=repr)


def test_empty_tables_and_nothing_to_do(spark, rows, tmp_path):
    stored = table_of(spark, tmp_path, [])
    assert rows(stored.read()) == [] and stored.apply(spark.createDataFrame([], SHAPE), ["at"]) == 0
    stored.apply(spark.createDataFrame([(1, "x", 1, "gone"), (2, "y", 1, None)], SHAPE), ["at"], hard=True)
    assert rows(stored.read()) == [(2, "y", 1, None)]
    stored.apply(spark.createDataFrame([(2, "y", 2, "gone")], SHAPE), ["at"], hard=True)
    assert rows(stored.read()) == []
    with pytest.raises(ValueError):
        stored.create(spark.createDataFrame([], SHAPE))
    with pytest.raises(ValueError):
        stored.read(9)


def test_vacuum_keeps_what_the_newest_versions_need(spark, rows, tmp_path):
    stored = table_of(spark, tmp_path, [(i, "base", 0, None) for i in range(40)])
    for run in range(1, 4):
        stored.apply(spark.createDataFrame([(run, f"r{run}", run, None)], SHAPE), ["at"])
    newest, earlier, held = rows(stored.read()), rows(stored.read(2)), len(files(tmp_path))
    stored.vacuum(2)
    assert rows(stored.read()) == newest and rows(stored.read(2)) == earlier and len(files(tmp_path)) < held
    with pytest.raises(Exception):
        stored.read(0).collect()


def test_the_filter_keeps_all_matches_and_few_others(spark):
    big = spark.range(100_000).select((F.col("id") * 7).cast("int").alias("k"), F.col("id").cast("string").alias("s"))
    keys = spark.range(2_000).select((F.col("id") * 70).alias("k"), (F.col("id") * 10).cast("string").alias("s"))
    for on in (["k"], ["k", "s"]):
        kept = may_hold(big, keys, on)
        assert kept.columns == big.columns and kept.join(keys.withColumn("k", F.col("k").cast("int")), on, "left_semi").count() == 2_000
        assert kept.count() < 2_100
    # More keys than bits: still right.
    assert may_hold(big, keys, ["k"], bits=64).count() == 100_000
    plan = may_hold(big, keys, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
