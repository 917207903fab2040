from tidemark.session import spread


def test_spread_follows_the_rows(spark, tmp_path):
    spark.range(0, 10_000, 1, 1).write.parquet(f"{tmp_path}/one")
    spark.range(0, 10_000, 1, 8).write.parquet(f"{tmp_path}/many")
    # Nearly all rows lie in one of more files than there are cores.
    spark.range(10_000, 60_000, 1, 1).write.mode("append").parquet(f"{tmp_path}/many")
    for name, count in (("one", 10_000), ("many", 60_000)):
        dealt = spread(spark.read.parquet(f"{tmp_path}/{name}"), rows=1_000)
        sizes = dealt.rdd.glom().map(len).collect()
        assert len(sizes) == count // 1_000 and max(sizes) <= 1_100 and sum(sizes) == count
        assert sorted(r.id for r in dealt.collect()) == list(range(count))


def test_spread_of_few_rows_uses_all_cores(spark, tmp_path):
    spark.range(0, 10, 1, 1).write.parquet(f"{tmp_path}/few")
    spark.range(0).write.parquet(f"{tmp_path}/none")
    cores = spark.sparkContext.defaultParallelism
    assert spread(spark.read.parquet(f"{tmp_path}/few")).rdd.getNumPartitions() == cores
    assert spread(spark.read.parquet(f"{tmp_path}/none")).count() == 0
