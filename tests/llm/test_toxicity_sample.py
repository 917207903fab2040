from pyspark.sql import functions as F

from tidemark.llm.samples import hash_sample
from tidemark.llm.toxicity import TRAIN_ROWS


def test_chain_is_fitted_to_the_stated_number_of_labels(spark):
    found = hash_sample(spark.range(20_000).select(F.col("id").alias("_id")), ["_id"], TRAIN_ROWS).count()
    assert 7_500 < found < 8_500
