from pyspark.sql import functions as F

from tidemark.llm.lm_scoring import score_texts


def test_contexts_of_six_bytes(spark):
    # Only the sixth byte before the last one tells which it is.
    docs = spark.createDataFrame([(i, "xabcdef" if i % 2 else "yabcdeg") for i in range(40)], "doc_id long, text string")
    assert all(r.score > -0.5 for r in score_texts(docs, F.lit(False)).collect())
