"""Documents and change events from files or a message log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.events import ENVELOPE, parse_envelopes
from tidemark.session import spread


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Exported documents, one JSON text per line, counted first and dealt out, for compressed files cannot be split."""
    return spread(spark.read.text(path)).withColumnRenamed("value", "document")


def read_events(spark: SparkSession, path: str, format: str = "parquet") -> DataFrame:
    return spark.read.format(format).schema(ENVELOPE).load(path)


def stream_events(spark: SparkSession, path: str, format: str = "parquet", files_per_batch: int = 1000) -> DataFrame:
    """Event files as they arrive; batches are bounded by a number of files."""
    reader = spark.readStream.format(format).schema(ENVELOPE).option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def stream_log(spark: SparkSession, servers: str, topics: str, **options: str) -> DataFrame:
    """Change events from a Kafka topic, one envelope per message. The Kafka package is the deployment's to add."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topics)
    return parse_envelopes(reader.options(**options).load().where(F.col("value").isNotNull()), "value", "key")
