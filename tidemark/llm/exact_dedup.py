"""Exact deduplication with DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.joins import reshuffled
from tidemark.session import settle

SPACES = r"[\x20\x09-\x0D]+"


def content_digest(text: Column) -> Column:
    return F.unhex(F.md5(text))


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    digest: Callable[[Column], Column] = content_digest,
) -> DataFrame:
    """One row per row of ``docs``: which rows have equal texts, and which of them stays.

    Texts are equal when they have the same bytes without white space. Of equal texts the one with the most code
    points stays, then the one with the smallest id. Texts are grouped by a 128-bit digest and their bytes are
    compared inside each group: the second aggregate has the text itself among its keys. Both aggregates shrink
    inside map tasks, so a group of any size costs no more than others.

    Null texts count as empty, and empty texts are equal. Null ids come after all others. Rows that repeat an id
    and its text are one group, of which exactly one row is kept. Other columns of ``docs`` are not read.

    Columns: doc_id, keep_id, group_size, kept, text_sha256.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumn("bare", F.regexp_replace("text", SPACES, ""))
    rows = rows.withColumn("digest", digest(F.col("bare")))

    # The check of bytes: digests that belong to several texts, none unless digests collide.
    texts = rows.groupBy("digest", "bare").agg(F.count("*").alias("rows"))
    collided = settle(texts.groupBy("digest").agg(F.count("*").alias("texts")).where("texts > 1").select("digest"))
    if not collided.isEmpty():
        met = collided.withColumn("met", F.lit(True))
        rows = rows.join(reshuffled(met), "digest", "left").withColumn("apart", F.when(F.col("met"), F.col("bare")))
    else:
        rows = rows.withColumn("apart", F.lit(None).cast("string"))

    marked = settle(
        rows.select(
            "doc_id",
            "digest",
            F.coalesce("apart", F.lit("")).alias("apart"),
            F.sha2("bare", 256).alias("text_sha256"),
            F.char_length("text").alias("points"),
            F.monotonically_increasing_id().alias("row"),
        )
    )
    # The first by this order stays.
    order = F.struct((-F.col("points")).alias("points"), F.col("doc_id").isNull().alias("none"), "doc_id", "row")
    groups = marked.groupBy("digest", "apart").agg(F.min(order).alias("best"), F.count("*").alias("group_size"))
    groups = settle(groups.select("digest", "apart", "best.doc_id", "best.row", "group_size"))
    groups = groups.toDF("digest", "apart", "keep_id", "keep_row", "group_size")
    return marked.join(reshuffled(groups), ["digest", "apart"]).select(
        "doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"), "text_sha256"
    )
