"""Joins whose strategy follows measured sizes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 64 << 20
BROADCAST_ROWS = 1_000_000

# More than any frame has, so that no partitions are merged.
_MOST_PARTITIONS = 1 << 24


def fits_broadcast(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> bool:
    """True if ``df`` was counted and weighed to be within both limits. One pass, one row to the driver."""
    weight = F.lit(0).cast("bigint")
    for field in df.schema.fields:
        kind = field.dataType.typeName()
        if kind in ("string", "binary"):
            weight = weight + F.coalesce(F.octet_length(field.name), F.lit(0))
        elif kind in ("struct", "array", "map", "variant"):
            weight = weight + F.coalesce(F.octet_length(F.to_json(F.struct(field.name))), F.lit(0))
        else:
            weight = weight + 16
    seen = df.agg(F.count("*").alias("n"), F.sum(weight).alias("bytes")).first()
    return seen["n"] <= rows and (seen["bytes"] or 0) <= size


#: Bits of a filter of keys: one broadcast row for each 64 of them at most.
FILTER_BITS = 1 << 26


def may_hold(big: DataFrame, keys_df: DataFrame, on: Sequence[str], bits: int = FILTER_BITS) -> DataFrame:
    """Rows of ``big`` whose key may be in ``keys_df``: all that are, and of the others one in ``bits`` for each key.

    A filter of the keys is built by an aggregate and broadcast. It has at most ``bits`` / 64 rows, however many keys there
    are, so ``big`` is cut down in place, before a join that shuffles it. With more keys than bits it keeps nearly all rows.
    """
    keys = keys_df.select(*[F.col(k).try_cast(big.schema[k].dataType).alias(k) for k in on])
    place = F.pmod(F.xxhash64(*on), F.lit(bits))
    word, bit = F.shiftright(place, 6).alias("_word"), F.call_function("shiftleft", F.lit(1).cast("bigint"), (place % 64).cast("int")).alias("_bit")
    words = keys.select(word, bit).groupBy("_word").agg(F.bit_or("_bit").alias("_bits"))
    marked = big.select("*", word, bit).join(F.broadcast(words), "_word").where(F.col("_bits").bitwiseAND(F.col("_bit")) != 0)
    return marked.select(*big.columns)


def keep_keys(big: DataFrame, keys_df: DataFrame, on: Sequence[str], small: bool | None = None) -> DataFrame:
    """Rows of ``big`` whose key is in ``keys_df``; when the keys are few, ``big`` is not shuffled, else little more of it
    than these rows."""
    keys = keys_df.select(*on)
    if fits_broadcast(keys) if small is None else small:
        return big.join(F.broadcast(keys), list(on), "left_semi")
    return may_hold(big, keys, on).join(keys, list(on), "left_semi")


def drop_keys(big: DataFrame, keys_df: DataFrame, on: Sequence[str], small: bool | None = None) -> DataFrame:
    """Rows of ``big`` whose key is not in ``keys_df``."""
    keys = keys_df.select(*on)
    if fits_broadcast(keys) if small is None else small:
        return big.join(F.broadcast(keys), list(on), "left_anti")
    return big.join(keys, list(on), "left_anti")


def reshuffled(df: DataFrame) -> DataFrame:
    """The same rows, with the way they are dealt out forgotten.

    A join then shuffles both of its sides, also one that an aggregate has dealt out before, which is what lets adaptive
    execution split the rows of a hot key.
    """
    return df.coalesce(_MOST_PARTITIONS)


def lookup(big: DataFrame, small: DataFrame, on: Sequence[str], how: str = "left", fits: bool | None = None) -> DataFrame:
    """Join ``big`` to at most one row of ``small`` per key, also when a few keys hold most of ``big``.

    A ``small`` side that was measured to fit is broadcast. Otherwise both sides are shuffled, and adaptive execution
    splits the rows of hot keys.
    """
    if fits_broadcast(small) if fits is None else fits:
        return big.join(F.broadcast(small), list(on), how)
    return big.join(reshuffled(small), list(on), how)
