"""Key ranges: bounds, splitting, dense numbering, chunks and checkpoints."""

from __future__ import annotations

import datetime as dt
import functools
import json
import operator
from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tidemark.functions.predicates import bound, key_after, key_range, plain
from tidemark.names import SPLIT_SAMPLE
from tidemark.session import settle

Key = tuple[Any, ...]


def max_key(df: DataFrame, keys: Sequence[str]) -> Key | None:
    """Largest key tuple, None for no rows. One row reaches the driver."""
    # A lone column keeps the plain MAX that sources can answer themselves.
    top = F.max(keys[0]) if len(keys) == 1 else F.max(F.struct(*keys))
    value = df.agg(top.alias("top")).first()["top"]
    if value is None:
        return None
    return _zoned(df, keys, [value] if len(keys) == 1 else value)


def _zoned(df: DataFrame, keys: Sequence[str], values: Sequence[Any]) -> Key:
    """Collected values; points in time, which arrive in the zone of this process, get their zone named."""
    instant = [isinstance(df.schema[k].dataType, T.TimestampType) for k in keys]
    return tuple(v.astimezone(dt.timezone.utc) if i and v is not None else v for i, v in zip(instant, values))


def random_rows(df: DataFrame, size: int, seed: int = 7, total: int | None = None) -> DataFrame:
    """``size`` rows at random, all of them when there are no more.

    The rows are counted first, so that every task hands on its share of the sample and not more. A sample that falls
    short, which hardly ever happens, is drawn from all rows instead.
    """
    total = df.count() if total is None else total
    fraction = (size + 6 * size**0.5 + 20) / max(total, 1)
    if fraction < 1:
        part = settle(df.sample(fraction, seed))
        df = part if part.count() >= size else df
    return df.orderBy(F.rand(seed)).limit(size)


def split_points(
    df: DataFrame,
    keys: Sequence[str],
    ranges: int,
    sample: int | None = None,
    seed: int = 7,
    total: int | None = None,
) -> list[Key]:
    """At most ``ranges`` - 1 ascending key tuples that cut ``df`` into ranges of about the same size.

    Only the key columns are read, and only the sample, some tuples per range, reaches the driver.
    """
    size = max(sample or SPLIT_SAMPLE, 16 * ranges)
    picked = random_rows(df.select(*keys), size, seed, total).collect()
    # Rows without a key stay in the first range. They are left out here rather than by a filter, which would
    # be pushed through the projections below and repeat what the keys are computed from.
    ordered = sorted(_zoned(df, keys, row) for row in picked if None not in row)
    cuts = (ordered[len(ordered) * i // ranges] for i in range(1, ranges)) if ordered else ()
    return sorted(set(cuts))


#: The larger, the finer: ranks of a sketch are wrong by about 1.6 / k.
SKETCH_K = 1_024


def key_sketch(df: DataFrame, key: str, k: int = SKETCH_K) -> DataFrame:
    """One row that tells how the values of a key are spread: key_type, sketch. It has some kilobytes, whatever the rows.

    Store it with the state of a read. Keys are whole numbers, floating ones, dates or times; nulls are left out.
    """
    kind = df.schema[key].dataType
    return df.agg(F.lit(kind.simpleString()).alias("key_type"), F.kll_sketch_agg_bigint(_as_long(F.col(key), kind), k).alias("sketch"))


def merge_sketches(sketches: DataFrame, k: int = SKETCH_K) -> DataFrame:
    """One row from the stored sketches of the parts of a table, as if of all their rows."""
    held = sketches.where("sketch is not null")
    return held.agg(F.any_value("key_type").alias("key_type"), F.kll_merge_agg_bigint("sketch", k).alias("sketch"))


def sketch_points(sketch: DataFrame, ranges: int) -> list[Key]:
    """At most ``ranges`` - 1 ascending keys that cut the sketched rows into ranges of about the same size, without a scan."""
    shares = F.array(*[F.lit(i / ranges) for i in range(1, ranges)]) if ranges > 1 else None
    row = sketch.select("key_type", F.kll_sketch_get_n_bigint("sketch").alias("n")).first()
    if shares is None or row is None or not row["n"]:
        return []
    kind = T.DataType.fromDDL(row["key_type"])
    found = sketch.select(F.explode(F.array_distinct(F.kll_sketch_get_quantile_bigint("sketch", shares))).alias("point"))
    keys = found.orderBy("point").select(_from_long(F.col("point"), kind).alias("point"))
    return [_zoned(keys, ["point"], point) for point in keys.collect()]


def _as_long(key: Column, kind: T.DataType) -> Column:
    """A whole number in the order of the keys."""
    if isinstance(kind, T.DateType):
        return F.unix_date(key).cast("bigint")
    if isinstance(kind, T.TimestampNTZType):
        # Not by way of a point in time, for that would depend on the session's zone.
        return F.unix_date(key.cast("date")).cast("bigint") * _DAY + (F.hour(key) * 3600 + F.minute(key) * 60).cast("bigint") * 1_000_000 + (
            F.extract(F.lit("SECOND"), key) * 1_000_000
        ).cast("bigint")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(key)
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return F.floor(key).cast("bigint")
    if isinstance(kind, T.IntegralType):
        return key.cast("bigint")
    raise ValueError(f"keys of type {kind.simpleString()} have no sketch")


def _from_long(number: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.DateType):
        return F.date_from_unix_date(number.cast("int"))
    if isinstance(kind, T.TimestampNTZType):
        return F.timestamp_add("MICROSECOND", number, F.lit("1970-01-01").cast("timestamp_ntz"))
    if isinstance(kind, T.TimestampType):
        return F.timestamp_micros(number)
    return number.cast(kind)


_DAY = 86_400 * 1_000_000


def split_ranges(
    points: Sequence[Key], lower: Key | None = None, upper: Key | None = None
) -> list[tuple[Key | None, Key | None]]:
    """(lower, p1], (p1, p2], …, (pn, upper]: every key in (lower, upper] falls into exactly one range."""
    inner = [p for p in points if (lower is None or p > lower) and (upper is None or p < upper)]
    return list(zip([lower, *inner], [*inner, upper]))


def read_ranges(df: DataFrame, keys: Sequence[str], ranges: Sequence[tuple[Key | None, Key | None]]) -> list[DataFrame]:
    """One DataFrame per range, each a filter that the source can seek on and that can be read on its own."""
    return [df.where(key_range(df, keys, low, high)) for low, high in ranges]


def with_range(df: DataFrame, keys: Sequence[str], points: Sequence[Key], name: str = "range") -> DataFrame:
    """Adds the number of points below the row's key: the index of its range, a function of the key alone.

    Looks into blocks of about the square root of all points, first for the block, then inside it. Plain sums of
    comparisons, so that they are compiled.
    """
    if not points:
        return df.withColumn(name, F.lit(0))
    width = max(1, round(len(points) ** 0.5))
    heads = _constants(df, keys, points[width::width])
    blocks = [_constants(df, keys, points[at : at + width]) for at in range(0, len(points), width)]
    key = _tuple(keys)

    def below(candidates: Column, count: int) -> Column:
        # A block that is shorter has nulls at its end, which are not below.
        found = (F.when(F.get(candidates, F.lit(i)) < key, 1).otherwise(0) for i in range(count))
        return functools.reduce(operator.add, found, F.lit(0))

    # Each step is a projection of its own, so that the block is looked up once.
    staged = df.withColumn("_block", below(heads, len(blocks) - 1))
    staged = staged.withColumn("_points", F.element_at(F.array(*blocks), F.col("_block") + 1))
    number = F.col("_block") * width + below(F.col("_points"), width)
    return staged.withColumn(name, number).drop("_block", "_points")


def _constants(df: DataFrame, keys: Sequence[str], points: Sequence[Key]) -> Column:
    """An array of key tuples with the types of the columns, made from one literal."""
    types = [df.schema[k].dataType for k in keys]
    if any(isinstance(t, T.BinaryType) for t in types):
        rows = [[bound(df, k, v).alias(k) for k, v in zip(keys, point)] for point in points]
        return F.array(*[row[0] if len(row) == 1 else F.struct(*row) for row in rows])

    def array_of(types: Sequence[T.DataType]) -> T.ArrayType:
        fields = [T.StructField(k, t) for k, t in zip(keys, types)]
        return T.ArrayType(types[0] if len(fields) == 1 else T.StructType(fields))

    rows = [[plain(v) for v in point] for point in points]
    shown = [row[0] if len(row) == 1 else dict(zip(keys, row)) for row in rows]
    texts = F.from_json(F.lit(json.dumps(shown)), array_of([T.StringType()] * len(keys)))
    return texts.cast(array_of(types))


def _tuple(keys: Sequence[str]) -> Column:
    return F.col(keys[0]) if len(keys) == 1 else F.struct(*keys)


def with_dense_number(df: DataFrame, keys: Sequence[str], name: str = "number") -> DataFrame:
    """Number the rows 1, 2, 3, … in the order of ``keys``, and rows with equal keys by a hash of all their columns.

    The rows are dealt out into ranges of keys and hashes, sorted and settled once; a range starts after the row counts
    of the ranges before it. The hash parts the rows of a hot key as well, and rows that are equal in everything may
    swap numbers without a difference. What is numbered is what was settled, also if the source changes meanwhile.
    """
    opaque = ("variant", "map")
    plain = [c for c in df.columns if df.schema[c].dataType.typeName() not in opaque]
    order = [*(F.col(k) for k in keys), F.xxhash64(*plain)]
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    # The place of a row: the number of its range above 33 bits, then its number there.
    placed = settle(ranged.withColumn("_place", F.monotonically_increasing_id()))
    part = F.shiftright("_place", 33)
    counts = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_rows"))
    # One row per range, as many as the shuffle has partitions.
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    inside = F.col("_place").bitwiseAND((1 << 33) - 1)
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(starts), "_part")
        .withColumn(name, F.col("_before") + inside + 1)
        .drop("_part", "_place", "_before")
    )


def chunk_scan(
    df: DataFrame, keys: Sequence[str], chunk_rows: int, after: Key | None = None
) -> DataFrame:
    """Rows after a key with the number of the chunk each belongs to, ``chunk_rows`` rows per chunk.

    All chunks are read at once; chunk n holds what the n-th of a series of limited reads would return.
    """
    rest = df if after is None else df.where(key_after(df, keys, after))
    numbered = with_dense_number(rest, keys, "_number")
    chunk = F.call_function("div", F.col("_number") - 1, F.lit(chunk_rows).cast("bigint"))
    return numbered.withColumn("chunk", chunk).drop("_number")


def checkpoints(chunks: DataFrame, keys: Sequence[str], chunk: str = "chunk") -> DataFrame:
    """One row per chunk that holds rows: its row count and the last key, from which a read resumes."""
    last = F.max(keys[0]) if len(keys) == 1 else F.max(F.struct(*keys))
    per_chunk = settle(chunks.groupBy(chunk).agg(F.count("*").alias("rows"), last.alias("last_key")))
    final = per_chunk.agg(F.max(chunk)).first()[0]
    return per_chunk.withColumn("status", F.when(F.col(chunk) == final, F.lit("COMPLETE")).otherwise(F.lit("IN_PROGRESS")))
