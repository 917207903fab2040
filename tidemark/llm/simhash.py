"""Near-duplicates by SimHash fingerprints."""

from __future__ import annotations

import functools
import itertools
import operator
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.llm.decontamination import without
from tidemark.llm.words import utf8
from tidemark.operators.joins import reshuffled
from tidemark.session import settle

BITS = 64
SEED = 42
_SLICE = 1 << 16


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """64-bit SimHash of a text's word shingles; a bit is 1 if it is set in over half of the shingles' hashes."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.append(np.flatnonzero(np.frombuffer(joined, np.uint8) == 32), len(joined))
    if len(words) > shingle:
        starts = [0, *(ends[: len(ends) - shingle] + 1).tolist()]
        stops = ends[shingle - 1 :].tolist()
    else:
        starts, stops = [0], [len(joined)]
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(starts), _SLICE):
        pairs = zip(starts[at : at + _SLICE], stops[at : at + _SLICE])
        hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in pairs), np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(starts), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, version (a hash of the text) and the fingerprint as a signed long.

    Null texts count as empty, without words the fingerprint is 0.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.fromiter((fingerprint(t.as_py(), shingle) for t in batch["_text"]), np.uint64, batch.num_rows)
            columns = [batch["doc_id"], batch["version"], pa.array(prints.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "version", "fingerprint"])

    version = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    rows = docs.select(F.col(id_col).alias("doc_id"), version.alias("version"), utf8(text_col).alias("_text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, version long, fingerprint long")


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def _block_masks(distance: int) -> list[int]:
    """Masks of which at least one covers no bit in which two fingerprints within ``distance`` bits differ.

    The bits are cut into distance + 4 blocks, of which at most ``distance`` differ; each mask is the rest of one choice.
    """
    blocks = distance + 4
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    parts = [(1 << high) - (1 << low) for low, high in zip(edges, edges[1:])]
    return [_signed(sum(chosen)) for chosen in itertools.combinations(parts, 4)]


def _variants(column: str, radius: int) -> Column:
    """The value itself and all values that differ from it in at most ``radius`` bits."""
    flips = [
        _signed(functools.reduce(operator.or_, (1 << b for b in bits), 0))
        for n in range(radius + 1)
        for bits in itertools.combinations(range(BITS), n)
    ]
    return F.transform(F.array(*map(F.lit, flips)), lambda flip: F.col(column).bitwiseXOR(flip))


def close_pairs(prints: DataFrame, distance: int = 2) -> DataFrame:
    """Links between distinct fingerprints that connect exactly those that chains of close pairs connect.

    A pair is close if it differs in at most ``distance`` bits, which must be even. First, blocks: fingerprints that
    share the bits of a choice of blocks with no other one are close to none. Those left are joined through the values
    halfway: two fingerprints are within d bits of each other if and only if some value is within d/2 bits of both.
    A value has few fingerprints around it (65 for two bits), however many copies a text has, and its smallest
    fingerprint is linked to each of them, so a dense group gives a number of links in proportion to its size.

    ``prints`` has one column, fingerprint, without repeats. Columns: a, b.
    """
    if distance < 0 or distance % 2:
        raise ValueError("distance must be even")
    cells = [
        F.struct(F.lit(i).alias("table"), F.col("fingerprint").bitwiseAND(F.lit(mask)).alias("cell"))
        for i, mask in enumerate(_block_masks(distance))
    ]
    spread = prints.select("fingerprint", F.explode(F.array(*cells)).alias("c")).select("fingerprint", "c.table", "c.cell")
    shared = spread.groupBy("table", "cell").agg(F.min("fingerprint").alias("lo"), F.max("fingerprint").alias("hi"))
    shared = settle(shared.where("lo != hi").select("table", "cell"))
    near = settle(spread.join(reshuffled(shared), ["table", "cell"], "left_semi").select("fingerprint").distinct())
    halfway = near.select("fingerprint", F.explode(_variants("fingerprint", distance // 2)).alias("value"))
    around = halfway.groupBy("value").agg(F.collect_list("fingerprint").alias("all")).where(F.size("all") > 1)
    links = around.select(F.array_min("all").alias("a"), F.explode("all").alias("b")).where("a != b").distinct()
    return links.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance)


def near_duplicates(
    docs: DataFrame, shingle: int = 3, distance: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: its fingerprint and the group of near-duplicates that it belongs to.

    A group is everything that chains of close fingerprints connect, named by its smallest id. Null and empty texts
    have fingerprint 0, which is linked like any other. Rows with a null id get a group as well; a group of such
    rows alone has a null name. Repeated rows are in the same group. Other columns of ``docs`` are not read.

    Columns: doc_id, fingerprint (16 hexadecimal digits), component_id.
    """
    rows = _grouped(docs, shingle, distance, id_col, text_col)
    return rows.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def _grouped(docs: DataFrame, shingle: int, distance: int, id_col: str, text_col: str) -> DataFrame:
    """doc_id, version, fingerprint, root (a fingerprint that names the group), component_id."""
    rows = settle(fingerprints(docs, shingle, id_col, text_col))
    prints = settle(rows.groupBy("fingerprint").agg(F.min("doc_id").alias("smallest")))
    roots = settle(components(close_pairs(prints.select("fingerprint"), distance)))
    named = prints.join(roots.withColumnRenamed("node", "fingerprint"), "fingerprint", "left")
    named = settle(named.select("fingerprint", "smallest", F.coalesce("root", "fingerprint").alias("root")))
    groups = named.groupBy("root").agg(F.min("smallest").alias("component_id"))
    table = settle(named.select("fingerprint", "root").join(reshuffled(groups), "root").select("fingerprint", "root", "component_id"))
    return rows.join(reshuffled(table), "fingerprint").select("doc_id", "version", "fingerprint", "root", "component_id")


def drop_near_duplicates(
    docs: DataFrame, shingle: int = 3, distance: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row of each group of near-duplicates, with all columns: that with the smallest id, null ids being the largest.

    Of several texts with that id, the one with the smallest hash stays; of rows that repeat the id and the text, any one.
    """
    rows = settle(_grouped(docs, shingle, distance, id_col, text_col).select("doc_id", "version", "root"))
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "version")
    best = settle(rows.groupBy("root").agg(F.min(place).alias("best"), F.count("*").alias("rows")))
    # Rows of a group of one are left alone.
    others = rows.join(reshuffled(best.where("rows > 1")), "root").select("doc_id", "version", (place == F.col("best")).alias("first"))
    others = settle(others.groupBy("doc_id", "version").agg(F.bool_or("first").alias("first"), F.count_if("first").alias("rows")))
    kept = without(docs, others.where("not first or rows > 1"), id_col, text_col)
    again = others.where("first and rows > 1")
    if again.isEmpty():
        return kept
    version = F.xxhash64(F.coalesce(F.col(f"docs.`{text_col}`"), F.lit("")))
    same = F.col(f"docs.`{id_col}`").eqNullSafe(F.col("again.doc_id")) & (version == F.col("again.version"))
    once = docs.alias("docs").join(reshuffled(again).alias("again"), same, "left_semi")
    row = F.struct(*[F.col(f"docs.`{c}`") for c in docs.columns]).alias("row")
    once = once.select(row, F.col(f"docs.`{id_col}`").alias("id"), version.alias("version")).dropDuplicates(["id", "version"])
    return kept.unionByName(once.select("row.*"))
