"""How the words of sources differ: exact term counts and their divergences."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.operators.joins import reshuffled
from tidemark.session import settle

MIN_DOCS = 10
TOP_TERMS = 10
SCALE = 1_000_000_000
#: Text that is sorted at once in a task.
CHUNK_BYTES = 8 << 20
#: Terms and sources that are compared at once in a task.
SHARD_TERMS = 4096
SOURCE_BLOCK = 64

# Bytes of terms: ASCII letters and all of UTF-8 beyond ASCII.
_INSIDE = np.array([b >= 128 or chr(b).isalpha() for b in range(256)])
_OUTSIDE = re.compile(rb"[\x00-\x40\x5B-\x60\x7B-\x7F]")


def radix_order(words: Sequence[np.ndarray]) -> np.ndarray:
    """The stable order of rows of uint64 words, most significant word first, by passes over 16 bits."""
    order = np.arange(len(words[0]))
    for word in reversed(words):
        for shift in range(0, 64, 16):
            digits = (word >> np.uint64(shift)).astype(np.uint16)
            if digits.min() != digits.max():
                order = order[np.argsort(digits[order], kind="stable")]
    return order


class Terms:
    """The terms of a buffer of lower-cased texts, in buckets by length, each with its terms in a sortable form.

    Terms of up to 8 bytes are one big-endian word, those of up to 16 bytes two; no term holds a zero byte, so zeros fill
    them up without making two terms equal. Longer terms are in a bucket for each length, as fixed-width bytes.
    """

    def __init__(self, buffer: bytes) -> None:
        self.bytes = np.frombuffer(buffer + bytes(16), np.uint8)
        edges = np.flatnonzero(np.diff(_INSIDE[self.bytes], prepend=False))
        self.starts, self.sizes = edges[::2], edges[1::2] - edges[::2]

    def _words(self, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        windows = np.lib.stride_tricks.sliding_window_view(self.bytes, 8)[starts]
        unused = np.uint64(8) * (np.uint64(8) - sizes.astype(np.uint64))
        return windows.view(">u8").ravel().astype(np.uint64) >> unused << unused

    def buckets(self) -> Iterator[tuple[np.ndarray, np.ndarray, list[np.ndarray]]]:
        """For each bucket: which terms it has, their sorted order, and their columns."""
        one = np.flatnonzero(self.sizes <= 8)
        two = np.flatnonzero((self.sizes > 8) & (self.sizes <= 16))
        if len(one):
            words = [self._words(self.starts[one], self.sizes[one])]
            yield one, radix_order(words), words
        if len(two):
            at, eight = self.starts[two], np.full(len(two), 8)
            words = [self._words(at, eight), self._words(at + 8, self.sizes[two] - 8)]
            yield two, radix_order(words), words
        more = self.sizes > 16
        for size in np.unique(self.sizes[more]):
            held = np.flatnonzero(self.sizes == size)
            rows = np.lib.stride_tricks.sliding_window_view(self.bytes, size)[self.starts[held]]
            column = np.ascontiguousarray(rows).view(f"S{size}").ravel()
            yield held, np.argsort(column, kind="stable"), [column]

    def texts(self, which: np.ndarray) -> pa.Array:
        """The terms with these numbers as an array of strings."""
        sizes = self.sizes[which]
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        places = np.repeat(self.starts[which] - offsets[:-1], sizes) + np.arange(offsets[-1])
        return pa.LargeStringArray.from_buffers(len(which), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(self.bytes[places]))


def count_runs(buffer: bytes, ends: np.ndarray, groups: np.ndarray, weights: np.ndarray | None = None) -> Iterator[tuple]:
    """(terms, group, count, documents) of every term and group in a buffer of documents, one bucket after the other.

    ``ends`` has where documents end, ``groups`` their groups, which must not fall. As sorting is stable, equal terms stay
    in the order of documents, so that runs of a term and a group are neighbours. ``weights`` counts terms several times.
    """
    terms = Terms(buffer)
    document = np.searchsorted(ends, terms.starts, "right")
    for held, order, columns in terms.buckets():
        owner = document[held][order]
        group = groups[owner]
        fresh = np.ones(len(order), bool)
        fresh[1:] = group[1:] != group[:-1]
        for column in columns:
            ordered = column[order]
            fresh[1:] |= ordered[1:] != ordered[:-1]
        first = np.flatnonzero(fresh)
        fresh[1:] |= owner[1:] != owner[:-1]
        times = np.diff(first, append=len(order)) if weights is None else np.add.reduceat(weights[held][order], first)
        yield terms.texts(held[order[first]]), group[first], times, np.add.reduceat(fresh.astype(np.int64), first)


def _condensed(text: bytes, chunk: int) -> tuple[bytes, list[int] | None]:
    """A text larger than a chunk as its distinct terms in each part of it, with their counts there."""
    if len(text) <= chunk:
        return text, None
    parts, counts, low = [], [], 0
    while low < len(text):
        cut = _OUTSIDE.search(text, low + chunk)
        high = cut.end() if cut else len(text)
        for terms, _, times, _ in count_runs(text[low:high], np.array([high - low]), np.zeros(1, np.int64)):
            parts += terms.cast(pa.large_binary()).to_pylist()
            counts.append((parts[-len(times) :], times))
        low = high
    # Weights follow the terms in the order in which they are written.
    return b" ".join(parts), np.concatenate([times for _, times in counts]).tolist() if counts else []


def term_counts(docs: DataFrame, chunk: int = CHUNK_BYTES) -> DataFrame:
    """lang, source, term, n, docs: how often each term occurs in each group, and in how many of its documents.

    ``docs`` has lang, source and text, none null. Terms are packed, sorted and counted chunk by chunk inside tasks; Spark
    adds up what the chunks found.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: list[tuple] = []
            weight = 0
            for lang, source, text in zip(batch["lang"].to_pylist(), batch["source"].to_pylist(), batch["text"]):
                text, counts = _condensed(text.as_py().lower(), chunk)
                if held and weight + len(text) > chunk:
                    yield from found(held)
                    held, weight = [], 0
                held.append((lang, source, text, counts))
                weight += len(text)
            yield from found(held)

    def found(held: list[tuple]) -> Iterator[pa.RecordBatch]:
        held.sort(key=lambda row: row[:2])
        names = sorted({row[:2] for row in held})
        place = {name: at for at, name in enumerate(names)}
        groups = np.array([place[row[:2]] for row in held], np.int64)
        ends = np.cumsum([len(row[2]) + 1 for row in held])
        buffer = b" ".join(row[2] for row in held)
        weights = None
        if any(row[3] is not None for row in held):
            sizes = [len(Terms(row[2]).starts) if row[3] is None else len(row[3]) for row in held]
            weights = np.concatenate([np.ones(size, np.int64) if row[3] is None else np.array(row[3], np.int64) for size, row in zip(sizes, held)])
        langs, sources = (pa.array([name[i] for name in names], pa.string()) for i in (0, 1))
        for terms, group, times, documents in count_runs(buffer, ends, groups, weights):
            columns = [langs.take(pa.array(group)), sources.take(pa.array(group)), terms.cast(pa.string())]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(times), pa.array(documents)], ["lang", "source", "term", "n", "docs"])

    found_there = docs.select("lang", "source", F.col("text").cast("binary").alias("text"))
    rows = found_there.mapInArrow(run, "lang string, source string, term string, n long, docs long")
    return rows.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _share(count: str, total: str, terms: str) -> Column:
    """1 + floor(SCALE * (count + 2) / (total + 2 * terms)), in whole numbers of 38 digits; 0 without terms."""
    whole = [F.col(name).cast("decimal(38,0)") for name in (total, terms)]
    below = F.nullif(whole[0] + whole[1] * 2, F.lit(0).cast("decimal(38,0)"))
    above = ((F.col(count).cast("decimal(24,0)") + 2) * SCALE).cast("decimal(38,0)")
    return F.coalesce(F.call_function("div", above, below.cast("decimal(38,0)")) + 1, F.lit(0)).cast("bigint")


def _distance(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def source_divergence(
    docs: DataFrame,
    min_docs: int = MIN_DOCS,
    top_terms: int = TOP_TERMS,
    lang_col: str = "lang",
    source_col: str = "source",
    text_col: str = "text",
) -> DataFrame:
    """How far the sources of a language are from each other, and which terms set a source apart from its language.

    Terms are runs of ASCII letters, lower-cased, and characters beyond ASCII. A language keeps the terms that at least
    ``min_docs`` of its documents hold. The share p of a kept term in a source is 1 + floor(10^9 (n + 2) / (N + 2 V)): n
    its occurrences there, N those of all V kept terms. Two shares p and q differ by floor((p - q)^2 / (p + q)).
    Part ``pair`` has, for each source, every other source of its language, with the sum over all kept terms; part ``term``
    the terms that a source uses more than its language as a whole, up to rank ``top_terms``.

    Null texts, languages and sources count as empty. Rows that repeat others count like others. Sources without terms
    are there with zero counts, and with the sum 0 where the language keeps no term. Other columns are not read.

    Columns: lang, source, part, item, value, rank (by falling value, then by the bytes of the item).
    """
    blank = F.lit("")
    rows = docs.select(*[F.coalesce(c, blank).alias(a) for c, a in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))])
    counts = settle(term_counts(rows))
    known = counts.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"))
    known = settle(known.where(F.col("docs") >= min_docs).drop("docs").withColumn("number", F.monotonically_increasing_id()))
    held = settle(counts.join(reshuffled(known), ["lang", "term"]).select("lang", "source", "term", "number", "n", "lang_n"))

    langs = known.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("lang_n").alias("lang_total"))
    totals = held.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = rows.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
    groups = groups.fillna(0, ["total", "terms", "lang_total"]).withColumn("none", F.lit(0).cast("bigint"))
    numbered = Window.partitionBy("lang")
    # A row for each source: its number in its language, and the share of a term that it doesn't hold.
    groups = groups.withColumns(
        {
            "place": F.row_number().over(numbered.orderBy("source")) - 1,
            "blocks": F.ceil(F.count("*").over(numbered) / SOURCE_BLOCK).cast("int"),
            "absent": _share("none", "total", "terms"),
        }
    )
    groups = settle(groups.drop("none"))
    shares = held.join(reshuffled(groups), ["lang", "source"]).withColumn("p", _share("n", "total", "terms"))

    apart = shares.withColumn("q", _share("lang_n", "lang_total", "terms")).where("p > q")
    apart = apart.select("lang", "source", F.col("term").alias("item"), _distance(F.col("p"), F.col("q")).alias("value"))
    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    apart = apart.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= top_terms)

    pairs = _source_pairs(shares, groups).withColumn("rank", F.row_number().over(ranked))
    shape = ["lang", "source", "part", "item", "value", "rank"]
    return pairs.withColumn("part", F.lit("pair")).select(shape).unionByName(apart.withColumn("part", F.lit("term")).select(shape))


def _source_pairs(shares: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, source, item, value: the sum of differences of every two sources of a language, both ways.

    A task compares two blocks of sources over a shard of the terms, and returns a row for each pair. Only shares of terms
    that a source holds are sent; a term that neither block holds differs by the same amount for each such term.
    """
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    own = F.call_function("div", F.col("place"), F.lit(SOURCE_BLOCK)).cast("int")
    shards = F.greatest(F.ceil(F.col("terms") / SHARD_TERMS), F.lit(1))
    here = shares.select("lang", "place", F.pmod(F.xxhash64("number"), shards).cast("int").alias("shard"), "blocks", "number", "p")
    # Each shard is told of all sources, by rows without a term.
    told = groups.select("lang", "place", F.explode(F.sequence(F.lit(0), (shards - 1).cast("int"))).alias("shard"), "blocks")
    told = told.join(reshuffled(groups.select("lang", "place", F.col("absent").alias("p"))), ["lang", "place"])
    sent = here.unionByName(told.withColumn("number", F.lit(-1).cast("bigint"))).withColumn("own", own).withColumn("other", other)
    sent = sent.withColumns({"x": F.least("own", "other"), "y": F.greatest("own", "other")})

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        number, place = frame["number"].to_numpy(), frame["place"].to_numpy()
        sources, column = np.unique(place, return_inverse=True)
        known = number >= 0
        absent = np.zeros(len(sources), np.int64)
        absent[column[~known]] = frame["p"].to_numpy()[~known]
        terms, row = np.unique(number[known], return_inverse=True)
        share = np.tile(absent, (len(terms), 1))
        share[row, column[known]] = frame["p"].to_numpy()[known]
        lang, x, y = (frame[name].iloc[0] for name in ("lang", "x", "y"))
        parts = []
        for i in np.flatnonzero(sources // SOURCE_BLOCK == x):
            others = np.flatnonzero((sources // SOURCE_BLOCK == y) & (sources > sources[i]))
            apart = (share[:, [i]] - share[:, others]) ** 2 // (share[:, [i]] + share[:, others])
            parts.append(pd.DataFrame({"a": sources[i], "b": sources[others], "value": apart.sum(axis=0)}))
        result = pd.concat(parts).assign(lang=lang, met=len(terms))
        return result[["lang", "a", "b", "value", "met"]]

    found = sent.groupBy("lang", "x", "y", "shard").applyInPandas(compare, "lang string, a int, b int, value long, met long")
    sums = found.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"), F.sum("met").alias("met"))
    both = F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("pair")
    sums = sums.select("lang", "value", "met", both).select("lang", "value", "met", "pair.*")
    left = groups.select("lang", F.col("place").alias("a"), "source", "terms", F.col("absent").alias("p"))
    right = groups.select("lang", F.col("place").alias("b"), F.col("source").alias("item"), F.col("absent").alias("q"))
    named = sums.join(reshuffled(left), ["lang", "a"]).join(reshuffled(right), ["lang", "b"])
    rest = F.coalesce((F.col("terms") - F.col("met")) * _distance(F.col("p"), F.nullif(F.col("q"), F.lit(0))), F.lit(0))
    return named.select("lang", "source", "item", (F.col("value") + rest).cast("bigint").alias("value"))
