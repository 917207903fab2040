"""Benchmark decontamination: documents that hold a passage close to an item of a benchmark."""

from __future__ import annotations

import itertools
import math
from collections import defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.words import plain_words, run_hashes, utf8, word_hashes
from tidemark.operators.joins import fits_broadcast
from tidemark.session import settle

SHINGLE = 5
SIMILARITY = 0.8
#: Eight blocks of eight bits, each looked up within two bits: all fingerprints within 8 * 3 - 1 bits share a lookup.
BLOCKS, BLOCK_BITS, BLOCK_RADIUS = 8, 8, 2
RADIUS = BLOCKS * (BLOCK_RADIUS + 1) - 1
#: Items whose texts have more bytes than this are compared in several passes.
PASS_BYTES = 8 << 20
_FILTER_BITS = 20
_RUN = 4096
_DOCS = 200

_NEAR = np.bitwise_count(np.arange(256)[:, None] ^ np.arange(256)[None, :]) <= BLOCK_RADIUS


def window_prints(shingles: np.ndarray, width: int) -> np.ndarray:
    """SimHash of each run of ``width`` shingle hashes, repeats counted: a bit is 1 if set in over half of them."""
    bits = np.unpackbits(shingles.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    sums = np.zeros((len(shingles) + 1, 64), np.int32)
    np.cumsum(bits, axis=0, out=sums[1:], dtype=np.int32)
    ones = sums[width:] - sums[:-width]
    return np.packbits(2 * ones > width, axis=1, bitorder="little").view(np.uint64).ravel()


def similarity(left: np.ndarray, right: np.ndarray) -> float:
    """Weighted Jaccard of two bags of shingles: a shingle weighs as much as it occurs."""
    a, n = np.unique(left, return_counts=True)
    b, m = np.unique(right, return_counts=True)
    _, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    shared = int(np.minimum(n[i], m[j]).sum())
    return shared / (len(left) + len(right) - shared)


@dataclass
class _Length:
    """The items of one length in words, and which of them each block value may mean."""

    items: list[int] = field(default_factory=list)
    prints: np.ndarray | None = None
    tables: np.ndarray | None = None

    def close(self, prints: np.ndarray, chosen: np.ndarray) -> np.ndarray:
        """Pairs (window, place among the items) within the radius, found through the blocks, of the ``chosen`` items."""
        values = prints.view(np.uint8).reshape(-1, BLOCKS)
        found = np.zeros((len(prints), len(chosen)), bool)
        for block in range(BLOCKS):
            found |= self.tables[block][:, chosen][values[:, block]]
        at, item = np.nonzero(found)
        item = chosen[item]
        near = np.bitwise_count(prints[at] ^ self.prints[item]) <= RADIUS
        return np.stack([at[near], item[near]], axis=1)


class Index:
    """What tasks need of a bounded number of items."""

    def __init__(self, items: Sequence[tuple[object, bytes]]):
        self.ids: list[object] = []
        self.shingles: list[np.ndarray] = []
        self.lengths: dict[tuple[int, int], _Length] = defaultdict(_Length)
        holders: dict[int, dict[int, list[int]]] = defaultdict(lambda: defaultdict(list))
        for item_id, text in items:
            hashes = word_hashes(plain_words(text))
            if not len(hashes):
                continue
            size = min(SHINGLE, len(hashes))
            shingles, number = run_hashes(hashes, size), len(self.ids)
            self.ids.append(item_id)
            self.shingles.append(shingles)
            self.lengths[size, len(hashes)].items.append(number)
            for value in np.unique(shingles).tolist():
                holders[size][value].append(number)
        for group in self.lengths.values():
            group.prints = np.concatenate([window_prints(self.shingles[i], len(self.shingles[i])) for i in group.items])
            blocks = group.prints.view(np.uint8).reshape(-1, BLOCKS)
            group.tables = np.stack([_NEAR[:, blocks[:, block]] for block in range(BLOCKS)])
        self.place = {item: place for group in self.lengths.values() for place, item in enumerate(group.items)}
        self.lengths = dict(self.lengths)
        self.holders = {size: dict(found) for size, found in holders.items()}
        self.marks = {}
        for size, found in self.holders.items():
            marks = np.zeros(1 << _FILTER_BITS, bool)
            marks[np.fromiter(found, np.uint64, len(found)) >> np.uint64(64 - _FILTER_BITS)] = True
            self.marks[size] = marks

    def hits(self, size: int, shingles: np.ndarray) -> list[tuple[int, list[int]]]:
        """Places whose shingle an item has, with these items."""
        maybe = np.flatnonzero(self.marks[size][shingles >> np.uint64(64 - _FILTER_BITS)])
        found = self.holders[size]
        return [(at, found[value]) for at, value in zip(maybe.tolist(), shingles[maybe].tolist()) if value in found]

    def matches(self, size: int, words: int, shingles: np.ndarray, hits: list) -> list[tuple[int, int, int, float, int]]:
        """(item, start, words, similarity, windows) of each item that a document holds, by its best window."""
        places: dict[int, list[int]] = defaultdict(list)
        for at, items in hits:
            for item in items:
                places[item].append(at)
        # Windows that hold enough of an item's shingles to be similar to it, by the items' lengths.
        worth: dict[int, list[tuple[int, np.ndarray, np.ndarray]]] = defaultdict(list)
        for item, found in places.items():
            count = len(self.shingles[item])
            width = min(count, words - size + 1)
            least = math.ceil(SIMILARITY * (width + count) / (1 + SIMILARITY) - 1e-9)
            if len(found) >= least:
                near = np.array(found)
                low, high = near[least - 1 :] - width + 1, near[: len(near) - least + 1]
                if (low <= high).any():
                    worth[count].append((self.place[item], low[low <= high], high[low <= high]))
        result = []
        for count, chosen in worth.items():
            length = count + size - 1
            width = min(count, words - size + 1)
            last = max(0, words - length)
            edges = np.zeros(last + 2, np.int64)
            for _, low, high in chosen:
                np.add.at(edges, np.clip(low, 0, last), 1)
                np.add.at(edges, np.clip(high, 0, last) + 1, -1)
            starts = np.flatnonzero(np.cumsum(edges[:-1]))
            best: dict[int, list] = {}
            group = self.lengths[size, length]
            among = np.array(sorted(place for place, _, _ in chosen))
            for run in np.split(starts, np.flatnonzero(np.diff(starts) > 1) + 1):
                for low in range(0, len(run), _RUN):
                    part = run[low : low + _RUN]
                    prints = window_prints(shingles[part[0] : part[-1] + width], width)
                    for at, place in group.close(prints, among).tolist():
                        item, start = group.items[place], int(part[at])
                        value = similarity(shingles[start : start + width], self.shingles[item])
                        if value >= SIMILARITY:
                            seen = best.setdefault(item, [value, start, 0])
                            seen[2] += 1
                            if value > seen[0]:
                                seen[:2] = value, start
            result += [(item, start, min(length, words), value, n) for item, (value, start, n) in best.items()]
        return sorted(result)

    def search(self, texts: list[bytes]) -> Iterator[tuple[int, int, int, int, float, int]]:
        """(text, item, start, words, similarity, windows)."""
        lists = [plain_words(text) for text in texts]
        ends = np.cumsum([len(words) for words in lists])
        hashes = word_hashes(list(itertools.chain.from_iterable(lists)))
        for size in self.holders:
            shingles = run_hashes(hashes, size)
            by_text = defaultdict(list)
            for at, items in self.hits(size, shingles):
                number = int(np.searchsorted(ends, at, "right"))
                if at + size <= ends[number]:
                    by_text[number].append((at, items))
            for number, hits in by_text.items():
                words = len(lists[number])
                base = int(ends[number]) - words
                own = shingles[base : base + words - size + 1]
                for match in self.matches(size, words, own, [(at - base, items) for at, items in hits]):
                    yield number, *match


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """Items that documents hold nearly whole: one row per document and item, none for clean documents.

    Words are lower-cased runs of letters, digits and characters beyond ASCII. An item of n words is compared to every
    window of n words of every document, or to the whole document if that is shorter, by their shingles of five words
    (items with fewer words are one shingle). Windows get a SimHash; eight blocks of its bits, each looked up within
    two bits, give all items within 23 bits, and those are verified: the weighted Jaccard similarity of the shingles
    is 0.8 or more. Windows are only compared to items of whose shingles they hold enough for that similarity.

    The items are measured first. They go to all tasks in passes of at most 8 MB of text each, whatever their number,
    and documents are not shuffled. Null and empty texts hold nothing, and items without words are nowhere. Null ids
    are handed through, repeated rows are repeated in the result, repeated items are found each. Other columns are
    not read.

    Columns: doc_id, item_id, start (first word), n_words, similarity (both of the best window), n_windows,
    version (hash of the text, which tells rows with the same id apart).
    """
    items = benchmark.select(F.col(item_col).alias("item_id"), utf8(item_text_col).alias("text"))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    passes = -(-total // PASS_BYTES)
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("version"),
        utf8(text_col).alias("_text"),
    )
    id_type, item_type = (df.schema[c].dataType.simpleString() for df, c in ((rows, "doc_id"), (items, "item_id")))
    shape = f"doc_id {id_type}, item_id {item_type}, start int, n_words int, similarity double, n_windows int, version long"
    if not passes:
        return docs.sparkSession.createDataFrame([], shape)

    def found(number: int) -> DataFrame:
        part = items.where(F.pmod(F.xxhash64("text"), F.lit(passes)) == number)
        index = Index([(row["item_id"], bytes(row["text"])) for row in part.collect()])
        sent = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = sent.value
            for batch in batches:
                for low in range(0, batch.num_rows, _DOCS):
                    part = batch.slice(low, _DOCS)
                    matches = list(index.search(part["_text"].to_pylist()))
                    if not matches:
                        continue
                    at = pa.array([m[0] for m in matches], pa.int64())
                    columns = [part["doc_id"].take(at), pa.array([index.ids[m[1]] for m in matches])]
                    columns += [pa.array([m[i] for m in matches], t) for i, t in enumerate(kinds, 2)]
                    yield pa.RecordBatch.from_arrays([*columns, part["version"].take(at)], names)

        return rows.mapInArrow(run, shape)

    names = ["doc_id", "item_id", "start", "n_words", "similarity", "n_windows", "version"]
    kinds = [pa.int32(), pa.int32(), pa.float64(), pa.int32()]
    return reduce(DataFrame.unionByName, (found(number) for number in range(passes)))


def without(docs: DataFrame, bad: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` that ``bad`` (doc_id, version) doesn't name; null ids are compared like others.

    ``bad`` is broadcast if it was counted and weighed to be small, and else both sides are shuffled.
    """
    bad = settle(bad.select("doc_id", "version").distinct())
    other = (F.broadcast(bad) if fits_broadcast(bad) else bad).alias("bad")
    version = F.xxhash64(F.coalesce(F.col(f"docs.`{text_col}`"), F.lit("")))
    same = F.col(f"docs.`{id_col}`").eqNullSafe(F.col("bad.doc_id")) & (version == F.col("bad.version"))
    return docs.alias("docs").join(other, same, "left_anti")
