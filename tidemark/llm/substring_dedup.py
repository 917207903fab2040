"""Substring deduplication: passages that earlier documents hold are found by automata and cut out."""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import blocks as B
from tidemark.llm.words import run_hashes, utf8, word_hashes

WINDOW = 13
# A window's anchor is the smallest hash among its runs of this many words.
_RUN = 6
# Code points that can stand for words: all but the surrogates.
_CODES = 0x10F800


class _Words:
    """The words of a block's documents, one after the other, and hashes of their windows."""

    def __init__(self, table: pa.Table, window: int):
        self.window = window
        self.ids = table["doc_id"].to_pylist()
        self.lists = [text.as_py().split() for text in table["text"]]
        self.ends = np.cumsum([0, *map(len, self.lists)])
        hashes = word_hashes(list(itertools.chain.from_iterable(self.lists)))
        run = min(_RUN, window)
        low = run_hashes(hashes, run)
        width = window - run + 1
        have = 1
        while have < width:  # minima over windows that double
            step = min(have, width - have)
            low = np.minimum(low[: len(low) - step], low[step:]) if len(low) > step else low[:0]
            have += step
        self.hashes = run_hashes(hashes, window)
        place = np.arange(len(self.hashes))
        owner = np.searchsorted(self.ends, place, "right") - 1
        named = np.array([i is not None for i in self.ids], bool)
        # Windows inside one document that has an id.
        self.starts = place[(place + window <= self.ends[owner + 1]) & named[owner]] if len(place) else place
        self.owner = owner[self.starts] if len(place) else owner
        self.anchors = low[self.starts]

    def shared_inside(self) -> np.ndarray:
        """Anchors that several documents of this block have."""
        order = np.argsort(self.anchors, kind="stable")
        anchors, owner = self.anchors[order], self.owner[order]
        twice = (anchors[1:] == anchors[:-1]) & (owner[1:] != owner[:-1])
        return np.unique(anchors[1:][twice])

    def keep_shared(self, replies: list[bytes], shards: int) -> None:
        """Leaves the windows whose anchor several documents have."""
        asked = [part for part in B.split_sorted(np.unique(self.anchors), shards) if len(part)]
        found = [part[np.unpackbits(np.frombuffer(bits, np.uint8), count=len(part)).astype(bool)] for part, bits in zip(asked, replies, strict=True)]
        shared = np.union1d(np.concatenate([np.zeros(0, np.uint64), *found]), self.shared_inside())
        keep = np.isin(self.anchors, shared)
        self.starts, self.owner, self.anchors = self.starts[keep], self.owner[keep], self.anchors[keep]

    def first_inside(self) -> tuple[np.ndarray, np.ndarray]:
        """The windows left, each once and sorted, and the smallest id of this block that holds each."""
        ids = np.array([i or 0 for i in self.ids], np.int64)[self.owner]
        hashes = self.hashes[self.starts]
        order = np.lexsort((ids, hashes))
        hashes, ids = hashes[order], ids[order]
        new = np.append(True, hashes[1:] != hashes[:-1])[: len(hashes)]
        return hashes[new], ids[new]


def _shared(items: list[bytes], _: list[bytes]) -> list[bytes]:
    """For each block one bit per item: another block has it as well."""
    parts = [B.stretched(item) for item in items]
    _, place, count = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
    shared = np.split(count[place] > 1, np.cumsum([len(part) for part in parts])[:-1])
    return [np.packbits(part).tobytes() for part in shared]


def _first(items: list[bytes], values: list[bytes]) -> list[bytes]:
    """For each block one bit per item, whether a smaller id has it, and these ids."""
    parts = [B.stretched(item) for item in items]
    ids = np.concatenate([B.unpacked(value, np.int64) for value in values])
    _, place = np.unique(np.concatenate(parts), return_inverse=True)
    order = np.lexsort((ids, place))
    new = np.append(True, place[order][1:] != place[order][:-1])
    first = ids[order][new][place]
    cuts = np.cumsum([len(part) for part in parts])[:-1]
    both = zip(np.split(first, cuts), np.split(ids, cuts))
    return [np.packbits(low < own).tobytes() + B.packed(low[low < own]) for low, own in both]


def _automaton(words: _Words, confirmed: np.ndarray, first: np.ndarray):
    """An automaton of the passages that runs of confirmed windows make up, and the codes of their words."""
    starts, owner = words.starts[confirmed], words.owner[confirmed]
    breaks = (np.diff(starts) != 1) | (np.diff(owner) != 0) | (np.diff(first) != 0)
    lows = np.append(0, np.flatnonzero(breaks) + 1)
    highs = np.append(lows[1:], len(starts)) - 1
    passages = {}
    for low, high in zip(lows.tolist(), highs.tolist()):
        number = owner[low]
        base = words.ends[number]
        passage = words.lists[number][starts[low] - base : starts[high] - base + words.window]
        passages[tuple(passage)] = int(first[low])
    codes: dict[bytes, str] = {}
    for word in itertools.chain.from_iterable(passages):
        codes.setdefault(word, len(codes) + 1)
    # One character per word, or more where there are more words than characters; 0 stands for all other words.
    width = 1
    while (len(codes) + 1) > _CODES**width:
        width += 1

    def code(value: int) -> str:
        digits = [value // _CODES**i % _CODES for i in range(width)]
        return "".join(chr(d + 0x800 if d >= 0xD800 else d) for d in digits)

    codes = {word: code(value) for word, value in codes.items()}
    automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY)
    for passage, holder in passages.items():
        automaton.add_word("".join(map(codes.__getitem__, passage)), (len(passage), holder))
    automaton.make_automaton()
    return automaton, codes, code(0), width


def _cut(words: _Words, replies: list[bytes], shards: int) -> list[np.ndarray | None]:
    """For each document, the words to remove; None for none."""
    hashes, ids = words.first_inside()
    first = ids.copy()
    at = 0
    for part, reply in zip([p for p in B.split_sorted(hashes, shards) if len(p)], replies, strict=True):
        size = -(-len(part) // 8)
        lower = np.unpackbits(np.frombuffer(reply[:size], np.uint8), count=len(part)).astype(bool)
        first[at : at + len(part)][lower] = B.unpacked(reply[size:], np.int64)
        at += len(part)
    first = first[np.searchsorted(hashes, words.hashes[words.starts])]
    own = np.array([i or 0 for i in words.ids], np.int64)[words.owner]
    confirmed = first < own
    removed: list[np.ndarray | None] = [None] * len(words.ids)
    if not confirmed.any():
        return removed
    automaton, codes, other, width = _automaton(words, confirmed, first[confirmed])
    for number, (doc_id, text) in enumerate(zip(words.ids, words.lists)):
        if doc_id is None or len(text) < words.window:
            continue
        edges = None
        for end, (length, holder) in automaton.iter("".join([codes.get(word, other) for word in text])):
            if holder < doc_id and (end + 1) % width == 0:
                if edges is None:
                    edges = np.zeros(len(text) + 1, np.int64)
                stop = (end + 1) // width
                edges[stop - length] += 1
                edges[stop] -= 1
        if edges is not None:
            removed[number] = np.cumsum(edges[:-1]) > 0
    return removed


def dedup_passages(
    docs: DataFrame,
    window: int = WINDOW,
    with_text: bool = False,
    block_bytes: int = B.BLOCK_BYTES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: its words without those in windows that a document with a smaller id also holds.

    Words are what ASCII white space separates; a window is ``window`` consecutive words; all is judged on the texts as
    given. Blocks of documents first ask which anchors several documents have. A window's anchor is the smallest hash of
    its runs of six words, so equal windows have equal anchors, and about a quarter of the windows' number is sent.
    Windows with a shared anchor are then confirmed: the block learns the smallest id that holds each of them. Runs of
    confirmed windows are the passages from which each block compiles an Aho-Corasick automaton over words, and all
    documents of the block are streamed through it, which locates every occurrence. Windows are told apart by 64 bits.

    Null texts count as empty. Rows with a null id are left whole and cut nothing from others; rows with the same id
    cut nothing from each other. Ids must be whole numbers. Other columns are not read.

    Columns: doc_id, n_words, n_removed, kept_sha256, and the words kept, joined by spaces, as text if asked for.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), utf8(text_col).alias("text"))
    table = B.block_table(rows, block_bytes)
    shards = B.shard_count(table, block_bytes)

    def ask_anchors(rows: pa.Table) -> Iterator[tuple[int, bytes, bytes]]:
        for shard, part in enumerate(B.split_sorted(np.unique(_Words(rows, window).anchors), shards)):
            if len(part):
                yield shard, B.squeezed(part), b""

    def ask_windows(rows: pa.Table, replies: list[bytes]) -> pa.Table:
        words = _Words(rows, window)
        words.keep_shared(replies, shards)
        hashes, ids = words.first_inside()
        parts = B.split_sorted(hashes, shards)
        values = np.split(ids, np.cumsum([len(part) for part in parts])[:-1])
        asked = [(i, B.squeezed(part), B.packed(value)) for i, (part, value) in enumerate(zip(parts, values)) if len(part)]
        columns = list(zip(*asked)) or [(), (), ()]
        kinds = [pa.int32(), pa.binary(), pa.binary()]
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["shard", "items", "values"])

    def ask_windows_of(left: pa.Table, right: pa.Table) -> pa.Table:
        right = right.sort_by("shard")
        asked = ask_windows(B.rows_of(left["data"][0].as_py()), right["reply"].to_pylist())
        return asked.add_column(1, "block", pa.array([left["block"][0].as_py()] * len(asked), pa.int64()))

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        right = right.sort_by("shard")
        anchors = right.filter(pa.compute.equal(right["question"], 0))["reply"].to_pylist()
        windows = right.filter(pa.compute.equal(right["question"], 1))["reply"].to_pylist()
        words = _Words(B.rows_of(left["data"][0].as_py()), window)
        words.keep_shared(anchors, shards)
        ids, counts, cuts, prints, texts = words.ids, [], [], [], []
        for text, gone in zip(words.lists, _cut(words, windows, shards)):
            kept = text if gone is None else [word for word, g in zip(text, gone.tolist()) if not g]
            left_text = b" ".join(kept)
            counts.append(len(text))
            cuts.append(len(text) - len(kept))
            prints.append(hashlib.sha256(left_text).hexdigest())
            if with_text:
                texts.append(left_text.decode())
        columns = [pa.array(ids, pa.int64()), pa.array(counts, pa.int64()), pa.array(cuts, pa.int64()), pa.array(prints)]
        names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
        if with_text:
            columns, names = [*columns, pa.array(texts, pa.string())], [*names, "text"]
        return pa.Table.from_arrays(columns, names=names)

    anchors = B.answer(B.ask(table, ask_anchors), _shared)
    asked = table.groupBy("block").cogroup(anchors.groupBy("block"))
    asked = asked.applyInArrow(ask_windows_of, "shard int, block long, items binary, values binary")
    windows = B.answer(asked, _first)
    replies = anchors.withColumn("question", F.lit(0)).unionByName(windows.withColumn("question", F.lit(1)))
    shape = "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", text string" * with_text
    return table.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(finish, shape)
