"""Scores of texts by prediction by partial matching, and by single words."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import blocks as B
from tidemark.llm.words import scramble, utf8, word_hashes

#: Bytes of the longest context.
ORDER = 6
#: Contexts of this many bytes and more are told apart by shards; the counts of shorter ones are broadcast, which are
#: at most 256 ** 3 numbers for any corpus.
SPLIT = 3
BLOCK_BYTES = 8 << 20
_HEAD = 16
# Blocks are stored once and shuffled once.
_LEVEL = 3
_START = b"\n" * ORDER  # no word holds a line feed: it stands for what comes before a text and for its end


def _split(texts: pa.ChunkedArray) -> pa.ListArray:
    """The lower-cased words of each text; a text without words has an empty one."""
    texts = texts.combine_chunks()
    texts = pa.Array.from_buffers(pa.string(), len(texts), texts.buffers(), offset=texts.offset)
    return pc.ascii_split_whitespace(pc.ascii_trim_whitespace(pc.ascii_lower(texts)))


def _runs(texts: pa.ListArray, before: int, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """For every byte of the texts and their ends, the byte and those ``before`` it as one number; and where texts begin."""
    parts = pc.binary_join_element_wise(_START[:before].decode(), pc.binary_join(texts, " "), "\n", "")
    edges = np.frombuffer(parts.buffers()[1], np.int32)[parts.offset :][: len(parts) + 1]
    if not len(parts) or edges[-1] == edges[0]:
        return np.zeros(0, kind), np.zeros(0, np.int64)
    data = np.frombuffer(parts.buffers()[2], np.uint8)[edges[0] : edges[-1]]
    edges = edges.astype(np.int64) - edges[0]
    count = len(data) - before
    codes = data[:count].astype(kind)
    for at in range(1, before + 1):
        codes <<= kind(8)
        codes |= data[at : at + count]
    # Runs that begin in the last bytes of a text belong to no text.
    inside = np.ones(len(codes), bool)
    for at in range(1, before + 1):
        inside[edges[1:-1] - at] = False
    return codes[inside], edges[:-1] - before * np.arange(len(edges) - 1)


def _low_bytes(codes: np.ndarray, count: int) -> np.ndarray:
    return codes & np.uint64((1 << 8 * count) - 1)


def _sums(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, and the sums of their values."""
    found, place = np.unique(keys, return_inverse=True)
    return found, np.bincount(place, values, len(found))


def _distinct(codes: np.ndarray) -> np.ndarray:
    """Distinct numbers, sorted. A plain sort is far faster than one that keeps places."""
    codes = np.sort(codes)
    return codes[_changes(codes)]


def _changes(ranked: np.ndarray) -> np.ndarray:
    """Where a sorted number differs from the one before."""
    return np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1])[: len(ranked)])


def _distinct_counts(codes: np.ndarray, trained: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct numbers, sorted, and how often each occurs where ``trained``. Runs leave a bit free that says so."""
    keys = np.sort(codes << np.uint64(1) | trained)
    start = _changes(keys)
    keys, times = keys[start], np.diff(np.append(start, len(keys)))
    found, inside = keys >> np.uint64(1), (keys & np.uint64(1)).astype(bool)
    first = _changes(found)
    # A number that is met on both sides has its times where trained after the others.
    last = np.append(first[1:], len(found))[: len(first)] - 1
    return found[first], times[last] * inside[last]


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where sorted keys hold what is wanted, and whether they do."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    place = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return place, keys[place] == wanted


def _step(total: np.ndarray, kinds: np.ndarray, count: np.ndarray, met: np.ndarray) -> np.ndarray:
    """log10 of the share of a byte that the context has met, or of the escape to the next shorter context.

    Every byte met gives half a count to the escape. A context that has nothing left escapes for certain.
    """
    share = np.where(met, count - 0.5, 0.5 * kinds)
    return np.where(total > 0, np.log10(np.maximum(share, 0.5) / np.maximum(total, 1)), 0.0)


class Short:
    """Counts of bytes after contexts of at most two bytes."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray):
        order = np.argsort(codes)
        self.codes, self.counts = codes[order].astype(np.uint64), counts[order].astype(np.float64)
        context, symbol = (self.codes >> np.uint64(8)).astype(np.int64), (self.codes & np.uint64(255)).astype(np.int64)
        last = context & 255
        self.pair = np.zeros((256, 256))
        np.add.at(self.pair, (last, symbol), self.counts)
        self.single = self.pair.sum(axis=0)
        self.total2 = np.bincount(context, self.counts, 1 << 16)
        self.kinds2 = np.bincount(context, minlength=1 << 16)
        # What is left of a shorter context without the bytes that a longer one has met.
        met = np.bincount(context, self.pair[last, symbol], 1 << 16)
        lasts = np.arange(1 << 16) & 255
        self.total1 = self.pair.sum(axis=1)[lasts] - met
        self.kinds1 = (self.pair > 0).sum(axis=1)[lasts] - self.kinds2
        self.total0 = self.single.sum() - (self.single * (self.pair > 0)).sum(axis=1)
        self.kinds0 = (self.single > 0).sum() - (self.pair > 0).sum(axis=1)
        self.left = max(1, 256 - int((self.single > 0).sum()))

    def log10(self, codes: np.ndarray, met_total: np.ndarray, met_kinds: np.ndarray) -> np.ndarray:
        """Of the last byte of each three, after a longer context that has met so much of the two-byte context."""
        place, met = _find(self.codes, codes)
        context, symbol = (codes >> np.uint64(8)).astype(np.int64), (codes & np.uint64(255)).astype(np.int64)
        last = context & 255
        count = self.counts[place] if len(self.counts) else np.zeros(len(codes))
        result = _step(self.total2[context] - met_total, self.kinds2[context] - met_kinds, count, met)
        open_ = ~met
        met = self.pair[last, symbol] > 0
        result += open_ * _step(self.total1[context], self.kinds1[context], self.pair[last, symbol], met)
        open_ &= ~met
        met = self.single[symbol] > 0
        result += open_ * _step(self.total0[last], self.kinds0[last], self.single[symbol], met)
        open_ &= ~met
        return result - open_ * np.log10(self.left)


def log10_of_runs(codes: np.ndarray, counts: np.ndarray, short: Short) -> np.ndarray:
    """log10 of the probability of the last byte of each run after the bytes before it.

    ``codes`` are the distinct runs that begin with certain contexts of SPLIT bytes before their last byte, with their
    counts in the training texts. From the longest context down, a byte that the context has met gets its count less a
    half, of the context's total; else the context escapes to the next shorter one, from which the bytes already met
    are excluded. Below SPLIT bytes, ``short`` goes on; at last all bytes never met have equal shares.
    """
    codes, counts = codes.astype(np.uint64), counts.astype(np.float64)
    trained = counts > 0
    runs, sums = {}, {}
    runs[ORDER], sums[ORDER] = codes[trained], counts[trained]
    for order in range(ORDER - 1, SPLIT - 1, -1):
        runs[order], sums[order] = _sums(_low_bytes(runs[order + 1], order + 1), sums[order + 1])
    result = np.zeros(len(codes))
    open_ = np.ones(len(codes), bool)
    # What the longer context has met of this one.
    met_total, met_kinds = np.zeros(len(codes)), np.zeros(len(codes))
    for order in range(ORDER, SPLIT - 1, -1):
        keys, totals = _sums(runs[order] >> np.uint64(8), sums[order])
        kinds = _sums(runs[order] >> np.uint64(8), np.ones(len(runs[order])))[1]
        below = runs[order - 1] if order > SPLIT else short.codes
        place, _ = _find(below, _low_bytes(runs[order], order))
        in_below = (sums[order - 1] if order > SPLIT else short.counts)[place] if len(below) else np.zeros(len(place))
        in_below = _sums(runs[order] >> np.uint64(8), in_below)[1]
        at, known = _find(keys, _low_bytes(codes >> np.uint64(8), order))
        if len(keys):
            place, met = _find(runs[order], _low_bytes(codes, order + 1))
            use = open_ & known
            result += use * _step(totals[at] - met_total, kinds[at] - met_kinds, sums[order][place], met)
            open_ &= ~(met & known)
            met_total, met_kinds = np.where(known, in_below[at], 0), np.where(known, kinds[at], 0)
    return result + open_ * short.log10(_low_bytes(codes, SPLIT), met_total, met_kinds)


def short_counts(blocks: DataFrame) -> DataFrame:
    """code, n: how often three bytes follow each other in the training texts of all blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch["data"]:
                rows = B.rows_of(data.as_py())
                texts = _split(rows["text"].filter(pa.array(_trained(rows))))
                codes = np.sort(_runs(texts, SPLIT - 1, np.uint32)[0])
                start = _changes(codes)
                columns = [pa.array(codes[start].view(np.int32)), pa.array(np.diff(np.append(start, len(codes))))]
                yield pa.RecordBatch.from_arrays(columns, ["code", "n"])

    return blocks.mapInArrow(run, "code int, n long").groupBy("code").agg(F.sum("n").alias("n"))


def _squeeze(values: np.ndarray) -> bytes:
    """Whole numbers as the changes from one to the next, byte by byte, compressed."""
    changes = np.diff(values.astype(np.uint64), prepend=np.uint64(0))
    return zstandard.compress(np.ascontiguousarray(changes.view(np.uint8).reshape(-1, 8).T).tobytes(), 3)


def _stretch(data: bytes) -> np.ndarray:
    changes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(changes.T).view(np.uint64).ravel(), dtype=np.uint64)


def _packed(values: np.ndarray) -> bytes:
    return zstandard.compress(values.tobytes(), 3)


def _unpacked(data: bytes, kind: type) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(data), kind)


def _score_runs(short: Short, items: list[bytes], values: list[bytes]) -> list[bytes]:
    """For each block the log10 probability of each of its runs."""
    parts = [_stretch(item) for item in items]
    counts = np.concatenate([_unpacked(value, np.int32) for value in values])
    codes, place = np.unique(np.concatenate(parts), return_inverse=True)
    logs = log10_of_runs(codes, np.bincount(place, counts, len(codes)), short).astype(np.float32)[place]
    return [_packed(part) for part in np.split(logs, np.cumsum([len(part) for part in parts])[:-1])]


def _runs_by_shard(codes: np.ndarray, shards: int) -> list[tuple[int, np.ndarray]]:
    """Places of the runs of each shard that has any, in the order of the runs."""
    context = _low_bytes(codes >> np.uint64(8), SPLIT)
    return _parts(scramble(context + np.uint64(1)) % np.uint64(shards))


def _parts(shard: np.ndarray) -> list[tuple[int, np.ndarray]]:
    if len(shard) and shard.max() < 1 << 16:
        shard = shard.astype(np.uint16)  # which are sorted digit by digit
    order = np.argsort(shard, kind="stable")
    numbers, starts = np.unique(shard[order], return_index=True)
    return list(zip(numbers.tolist(), np.split(order, starts[1:])))


def _sum_words(items: list[bytes], values: list[bytes]) -> list[bytes]:
    """For each block the counts over all blocks of its words; before them the distinct words and the sum of this shard."""
    total: Counter[bytes] = Counter()
    lists = [zstandard.decompress(item).split(b"\n") for item in items]
    for words, value in zip(lists, values):
        for word, count in zip(words, _unpacked(value, np.int32).tolist()):
            total[word] += count
    head = np.array([sum(count > 0 for count in total.values()), total.total()], np.int64).tobytes()
    return [head + _packed(np.fromiter(map(total.__getitem__, words), np.int64, len(words))) for words in lists]


def _words_by_shard(words: list[bytes], shards: int) -> list[tuple[int, np.ndarray]]:
    """Places of the words of each shard that has any."""
    return _parts(word_hashes(words) % np.uint64(shards))


def _trained(rows: pa.Table) -> np.ndarray:
    """Which texts of the block are training texts."""
    return ~np.array(rows["held_out"].to_pylist(), bool)


def _block_words(texts: pa.ListArray) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The words of the texts, sorted; the places there of all tokens, text by text; and where texts begin.

    The empty word is the end token, which comes first among the words and last in each text.
    """
    empty = pa.array([""], pa.string())
    coded = pa.concat_arrays([empty, texts.flatten()]).dictionary_encode()
    order = pc.sort_indices(coded.dictionary)
    words = coded.dictionary.take(order).cast(pa.binary()).to_pylist()
    place = np.empty(len(words), np.int64)
    place[order.to_numpy()] = np.arange(len(words))
    found = place[coded.indices.to_numpy()[1:]]
    lengths = texts.value_lengths().to_numpy().astype(np.int64)
    # A text without words has its end token already.
    first = np.cumsum(lengths) - lengths
    ends = (found[first] != 0).astype(np.int64)
    tokens = np.zeros(len(found) + ends.sum(), np.int64)
    tokens[np.arange(len(found)) + np.repeat(np.cumsum(ends) - ends, lengths)] = found
    lengths += ends
    return words, tokens, np.cumsum(lengths) - lengths


def _block_counts(rows: pa.Table) -> tuple[list[bytes], np.ndarray]:
    """The block's words, sorted, with their counts in its training texts. The empty word is the end token."""
    words, tokens, first = _block_words(_split(rows["text"]))
    trained = np.repeat(_trained(rows), np.diff(np.append(first, len(tokens))))
    return words, np.bincount(tokens[trained], minlength=len(words)).astype(np.int32)


def _sums_by_text(codes: np.ndarray, first: np.ndarray, found: np.ndarray, logs: np.ndarray) -> np.ndarray:
    """For each text the sum over its runs of what ``logs`` has at the run's place in ``found``.

    Texts are taken 256 at a time, the number of a text in the byte that a run leaves free, and their runs sorted, for
    sorted numbers are looked up far faster, and each run once.
    """
    bounds, sums = np.append(first, len(codes)), np.zeros(len(first))
    for low in range(0, len(first), 256):
        part = bounds[low : low + 257]
        number = np.repeat(np.arange(len(part) - 1, dtype=np.uint64), np.diff(part))
        keys = np.sort(codes[part[0] : part[-1]] << np.uint64(8) | number)
        start = _changes(keys >> np.uint64(8))
        values = logs[np.searchsorted(found, keys[start] >> np.uint64(8))].astype(np.float64)
        values = np.repeat(values, np.diff(np.append(start, len(keys))))
        sums[low : low + 256] = np.bincount((keys & np.uint64(255)).astype(np.int64), values, len(part) - 1)
    return sums


def score_texts(
    docs: DataFrame,
    held_out: Column | None = None,
    block_bytes: int = BLOCK_BYTES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: log10 probabilities of its whole text, by words and by bytes.

    ASCII letters are lower-cased; words are what ASCII white space separates, followed by one end token. The model of
    bytes is a pretrained trie with contexts of up to six bytes over the words joined by single spaces and an end byte
    (see `log10_of_runs`). Its counts come from all texts but those ``held_out``, as do the word counts of the base.

    Neither the words nor the trie are ever in one place. Blocks of documents ask for the words and for the runs of
    seven bytes that they hold (see `blocks`). Runs are dealt out by the three bytes before the last one, so a shard has
    the whole part of the trie that its answers need, down to the contexts of three bytes; the counts of three bytes in
    a row, which are at most 256 ** 3 whatever the corpus, are broadcast for the rest.

    Null texts count as empty: one end token. By default a row is held out if the CRC of its id, as text, has remainder
    1 by 5; a null id counts as an empty text there. Repeated rows count each. Without training texts all counts are 0.
    Other columns are not read.

    Columns: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.
    """
    if held_out is None:
        held_out = F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 5 == 1
    rows = docs.select(F.col(id_col).alias("doc_id"), held_out.alias("held_out"), utf8(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    table = B.block_table(rows, block_bytes, _LEVEL)
    shards = B.shard_count(table, block_bytes)

    def ask_words(rows: pa.Table) -> Iterator[tuple[int, bytes, bytes]]:
        words, counts = _block_counts(rows)
        for shard, places in _words_by_shard(words, shards):
            yield shard, zstandard.compress(b"\n".join([words[i] for i in places.tolist()]), 3), _packed(counts[places])

    def ask_runs(rows: pa.Table) -> Iterator[tuple[int, bytes, bytes]]:
        codes, first = _runs(_split(rows["text"]), ORDER, np.uint64)
        trained = np.repeat(_trained(rows), np.diff(np.append(first, len(codes))))
        found, counts = _distinct_counts(codes, trained)
        counts = counts.astype(np.int32)
        for shard, places in _runs_by_shard(found, shards):
            yield shard, _squeeze(found[places]), _packed(counts[places])

    # Every reply about words begins with its shard's number of distinct words and their sum.
    of_words = B.answer(B.ask(table, ask_words), _sum_words)
    heads = of_words.groupBy("shard").agg(F.min(F.substring("reply", 1, _HEAD)).alias("head")).collect()
    distinct, tokens = (sum(np.frombuffer(bytes(row["head"]), np.int64)[i].item() for row in heads) for i in (0, 1))
    found = short_counts(table).toArrow()
    short = docs.sparkSession.sparkContext.broadcast(Short(found["code"].to_numpy(), found["n"].to_numpy()))
    of_runs = B.answer(B.ask(table, ask_runs), lambda items, values: _score_runs(short.value, items, values), keep=False)
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]

    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = B.rows_of(left["data"][0].as_py())
        right = right.sort_by("shard")
        by_words, by_runs = (right.filter(pc.equal(right["question"], i))["reply"].to_pylist() for i in (0, 1))
        texts = _split(rows["text"])
        words, own, begin = _block_words(texts)
        known = np.empty(len(words), np.int64)
        for (_, places), reply in zip(_words_by_shard(words, shards), by_words, strict=True):
            known[places] = _unpacked(reply[_HEAD:], np.int64)
        codes, first = _runs(texts, ORDER, np.uint64)
        found = _distinct(codes)
        logs = np.empty(len(found), np.float32)
        for (_, places), reply in zip(_runs_by_shard(found, shards), by_runs, strict=True):
            logs[places] = _unpacked(reply, np.float32)
        score = _sums_by_text(codes, first, found, logs)
        parts = (np.log10(known + 0.5) - np.log10(tokens + 0.5 * (distinct + 1)))[own]
        lengths = np.diff(np.append(begin, len(own)))
        met = np.add.reduceat((known > 0)[own], begin, dtype=np.int64)
        base = [part.sum() for part in np.split(parts, begin[1:])]
        columns = [rows["doc_id"], rows["held_out"], pa.array(lengths, pa.int64()), pa.array(met, pa.int64())]
        columns += [pa.array([tokens] * len(lengths), pa.int64()), pa.array(base, pa.float64()), pa.array(score, pa.float64())]
        return pa.Table.from_arrays(columns, names=names)

    shape = f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    replies = of_words.withColumn("question", F.lit(0)).unionByName(of_runs.withColumn("question", F.lit(1)))
    return table.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(work, shape)
