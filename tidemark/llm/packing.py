"""Packing of tokenized documents into sequences of power-of-two lengths."""

from __future__ import annotations

import functools
import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

END_ID = 0
_CACHED_WORDS = 1_000_000
_TOGETHER = 1000
_DOCS = 64


class _Encoder:
    """Token ids as little-endian bytes, from the tokenizer's own ids of single words.

    The tokenizer first cuts texts before a space between two other characters, around a line feed between two other
    characters, and between a letter and the punctuation after it, and encodes the parts one by one. So a text has the
    ids of its parts, and parts that occur again are remembered. Texts with more white space in a row, or with a special
    token's string, are encoded whole. So are all texts by tokenizers that cut texts in another way.
    """

    # All that the tokenizer may take for white space, and a little more.
    _unsure = re.compile(r"\s(?=\s|\Z)")
    _space = re.compile(r"\s")
    _closing = frozenset(".,;:!?")

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        vocabulary = self.tokenizer.get_vocab()
        # A byte-level token has one character for each byte.
        self.sizes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, number in vocabulary.items():
            self.sizes[number] = len(token)
        self.known: dict[str, bytes] = {}
        parts = json.loads(self.tokenizer.to_str())
        cut, model = parts["pre_tokenizer"] or {}, parts["model"]
        plain = parts["normalizer"] is None and model["type"] == "BPE" and not model.get("dropout") and not model.get("unk_token")
        self.by_parts = plain and cut.get("type") == "ByteLevel" and cut.get("use_regex") and not cut.get("add_prefix_space")

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _together(self, parts: list[str]) -> list[bytes]:
        """Ids of parts that begin with a space and hold no other, encoded as one text and cut at their bytes."""
        encoded = self.tokenizer.encode_batch_fast(["".join(parts)], add_special_tokens=False)[0]
        ids = np.array(encoded.ids, "<u4")
        ends = np.cumsum([len(part.encode()) for part in parts])
        cuts = np.searchsorted(np.cumsum(self.sizes[ids]), ends) + 1
        data, starts = ids.tobytes(), [0, *cuts[:-1].tolist()]
        return [data[4 * low : 4 * high] for low, high in zip(starts, cuts.tolist())]

    def _learn(self, words: set[str]) -> None:
        """Remembers parts; a letter and the punctuation mark at the end of a word are parts of their own."""
        known, split, plain = self.known, [], []
        for word in words:
            if word[-1:] in self._closing and word[-2:-1].isalpha():
                split.append(word)
            elif word[:1] == " " and len(word) > 1 and not self._space.search(word, 1):
                plain.append(word)
            else:
                known[word] = self.whole(word)
        stems = {word[:-1] for word in split}.difference(known, plain)
        for stem in stems:
            if stem[:1] == " " and not self._space.search(stem, 1):
                plain.append(stem)
            else:
                known[stem] = self.whole(stem)
        for at in range(0, len(plain), _TOGETHER):
            part = plain[at : at + _TOGETHER]
            known.update(zip(part, self._together(part)))
        for mark in {word[-1] for word in split}.difference(known):
            known[mark] = self.whole(mark)
        for word in split:
            known[word] = known[word[:-1]] + known[word[-1]]

    def _parts(self, text: str) -> list[str] | None:
        """Each part but the first of a line keeps the space before it; line feeds are parts of their own."""
        if not self.by_parts or "\0" in text or any(token in text for token in self.special) or self._unsure.search(text):
            return None
        return text.replace("\n", "\0\n\0").replace(" ", "\0 ").split("\0")

    def __call__(self, texts: list[str]) -> list[bytes]:
        known = self.known
        if len(known) > _CACHED_WORDS:
            known.clear()
        cut = [self._parts(text) for text in texts]
        new = set().union(*(parts for parts in cut if parts)).difference(known)
        if new:
            self._learn(new)
        find = known.__getitem__
        return [self.whole(text) if parts is None else b"".join(map(find, parts)) for text, parts in zip(texts, cut)]


@functools.cache
def encoder(path: str) -> _Encoder:
    return _Encoder(path)


def binary_lengths(tokens: int, longest: int) -> list[int]:
    """Powers of two that add up to ``tokens``: as many of ``longest`` as fit, then each smaller one at most once."""
    rest = tokens % longest
    return [longest] * (tokens // longest) + [1 << bit for bit in range(longest.bit_length() - 2, -1, -1) if rest >> bit & 1]


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    longest: int = 1024,
    with_ids: bool = False,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece of a document: its place in the document and the sequence that it makes up.

    A document's token ids, with the end id 0 after them, are cut into pieces whose lengths are powers of two of at
    most ``longest``, the longest first. Every piece is a sequence of its own, so no sequence crosses documents and
    none is padded. Sequences of the same length form a bucket, named by the length; a training run draws its batches
    from one bucket at a time. A sequence id is the number of the task above 33 bits for the place in the task, so
    no shuffle is needed, and a task that runs again gives the same ids as long as ``docs`` gives it the same rows.

    Null texts count as empty, that is one piece with the end id alone. Ids, null ones too, are handed through, and
    repeated rows are packed each time. Other columns are not read. The path must lead to the tokenizer on every
    executor.

    Columns: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and the ids if asked for.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError("longest must be a power of two")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    shape = f"doc_id {kind}, " + ", ".join(f"{name} long" for name in names[1:]) + ", ids array<int>" * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer_path)
        end = END_ID.to_bytes(4, "little")
        number = TaskContext.get().partitionId() << 33
        for batch in batches:
            # Some documents at a time, so that few tokens are held at once.
            for low in range(0, batch.num_rows, _DOCS):
                part = batch.slice(low, _DOCS)
                owner, start, length, check, tokens, ids = [], [], [], [], [], []
                for row, data in enumerate(encode(part["_text"].to_pylist())):
                    data += end
                    count, at = len(data) // 4, 0
                    for size in binary_lengths(count, longest):
                        piece = data[4 * at : 4 * (at + size)]
                        owner.append(row)
                        start.append(at)
                        length.append(size)
                        check.append(zlib.crc32(piece))
                        tokens.append(count)
                        if with_ids:
                            ids.append(np.frombuffer(piece, "<i4"))
                        at += size
                columns = [part["doc_id"].take(pa.array(owner, pa.int64()))]
                columns += [pa.array(x, pa.int64()) for x in (start, length, check, tokens)]
                columns += [pa.array(np.arange(number, number + len(owner))), pa.array(np.zeros(len(owner), np.int64))]
                number += len(owner)
                if with_ids:
                    columns.append(pa.array(ids, pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, names + ["ids"] * with_ids)

    return rows.mapInArrow(run, shape)
