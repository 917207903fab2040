"""Token counts of whole texts, huge ones in overlapping chunks."""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK = 1 << 15
OVERLAP = 256
_MARK = "▁"  # stands for a space in pieces
_MARK_BYTES = _MARK.encode()


@functools.cache
def load(path: str) -> tuple[sentencepiece.SentencePieceProcessor, np.ndarray, bool]:
    """The tokenizer, the bytes that each piece stands for, and whether no piece has a space after another character."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    sizes = [1 if model.is_byte(i) else len(piece.replace(_MARK, " ").encode()) for i, piece in enumerate(pieces)]
    return model, np.array(sizes), not any(_MARK in piece.lstrip(_MARK) for piece in pieces)


def _stable(data: bytes, at: int) -> bool:
    """No piece can reach across: a space begins here, and pieces hold spaces at their start only."""
    return 0 < at < len(data) and data[at] == 32 and data[at - 1] != 32 and data[max(0, at - 3) : at] != _MARK_BYTES


def _cut(data: bytes, at: int) -> int:
    """The start of the character at a place."""
    while 0 < at < len(data) and data[at] & 0xC0 == 0x80:
        at -= 1
    return min(at, len(data))


def _starts(model: sentencepiece.SentencePieceProcessor, sizes: np.ndarray, data: bytes, start: int, stop: int) -> np.ndarray:
    """Where the pieces of a chunk begin. The first begins at the space that the tokenizer puts before a text."""
    text = data[start:stop].decode()
    ends = np.cumsum(sizes[np.array(model.encode(text), np.int64)])
    if len(ends) and ends[-1] == stop - start + 1:
        return start - 1 + np.append(0, ends[:-1])
    # Characters that the tokenizer changes: it tells the places itself, at a price.
    return np.array([start + piece.begin for piece in model.encode(text, return_type="proto").pieces], np.int64)


def count_long(
    model: sentencepiece.SentencePieceProcessor,
    sizes: np.ndarray,
    text: str,
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
) -> int:
    """Number of tokens of the whole text, from chunks of about ``chunk`` bytes that overlap.

    Neighbouring chunks are spliced at a place in their overlap where both begin a piece and which no piece can reach
    across. Where the overlap holds none it is widened, and where the whole chunk holds none the chunk is.
    """
    data = text.encode()
    chunk, overlap = max(chunk, 16), max(overlap, 8)
    total, since, stop = 0, 0, _cut(data, chunk)
    here = np.maximum(_starts(model, sizes, data, 0, stop), 0)
    while stop < len(data):
        wide, splice = overlap, None
        while splice is None:
            base = max(since, _cut(data, stop - wide))
            if base == since:
                break
            until = _cut(data, stop + chunk)
            there = _starts(model, sizes, data, base, until)
            common = np.intersect1d(here[here > base], there[there < stop])
            splice = next((int(at) for at in common[::-1] if _stable(data, int(at))), None)
            wide *= 2
        if splice is None:
            # The space at the last splice is the one that the tokenizer itself puts before a text.
            stop = _cut(data, since + 2 * (stop - since))
            here = np.maximum(_starts(model, sizes, data, since + (since > 0), stop), 0)
            continue
        total += int(((here >= since) & (here < splice)).sum())
        here, since, stop = there[there >= splice], splice, until
    return total + int((here >= since).sum())


def count_tokens(
    docs: DataFrame,
    model_path: str,
    limit: int = 4096,
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: bytes and tokens of its whole text, and whether the tokens exceed ``limit``.

    Texts of up to ``chunk`` characters are encoded at once, longer ones in chunks, so that memory stays bounded by
    the chunk. The path must lead to the model on every executor. Null texts count as empty and have no tokens;
    ids, null ones too, are handed through, and repeated rows give repeated results. Other columns are not read.

    Columns: doc_id, n_bytes, n_tokens, over_limit.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, sizes, splits = load(model_path)
        for batch in batches:
            texts = batch["_text"].to_pylist()
            short = [i for i, text in enumerate(texts) if len(text) <= chunk or not splits]
            counts = [0] * len(texts)
            # A few texts at a time, for the lists of tokens take more memory than the texts.
            for at in range(0, len(short), 64):
                part = short[at : at + 64]
                for i, tokens in zip(part, model.encode([texts[i] for i in part], num_threads=1)):
                    counts[i] = len(tokens)
            for i in set(range(len(texts))).difference(short):
                counts[i] = count_long(model, sizes, texts[i], chunk, overlap)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["n_bytes"], pa.array(counts, pa.int64())], names)

    names = ["doc_id", "n_bytes", "n_tokens"]
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("_text"))
    counted = rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
