"""Documents in compressed blocks, and questions that blocks ask about what all blocks hold.

Some operators need to know, for each of very many small items inside texts (words, runs of words), something about the
whole corpus. A row per item and a join would shuffle many times the corpus. Here a block of documents asks once for
each distinct item: it sends its items as packed arrays, dealt out to shards by the item's hash; a shard sees the items
of all blocks and answers each block in the order asked. An item that all documents hold is sent once per block, so hot
items are no heavier than others.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard

from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import settle, shuffle_partitions

#: Text per block, before compression. Blocks of 64 MB and more suit corpora of many terabytes.
BLOCK_BYTES = 4 << 20
#: Text per shard of a question.
SHARD_BYTES = 256 << 20
LEAST_SHARDS = 64


def block_table(docs: DataFrame, block_bytes: int = BLOCK_BYTES, level: int | None = None) -> DataFrame:
    """block, data: consecutive rows of ``docs``, of about ``block_bytes``, as compressed Arrow data.

    A higher ``level`` of compression takes longer and saves space.

    The table is settled, so that a block has the same rows whenever it is read. A row that is larger makes up a block
    of its own.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held: list[pa.RecordBatch] = []
        weight = 0
        for batch in batches:
            sizes = np.cumsum(np.diff(np.frombuffer(batch["text"].buffers()[1], np.int32)[batch["text"].offset :][: batch.num_rows + 1]))
            low = 0
            while low < batch.num_rows:
                before = int(sizes[low - 1]) if low else 0
                high = max(low + 1, int(np.searchsorted(sizes, before + block_bytes - weight, "right")))
                held.append(batch.slice(low, high - low))
                weight += int(sizes[high - 1]) - before
                low = high
                if weight >= block_bytes or low < batch.num_rows:
                    yield _block(number, held, level)
                    number, held, weight = number + 1, [], 0
        if held:
            yield _block(number, held, level)

    return settle(docs.mapInArrow(run, "block long, data binary"))


def _block(number: int, held: list[pa.RecordBatch], level: int | None) -> pa.RecordBatch:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, held[0].schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", level))) as out:
        for batch in held:
            out.write_batch(batch)
    return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["block", "data"])


def rows_of(data: bytes) -> pa.Table:
    return pa.ipc.open_stream(data).read_all()


def shard_count(blocks: DataFrame, block_bytes: int = BLOCK_BYTES) -> int:
    return max(LEAST_SHARDS, shuffle_partitions(blocks.sparkSession), blocks.count() * block_bytes // SHARD_BYTES)


def ask(blocks: DataFrame, question: Callable[[pa.Table], Iterator[tuple[int, bytes, bytes]]]) -> DataFrame:
    """shard, block, items, values: what each block asks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, data in zip(batch["block"].to_pylist(), batch["data"]):
                asked = list(question(rows_of(data.as_py())))
                if asked:
                    shards, items, values = zip(*asked)
                    columns = [pa.array(shards, pa.int32()), pa.array([number] * len(asked), pa.int64())]
                    yield pa.RecordBatch.from_arrays([*columns, pa.array(items, pa.binary()), pa.array(values, pa.binary())], names)

    names = ["shard", "block", "items", "values"]
    return blocks.mapInArrow(run, "shard int, block long, items binary, values binary")


def answer(asked: DataFrame, reply: Callable[[list[bytes], list[bytes]], list[bytes]], keep: bool = True) -> DataFrame:
    """block, shard, reply: for each shard, what ``reply`` makes of the items and values of all blocks.

    Replies that are read once only need not be kept; a lost one is then worked out again from its shard.
    """

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("block")
        return frame[["block", "shard"]].assign(reply=reply(list(frame["items"]), list(frame["values"])))

    replies = asked.groupBy("shard").applyInPandas(run, "block long, shard int, reply binary")
    return settle(replies) if keep else replies


def split_sorted(items: np.ndarray, shards: int) -> list[np.ndarray]:
    """Sorted 64-bit numbers, cut into equal ranges of all numbers."""
    edges = np.array([(i << 64) // shards for i in range(1, shards)], np.uint64)
    return np.split(items, np.searchsorted(items, edges))


def packed(values: np.ndarray) -> bytes:
    return zstandard.compress(values.tobytes(), 3)


def unpacked(data: bytes, kind: type) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(data), kind)


def squeezed(values: np.ndarray) -> bytes:
    """Sorted whole numbers as the changes from one to the next, byte by byte, compressed."""
    changes = np.diff(values.astype(np.uint64), prepend=np.uint64(0))
    return zstandard.compress(np.ascontiguousarray(changes.view(np.uint8).reshape(-1, 8).T).tobytes(), 3)


def stretched(data: bytes) -> np.ndarray:
    changes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(changes.T).view(np.uint64).ravel(), dtype=np.uint64)
