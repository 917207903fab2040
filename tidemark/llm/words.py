"""Words of texts as numbers, inside tasks."""

from __future__ import annotations

import numpy as np
import xxhash

from pyspark.sql import Column
from pyspark.sql import functions as F

_ONCE = np.uint64(0x9E3779B97F4A7C15)
_TWICE = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def utf8(column: str) -> Column:
    """The text as bytes; null counts as empty."""
    return F.coalesce(F.col(column), F.lit("")).cast("binary")


# Letters, digits and all bytes beyond ASCII make up words; ASCII letters are lower-cased.
_WORD_BYTES = bytes(b if chr(b).isalnum() or b >= 128 else 32 for b in range(256))


def plain_words(text: bytes) -> list[bytes]:
    """Lower-cased runs of letters, digits and characters beyond ASCII."""
    return text.lower().translate(_WORD_BYTES).split()


def word_hashes(words: list[bytes]) -> np.ndarray:
    # Looking words up among those met before takes twice as long.
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def scramble(values: np.ndarray) -> np.ndarray:
    """A one-to-one mix of 64-bit numbers, so that their order and their low bits look random."""
    with np.errstate(over="ignore"):
        values = (values ^ (values >> np.uint64(30))) * _TWICE[0]
        values = (values ^ (values >> np.uint64(27))) * _TWICE[1]
    return values ^ (values >> np.uint64(31))


def run_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """One 64-bit hash for each run of ``size`` neighbours; empty when there are fewer."""
    count = len(hashes) - size + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(count, np.uint64)
    with np.errstate(over="ignore"):
        for at in range(size):
            total = total * _ONCE + hashes[at : at + count]
    return scramble(total)
