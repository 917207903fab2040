"""Samples of a stated size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_STEPS = 1 << 40


def hash_sample(df: DataFrame, columns: Sequence[str], rows: int) -> DataFrame:
    """About ``rows`` rows, those with small hashes of ``columns``; all if there are no more. At most twice as many.

    Rows are counted first and then filtered, so each task hands on its share only, and a rerun finds the same rows.
    """
    total = df.count()
    if total <= rows:
        return df
    return df.where(F.pmod(F.xxhash64(*columns), F.lit(_STEPS)) < _STEPS * rows // total).limit(2 * rows)
