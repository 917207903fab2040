"""Change rows that are newer than all before them, by a state for each key."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd

from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def newest_only(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The rows of a stream that come after all rows of their key so far, by the ``order`` columns.

    Sources deliver changes at least once, and late. What was seen before, or is older than what was, never reaches
    storage; of the changes of a key in one batch, those that are older than others before them in the batch are left out as
    well. The state is one row of ``order`` values for each key that was ever seen.

    The ``order`` columns must be numbers that are never null; other columns must have types that Arrow knows. A key's rows
    of one batch come in pieces, so a hot key is never held whole.
    """
    schema = rows.schema
    places = T.StructType([T.StructField(name, T.LongType()) for name in order])
    for name in order:
        if not isinstance(schema[name].dataType, T.IntegralType):
            raise ValueError(f"{name} is not a whole number")

    def newer(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        top = tuple(state.get) if state.exists else None
        for frame in frames:
            frame = frame.sort_values(list(order), kind="stable")
            kept = []
            for at, place in enumerate(zip(*(frame[name].tolist() for name in order))):
                if top is None or place > top:
                    kept.append(at)
                    top = place
            # Only the last one of a piece is needed: it replaces the others.
            if kept:
                yield frame.iloc[kept[-1:]]
        if top is not None:
            state.update(tuple(int(x) for x in top))

    return rows.groupBy(*keys).applyInPandasWithState(newer, schema, places, "append", GroupStateTimeout.NoTimeout)
