import itertools

import pandas as pd
import pyarrow as pa

from tidemark.llm import line_dedup, toxicity


def test_workers_take_some_rows_at_a_time():
    batch = pa.RecordBatch.from_arrays([pa.array(range(1234))], ["n"])
    parts = list(toxicity._slices([batch, batch.slice(0, 0), batch.slice(5, 1)]))
    assert max(part.num_rows for part in parts) <= toxicity._DOCS
    assert list(itertools.chain.from_iterable(part["n"].to_pylist() for part in parts)) == [*range(1234), 5]
    frame = pd.DataFrame({"n": range(1234)})
    frames = list(line_dedup._slices([frame, frame[:0], frame[5:6]]))
    assert max(map(len, frames)) <= line_dedup._DOCS
    assert list(itertools.chain.from_iterable(frames[i]["n"] for i in range(len(frames)))) == [*range(1234), 5]
