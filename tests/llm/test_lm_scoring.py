import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tidemark.llm.lm_scoring import ORDER, Short, log10_of_runs, score_texts


def brute(rows):
    """Word counts and partial matching by plain dictionaries."""
    words = [(t or "").encode().lower().split() for _, t in rows]
    held = [zlib.crc32(str(i).encode() if i is not None else b"") % 5 == 1 for i, _ in rows]
    counts = Counter(w for ws, h in zip(words, held) if not h for w in [*ws, None])
    total, kinds = counts.total(), len(counts)
    trie = defaultdict(Counter)
    streams = [b"\n" * ORDER + b" ".join(ws) + b"\n" for ws in words]
    for stream, h in zip(streams, held):
        if not h:
            for k in range(ORDER, len(stream)):
                for order in range(ORDER + 1):
                    trie[stream[k - order : k]][stream[k]] += 1

    def chance(context, symbol):
        share, seen = 1.0, set()
        for order in range(ORDER, -1, -1):
            here = {s: n for s, n in trie[context[ORDER - order :]].items() if s not in seen}
            if not here:
                continue
            if symbol in here:
                return share * (here[symbol] - 0.5) / sum(here.values())
            share *= 0.5 * len(here) / sum(here.values())
            seen |= set(here)
        return share / (256 - len(seen))

    out = []
    for (i, _), ws, h, stream in zip(rows, words, held, streams):
        tokens = [*ws, None]
        base = sum(math.log10((counts[t] + 0.5) / (total + 0.5 * (kinds + 1))) for t in tokens)
        score = sum(math.log10(chance(stream[k - ORDER : k], stream[k])) for k in range(ORDER, len(stream)))
        out.append((i, h, len(tokens), sum(counts[t] > 0 for t in tokens), total, base, score))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block_bytes", [1 << 22, 700])
def test_scores(odd, odd_rows, block_bytes):
    got = sorted((tuple(r) for r in score_texts(odd, block_bytes=block_bytes).collect()), key=repr)
    want = brute(odd_rows)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(got, want):
        assert g[5:] == pytest.approx(w[5:], rel=1e-5)


def test_probabilities_add_up():
    rng = np.random.default_rng(0)
    stream = rng.integers(97, 101, 500).astype(np.uint64)
    runs = sum(stream[i : len(stream) - ORDER + i] << np.uint64(8 * (ORDER - i)) for i in range(ORDER + 1))
    runs, counts = np.unique(runs, return_counts=True)
    last, n = np.unique(runs & np.uint64(0xFFFFFF), return_inverse=True)
    short = Short(last.astype(np.int32), np.bincount(n, counts))
    contexts = [*(runs[::40] >> np.uint64(8)), np.uint64(0x616161616161), np.uint64(0x7A7A7A7A7A7A), np.uint64(0x7A7A7A7A7A61)]
    every = np.concatenate([np.arange(256, dtype=np.uint64) | c << np.uint64(8) for c in contexts])
    codes = np.union1d(every, runs)
    weights = np.zeros(len(codes))
    weights[np.searchsorted(codes, runs)] = counts
    logs = log10_of_runs(codes, weights, short)
    chances = 10.0 ** logs[np.searchsorted(codes, every)].reshape(-1, 256)
    assert np.allclose(chances.sum(axis=1), 1)
    none = Short(np.zeros(0, np.int32), np.zeros(0))
    assert np.allclose(10.0 ** log10_of_runs(codes, 0 * weights, none), 1 / 256)


def test_held_out_texts_are_predicted_better_than_by_words(spark):
    rows = score_texts(spark.read.parquet("/root/testdata/sf0.1/documents.parquet")).where("held_out").collect()
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)


def test_no_rows(empty):
    assert score_texts(empty).collect() == []
