import random

import numpy as np
import pyarrow as pa

from tidemark.llm.lm_scoring import ORDER, _block_words, _distinct_counts, _runs, _split, _sums_by_text


def block(rng):
    letters = b" \t\n\x0b\x0c\r\x1c\x85\xa0aAbZ\xc3"
    return [bytes(rng.choices(letters, k=rng.randint(0, 20))) for _ in range(rng.randint(1, 6))]


def test_blocks_are_read_like_their_texts():
    rng = random.Random(3)
    for texts in [[b""], [b"  ", b"a", b""], *(block(rng) for _ in range(200))]:
        lists = _split(pa.chunked_array([pa.array([b"not this", *texts], pa.binary()).slice(1)]))
        words, tokens, first = _block_words(lists)
        want = [text.lower().split() for text in texts]
        assert words == sorted({b"", *(word for own in want for word in own)})
        assert [[words[i] for i in own] for own in np.split(tokens, first[1:])] == [[*own, b""] for own in want]
        for before, kind in ((ORDER, np.uint64), (2, np.uint32)):
            codes, first = _runs(lists, before, kind)
            parts = [b"\n" * before + b" ".join(own) + b"\n" for own in want]
            runs = [[int.from_bytes(part[i : i + before + 1]) for i in range(len(part) - before)] for part in parts]
            assert [own.tolist() for own in np.split(codes, first[1:])] == runs


def test_runs_are_counted_and_summed_once_each():
    rng = np.random.default_rng(3)
    codes = rng.integers(0, 50, 4000).astype(np.uint64) << np.uint64(48)
    trained, first = rng.random(4000) < 0.5, np.sort(rng.choice(np.arange(1, 4000), 600, replace=False))
    first = np.append(0, first)
    found, counts = _distinct_counts(codes, trained)
    assert found.tolist() == sorted(set(codes.tolist()))
    assert counts.tolist() == [int((codes[trained] == code).sum()) for code in found]
    logs = rng.random(len(found)).astype(np.float32)
    want = [part.sum() for part in np.split(logs.astype(float)[np.searchsorted(found, codes)], first[1:])]
    assert np.allclose(_sums_by_text(codes, first, found, logs), want)
    assert not len(_distinct_counts(codes[:0], trained[:0])[0]) and not len(_runs(_split(pa.chunked_array([], pa.binary())), ORDER, np.uint64)[0])
