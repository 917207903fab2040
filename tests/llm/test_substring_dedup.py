import hashlib

import pytest

from tidemark.llm import substring_dedup as S


def brute(rows, size):
    lists = [(t or "").encode().split() for _, t in rows]
    first = {}
    for (i, _), words in zip(rows, lists):
        if i is not None:
            for k in range(len(words) - size + 1):
                key = tuple(words[k : k + size])
                first[key] = min(i, first.get(key, i))
    out = []
    for (i, _), words in zip(rows, lists):
        gone = set()
        for k in range(len(words) - size + 1):
            if i is not None and first[tuple(words[k : k + size])] < i:
                gone.update(range(k, k + size))
        kept = b" ".join(w for k, w in enumerate(words) if k not in gone)
        out.append((i, len(words), len(gone), hashlib.sha256(kept).hexdigest(), kept.decode()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("size", [13, 4, 2])
@pytest.mark.parametrize("block_bytes", [1 << 22, 900])
def test_documents(odd, odd_rows, size, block_bytes):
    got = S.dedup_passages(odd, size, with_text=True, block_bytes=block_bytes).collect()
    want = brute(odd_rows, size)
    assert sorted((tuple(r) for r in got), key=repr) == want
    assert sum(w[2] > 0 for w in want) > 5


def test_more_words_than_characters(odd, odd_rows, monkeypatch):
    monkeypatch.setattr(S, "_CODES", 7)
    got = S.dedup_passages(odd, 13, with_text=True).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(odd_rows, 13)


def test_no_rows(empty):
    assert S.dedup_passages(empty).collect() == []
