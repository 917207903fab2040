import random
import time
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import decontamination as D
from tidemark.llm.words import plain_words


def brute(rows, items):
    found = []
    for number, (i, text) in enumerate(rows):
        words = plain_words((text or "").encode())
        for item_id, item in items:
            target = plain_words((item or "").encode())
            if not target or not words:
                continue
            size = min(5, len(target))
            want = Counter(tuple(target[k : k + size]) for k in range(len(target) - size + 1))
            best, windows = None, 0
            for start in range(max(0, len(words) - len(target)) + 1):
                part = words[start : start + len(target)]
                have = Counter(tuple(part[k : k + size]) for k in range(len(part) - size + 1))
                value = sum((want & have).values()) / max(1, sum((want | have).values()))
                if value >= 0.8:
                    windows += 1
                    if best is None or value > best[0]:
                        best = (value, start, len(part))
            if best:
                found.append((i, item_id, best[1], best[2], round(best[0], 9), windows))
    return sorted(found, key=repr)


def flat(df):
    return sorted(((r.doc_id, r.item_id, r.start, r.n_words, round(r.similarity, 9), r.n_windows) for r in df.collect()), key=repr)


@pytest.fixture
def items(spark, odd_rows):
    rng = random.Random(8)
    out = []
    for i in range(12):
        _, text = odd_rows[rng.randrange(40)]
        words = [w.decode() for w in plain_words(text.encode())]
        start, length = rng.randrange(max(1, len(words))), rng.choice([3, 4, 5, 6, 20, 40])
        passage = words[start : start + length]
        if len(passage) > 25:
            passage[12] = "changed"
        out.append((i, " ".join(passage).upper() + "!"))
    return [*out, (500, None), (501, "?!"), (502, "very " * 30), (503, odd_rows[40][1]), (503, odd_rows[40][1]), (None, "one two")]


def test_leaks(spark, odd, odd_rows, items):
    benchmark = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, doc_id int")
    got = flat(D.find_leaks(odd, benchmark))
    assert got == brute(odd_rows, items) and len(got) > 20


def test_passes_over_a_large_benchmark_give_the_same(spark, odd, items, monkeypatch):
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    whole = flat(D.find_leaks(odd, benchmark))
    monkeypatch.setattr(D, "PASS_BYTES", 300)
    assert flat(D.find_leaks(odd, benchmark)) == whole


def test_blocks_find_all_within_the_radius():
    rng = np.random.default_rng(0)
    index = D.Index([(i, b" ".join(b"%d" % v for v in rng.integers(0, 10**6, 12))) for i in range(50)])
    group = index.lengths[5, 12]
    every = np.arange(50)
    flips = [np.bitwise_or.reduce(np.uint64(1) << rng.choice(64, n, replace=False).astype(np.uint64)) for n in rng.integers(1, D.RADIUS + 1, 2000)]
    place = rng.integers(0, 50, 2000)
    found = {tuple(p) for p in group.close(group.prints[place] ^ np.array(flips, np.uint64), every).tolist()}
    assert all((i, p) in found for i, p in enumerate(place.tolist()))


def test_rows_that_hold_an_item_go(spark, odd, odd_rows, items):
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    left = D.without(odd, D.find_leaks(odd, benchmark))
    assert left.columns == odd.columns
    bad = {(i, number) for number, (i, t) in enumerate(odd_rows) if brute([(i, t)], items)}
    want = sorted(((i, t) for number, (i, t) in enumerate(odd_rows) if (i, number) not in bad), key=repr)
    assert sorted(((r.doc_id, r.text) for r in left.collect()), key=repr) == want


def test_no_rows(spark, odd, empty):
    none = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "one two")], "item_id long, text string")
    assert D.find_leaks(odd, none).collect() == [] and D.find_leaks(empty, some).collect() == []
    assert D.without(odd, D.find_leaks(odd, none)).count() == odd.count()


def test_many_items_that_are_partly_shared():
    rng = random.Random(4)
    items = [(i, [f"w{rng.randrange(10**7)}" for _ in range(12)]) for i in range(10_000)]
    index = D.Index([(i, " ".join(words).encode()) for i, words in items])
    texts = []
    for _ in range(5):
        words = []
        for i, item in rng.sample(items, 600):
            start = rng.randrange(7)
            words += item[start : start + 5]
        at = rng.randrange(len(words))
        whole = rng.choice(items)[1]
        texts.append((words[:at] + whole + words[at:], whole))
    began = time.perf_counter()
    found = list(index.search([" ".join(words).encode() for words, _ in texts]))
    assert time.perf_counter() - began < 0.1 * len(texts) * 5  # a tenth of a second each, on a machine five times as slow
    assert [(n, items[index.ids[i]][1], value) for n, i, _, _, value, _ in found] == [(n, whole, 1.0) for n, (_, whole) in enumerate(texts)]
