import itertools
import random
import re
from math import comb

import numpy as np
import pytest

from tidemark.llm.minhash import least_common, near_duplicates_by_sets, shingle_set


def shingles(text, size=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(words[i : i + size]) for i in range(max(len(words) - size, 0) + 1)) if words else frozenset()


def brute(rows, percent=85):
    sets = [shingles(t) for _, t in rows]
    distinct = [s for s in dict.fromkeys(sets) if s]
    root = {s: s for s in distinct}

    def find(s):
        while root[s] is not s:
            s = root[s]
        return s

    for a, b in itertools.combinations(distinct, 2):
        if 100 * len(a & b) >= percent * len(a | b):
            root[find(a)] = find(b)
    smallest = {}
    for (i, _), s in zip(rows, sets):
        if s and i is not None:
            smallest[find(s)] = min(i, smallest.get(find(s), i))
    out = []
    for (i, _), s in zip(rows, sets):
        group = smallest.get(find(s)) if s else i
        out.append((i, len(s), group, i == group))
    return sorted(out, key=repr)


def flat(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def edited(rng, words, share):
    return [rng.choice(["x", "y"]) + str(rng.randrange(10**9)) if rng.random() < share else w for w in words]


def groups_of_copies(seed, sizes):
    """Copies of texts with more and fewer edits, some around the threshold, that share a passage with all others."""
    rng = random.Random(seed)
    passage = [f"p{i}" for i in range(60)]
    rows = []
    for size, count in sizes:
        base = [f"w{rng.randrange(10**9)}" for _ in range(size)]
        for _ in range(count):
            words = edited(rng, base, rng.choice([0, 0.002, 0.01, 0.016, 0.02, 0.03]))
            if rng.random() < 0.3:
                words = passage + words
            rows.append(" ".join(words))
    rows += [" ".join(passage + [f"q{rng.randrange(10**9)}" for _ in range(rng.randint(5, 60))]) for _ in range(80)]
    rng.shuffle(rows)
    return list(enumerate(rows))


def test_documents(odd, odd_rows):
    assert flat(near_duplicates_by_sets(odd)) == brute(odd_rows)


@pytest.mark.parametrize("short_list", [0, 8, 64])
def test_copies_with_edits(spark, short_list):
    rows = groups_of_copies(1, [(4, 6), (9, 20), (40, 40), (70, 60), (150, 60), (400, 90)])
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    want = brute(rows)
    assert flat(near_duplicates_by_sets(docs, short_list=short_list)) == want
    assert 30 < sum(not kept for *_, kept in want) < len(rows) - 30


def test_sizes_at_the_threshold(spark):
    # Sets of n values of which the first d differ: linked if 100 (n - d) >= 85 (n + d).
    rows = []
    for n in (6, 7, 13, 20, 37, 63, 64, 65, 100):
        for d in range(n // 5 + 1):
            rows.append((len(rows), " ".join([f"{n}-{d}-{i}" for i in range(d)] + [f"{n}-{i}" for i in range(d, n + 4)])))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert flat(near_duplicates_by_sets(docs)) == brute(rows)


def test_a_long_list_of_different_texts_gives_few_pairs(spark):
    rng = random.Random(3)
    passage = " ".join(f"p{i}" for i in range(90))
    rows = [(i, passage + " " + " ".join(f"q{rng.randrange(10**9)}" for _ in range(60))) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    assert flat(near_duplicates_by_sets(docs, short_list=16)) == brute(rows)


def test_sets_are_distinct_shingles():
    for text in ("", " \n ", "one", "One two THREE", "a b a b a b a b a b a b", "ä Ä ß\x0bx y z z z z z"):
        assert len(shingle_set(text.encode())) == len(shingles(text))
    assert (shingle_set(b"A b c d e f") == shingle_set(b"a  B c\td e\nf")).all() and not np.array_equal(shingle_set(b"a b"), shingle_set(b"b a"))


def test_bound_of_the_sketch():
    bound = least_common(64, 85)
    chance = [comb(64, x) * 0.85**x * 0.15 ** (64 - x) for x in range(65)]
    assert sum(chance[:bound]) <= 1e-12 < sum(chance[: bound + 1])


def test_no_rows(empty):
    result = near_duplicates_by_sets(empty)
    assert result.collect() == [] and result.columns == ["doc_id", "n_shingles", "component_id", "kept"]
