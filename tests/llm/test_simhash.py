import itertools
import random
import re

import pytest
import xxhash

from tidemark.llm.components import components
from tidemark.llm.simhash import close_pairs, drop_near_duplicates, near_duplicates


def brute_print(text, size=3):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    shingles = [words] if len(words) < size else [words[i : i + size] for i in range(len(words) - size + 1)]
    hashes = [xxhash.xxh64_intdigest(" ".join(s).encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(nodes, linked):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in itertools.combinations(nodes, 2):
        if linked(a, b):
            root[max(find(a), find(b))] = min(find(a), find(b))
    return {n: find(n) for n in nodes}


def test_documents(odd, odd_rows):
    prints = [(i, brute_print(t)) for i, t in odd_rows]
    groups = brute_groups(sorted({p for _, p in prints}), lambda a, b: (a ^ b).bit_count() <= 2)
    smallest = {}
    for i, p in prints:
        if i is not None:
            smallest[groups[p]] = min(i, smallest.get(groups[p], i))
    expected = sorted(((i, f"{p:016x}", smallest.get(groups[p])) for i, p in prints), key=repr)
    got = sorted((tuple(r) for r in near_duplicates(odd).collect()), key=repr)
    assert got == expected
    assert any(i is not None and smallest[groups[p]] != i for i, p in prints)


@pytest.mark.parametrize("distance", [0, 2])
def test_chains_of_close_prints_connect(spark, distance):
    rng = random.Random(1)
    prints = {0, 1, 3, (1 << 64) - 1, (1 << 64) - 1 ^ (1 << 63)}
    for _ in range(30):
        value = rng.getrandbits(64)
        for _ in range(rng.randint(1, 30)):
            prints.add(value)
            for _ in range(rng.randint(0, 4)):
                value ^= 1 << rng.randrange(64)
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    links = close_pairs(spark.createDataFrame(signed, "fingerprint long"), distance)
    found = {(a, b) for a, b in links.collect()}
    nodes = [s for (s,) in signed]
    want = brute_groups(nodes, lambda a, b: ((a ^ b) % (1 << 64)).bit_count() <= distance)
    got = brute_groups(nodes, lambda a, b: (a, b) in found or (b, a) in found)
    assert got == want


def test_a_dense_group_gives_few_links(spark):
    # All values that differ in at most two of 40 bits: 821 values, over 300,000 pairs.
    values = {0} | {1 << a | 1 << b for a in range(40) for b in range(40)}
    links = close_pairs(spark.createDataFrame([(v,) for v in values], "fingerprint long"))
    assert links.count() < 65 * len(values)
    roots = components(links)
    assert {r.root for r in roots.collect()} == {0} and roots.count() == len(values)


def test_odd_distances_are_refused(spark):
    with pytest.raises(ValueError):
        close_pairs(spark.createDataFrame([(1,)], "fingerprint long"), 3)


def test_components(spark):
    rng = random.Random(2)
    order = rng.sample(range(1000), 200)
    pairs = list(zip(order, order[1:])) + [(2000, 2001), (2001, 2000), (3000, 3000), (None, 4000)] + [(5000, 5000 + i) for i in range(300)]
    rng.shuffle(pairs)
    got = {r.node: r.root for r in components(spark.createDataFrame(pairs, "a long, b long").repartition(4)).collect()}
    want = {n: min(order) for n in order} | {2000: 2000, 2001: 2000} | {5000 + i: 5000 for i in range(300)}
    assert got == want


def test_no_rows(empty):
    assert near_duplicates(empty).collect() == []


def test_one_row_of_each_group_stays(spark, odd, odd_rows):
    a, b, c = "a long text of many words", "something else, quite other", "and a third one that differs"
    rows = [(1, a), (5, a), (5, b), (None, a), (7, c), (7, c), (None, None), (None, "")]
    docs = spark.createDataFrame([(i, t, n) for n, (i, t) in enumerate(rows)], "doc_id long, text string, version int").repartition(3)
    kept = drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, r.text or "") for r in kept.collect()), key=repr) == sorted([(1, a), (5, b), (7, c), (None, "")], key=repr)
    prints = [(i, t, brute_print(t)) for i, t in odd_rows]
    groups = brute_groups(sorted({p for *_, p in prints}), lambda x, y: (x ^ y).bit_count() <= 2)
    least = {}
    for i, t, p in prints:
        least.setdefault(groups[p], []).append((i is None, i or 0))
    kept = sorted(((r.doc_id is None, r.doc_id or 0) for r in drop_near_duplicates(odd).collect()))
    assert kept == sorted(min(ids) for ids in least.values())
    assert drop_near_duplicates(odd.limit(0)).collect() == []
