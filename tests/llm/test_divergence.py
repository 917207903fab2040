import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tidemark.llm import divergence
from tidemark.llm.divergence import radix_order, source_divergence, term_counts

TERMS = "a I it The über größe niño stone Stone x1y eightlet ninechars sixteen-letters sixteenlettersab seventeenlettersa 你好世界你好世界 don't naïveté".split()


def brute(rows, min_docs=10, top=10):
    counts, docs, groups = Counter(), Counter(), set()
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        found = Counter(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lowered))
        for term, n in found.items():
            counts[lang, source, term] += n
            docs[lang, term] += 1
    out = []
    for lang in {g[0] for g in groups}:
        sources = sorted(s for g, s in groups if g == lang)
        kept = [t for (g, t), n in docs.items() if g == lang and n >= min_docs]
        shares = {}
        for name in [*sources, None]:
            held = [sum(counts[lang, s, t] for s in (sources if name is None else [name])) for t in kept]
            shares[name] = [1 + 10**9 * (n + 2) // (sum(held) + 2 * len(kept)) for n in held]
        for s in sources:
            pairs = [(-sum((p - q) ** 2 // (p + q) for p, q in zip(shares[s], shares[o])), o.encode(), o) for o in sources if o != s]
            own = zip(kept, shares[s], shares[None])
            terms = [(-((p - q) ** 2 // (p + q)), t.encode(), t) for t, p, q in own if p > q and counts[lang, s, t]]
            for part, found in (("pair", pairs), ("term", sorted(terms)[:top])):
                out += [(lang, s, part, item, -v, rank) for rank, (v, _, item) in enumerate(sorted(found), 1)]
    return sorted(out)


def rows_of(seed, count, sources):
    rng = random.Random(seed)
    rows = [(rng.choice(["en", "de", None]), rng.choice(sources), " ".join(rng.choices(TERMS, k=rng.randint(0, 40)))) for _ in range(count)]
    rows += [("fr", "only", "rare words"), ("fr", "other", None), ("it", "alone", "x"), ("de", "silent", ""), (None, None, None)]
    return rows + [rows[0]] * 12 + [("en", "hot", "The\0stone[Über]GRÖSSE " * 500)]


def frame(spark, rows):
    wide = [(t, s, g, 1, "x", 2.0, None) for g, s, t in rows]
    return spark.createDataFrame(wide, "text string, source string, lang string, n int, term string, value double, part string").repartition(5)


@pytest.mark.parametrize("sources, min_docs", [(["a", "b", "", None, "ä"], 10), ([f"s{i}" for i in range(140)], 2)])
def test_against_brute_force(spark, sources, min_docs):
    rows = rows_of(1, 300, sources)
    got = sorted(tuple(r) for r in source_divergence(frame(spark, rows), min_docs, 4).collect())
    assert got == brute(rows, min_docs, 4)


def test_small_shards_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(divergence, "SHARD_TERMS", 3)
    monkeypatch.setattr(divergence, "SOURCE_BLOCK", 2)
    rows = rows_of(2, 200, ["a", "b", "c", "d", "e"])
    got = sorted(tuple(r) for r in source_divergence(frame(spark, rows), 5).collect())
    assert got == brute(rows, 5)


@pytest.mark.parametrize("chunk", [1, 60, 1 << 20])
def test_counts_do_not_depend_on_chunks(spark, chunk):
    rows = [(g or "", s or "", t or "") for g, s, t in rows_of(3, 80, ["a", "b"])]
    want, docs = Counter(), defaultdict(int)
    for lang, source, text in rows:
        found = Counter(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text)))
        for term, n in found.items():
            want[lang, source, term] += n
            docs[lang, source, term] += 1
    got = term_counts(spark.createDataFrame(rows, "lang string, source string, text string").coalesce(2), chunk).collect()
    assert {(r.lang, r.source, r.term): (r.n, r.docs) for r in got} == {k: (n, docs[k]) for k, n in want.items()}


def test_radix_order_is_stable():
    rng = np.random.default_rng(0)
    high, low = (rng.integers(0, 4, 5000, np.uint64) << np.uint64(s) for s in (62, 15))
    assert (radix_order([high, low]) == np.lexsort([low, high])).all()


def test_no_rows(spark):
    assert source_divergence(frame(spark, rows_of(4, 1, ["a"])).limit(0)).collect() == []
