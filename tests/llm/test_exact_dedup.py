import hashlib
import re
from collections import defaultdict

from pyspark.sql import functions as F

from tidemark.llm.exact_dedup import exact_dedup


def brute(rows):
    groups = defaultdict(list)
    for number, (i, text) in enumerate(rows):
        bare = re.sub(r"[\x20\x09-\x0D]", "", text or "")
        groups[bare].append((-len(text or ""), i is None, i or 0, number, i))
    out = []
    for bare, members in groups.items():
        best = min(members)
        print_ = hashlib.sha256(bare.encode()).hexdigest()
        out += [(m[4], best[4], len(members), m[3] == best[3], print_) for m in members]
    return sorted(out, key=repr)


def flat(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_groups(odd, odd_rows):
    assert flat(exact_dedup(odd)) == brute(odd_rows)


def test_texts_whose_digests_collide_are_told_apart_by_their_bytes(odd, odd_rows):
    weak = exact_dedup(odd, digest=lambda text: F.unhex(F.substring(F.md5(text), 1, 2)))
    assert flat(weak) == brute(odd_rows)
    assert flat(exact_dedup(odd, digest=lambda text: F.lit(b"same"))) == brute(odd_rows)


def test_no_rows(empty):
    assert flat(exact_dedup(empty)) == []


def test_plan_has_no_python(odd):
    plan = exact_dedup(odd)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
