import hashlib
import random
from collections import defaultdict

from tidemark.llm.line_dedup import common_blocks, dedup_lines, line_dedup_report, patience


def aligned_well(a, b):
    pairs = patience(a, b)
    assert all(a[i] == b[j] for i, j in pairs)
    assert all(i < k and j < m for (i, j), (k, m) in zip(pairs, pairs[1:]))
    return pairs


def test_patience():
    assert aligned_well("abcdef", "xabcyef") == [(0, 1), (1, 2), (2, 3), (4, 5), (5, 6)]
    assert aligned_well("", "a") == [] and aligned_well("abc", "abc") == [(0, 0), (1, 1), (2, 2)]
    rng = random.Random(0)
    for _ in range(300):
        a, b = ([rng.randrange(8) for _ in range(rng.randrange(15))] for _ in range(2))
        aligned_well(a, b)
        # Lines that occur once on either side and keep their order are all aligned.
        c = rng.sample(range(100), 20)
        d = [x for x in c if rng.random() < 0.5]
        assert [j for _, j in aligned_well(c, d)] == list(range(len(d)))


def test_blocks_need_words():
    assert common_blocks([1, 2, 9, 3], [1, 2, 8, 3], [2, 3, 9, 4]) == [0, 1]


def repeated(texts, least=5):
    """Of each (id, text): places of lines in runs of ``least`` words or more that a text with a smaller id holds as well."""
    count = lambda line: len(line.encode().split())
    lines = {unit: unit[1].split("\n") for unit in texts}
    places = defaultdict(list)
    for unit, held in lines.items():
        for at, line in enumerate(held):
            places[line].append((unit, at))
    gone = {unit: set() for unit in texts}
    for unit, held in lines.items():
        for start, line in enumerate(held):
            for other, at in places[line]:
                theirs = lines[other]
                if other[0] >= unit[0] or start and at and held[start - 1] == theirs[at - 1]:
                    continue
                # The longest run that begins here and there.
                size = next((n for n, (x, y) in enumerate(zip(held[start:], theirs[at:])) if x != y), min(len(held) - start, len(theirs) - at))
                if sum(map(count, held[start : start + size])) >= least:
                    gone[unit].update(range(start, start + size))
    return gone


def brute(rows, least=5):
    gone = repeated(sorted({(i, t or "") for i, t in rows if i is not None}), least)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for n, x in enumerate(lines) if i is None or n not in gone[i, t or ""]]
        cut = len(lines) - len(kept)
        out.append((i, len(lines), cut, "\n".join(kept) if cut else t))
    return out


def test_documents(spark, odd_rows):
    rng = random.Random(4)
    bank = [" ".join(f"w{rng.randrange(50)}" for _ in range(rng.randint(1, 12))) for _ in range(60)] + ["", "x"]
    rows = [(i, t) for i, t in odd_rows if i != 80]
    rows += [(100 + i, "\n".join(rng.choices(bank, k=rng.randint(0, 12)))) for i in range(60)]
    block = "\n".join(bank[5:15])
    rows += [(200 + i, f"own line number {i} that nobody else has\n{block}\nend {i}") for i in range(30)]
    rows += [(230, rows[-1][1]), (230, rows[-1][1]), (None, block), (231, block)]
    docs = spark.createDataFrame([(7, i, t, i and i % 3) for i, t in rows], "n_chars long, doc_id long, text string, lines long").repartition(4)
    want = brute(rows)
    got = sorted(((r.doc_id, r.n_lines, r.n_removed, r.kept_sha256) for r in line_dedup_report(docs).collect()), key=repr)
    assert got == sorted(((i, n, c, hashlib.sha256((t or "").encode()).hexdigest()) for i, n, c, t in want), key=repr)
    assert sum(c for _, _, c, _ in want) > 300
    cut = dedup_lines(docs)
    assert cut.columns == docs.columns and cut.schema["n_chars"].dataType == docs.schema["n_chars"].dataType
    texts = sorted(((r.doc_id, r.text, r.n_chars, r.lines) for r in cut.collect()), key=repr)
    assert texts == sorted(((i, t, len(t) if c else 7, i and i % 3) for i, _, c, t in want), key=repr)


def test_odd_columns(odd, empty):
    assert dedup_lines(odd).columns == odd.columns and dedup_lines(odd).count() == odd.count()
    assert dedup_lines(empty).collect() == [] and line_dedup_report(empty).collect() == []
