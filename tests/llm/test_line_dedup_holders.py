import random

import pytest

from tidemark.llm.line_dedup import dropped_lines, shared_lines

from .test_line_dedup import repeated


def dropped(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    texts = {r.version: r.text for r in docs.selectExpr("xxhash64(text) as version", "text").collect()}
    return {(r.doc_id, texts[r.version]): sorted(r.dropped) for r in dropped_lines(docs).collect()}


def brute(rows):
    return {unit: sorted(places) for unit, places in repeated(sorted(set(rows))).items() if places}


L, M = "a line that many documents hold", "another line that many documents hold"


def test_first_holder_that_is_not_aligned(spark):
    rows = [(1, f"x\n{L}\ny\n{L}\nz"), (2, f"q\n{L}\nr"), (3, f"s\n{L}\nt"), (4, f"u\n{L}\nv"), (4, f"u {M}\n{L}\nw")]
    assert dropped(spark, rows)[3, rows[2][1]] == [1]
    assert dropped(spark, rows) == brute(rows)


def test_lines_in_another_order(spark):
    rows = [(1, f"x\n{M}\n{L}\ny"), (2, f"q\n{L}\nr"), (3, f"s\n{L}\nt\n{M}\nu"), (4, f"v\n{M}\nw")]
    assert dropped(spark, rows)[3, rows[2][1]] == [1, 3]
    assert dropped(spark, rows) == brute(rows)


@pytest.mark.parametrize("seed", range(3))
def test_all_earlier_documents(spark, seed):
    # Six holders or more of each line, in changing order, often twice: more than are tried one after the other.
    rng = random.Random(seed)
    bank = [f"line {n} has five words " + "w " * (n % 3) for n in range(14)]
    rows = [(i, "\n".join(rng.choice([f"own line of document {i} {n}", *rng.choices(bank, k=3)]) for n in range(rng.randint(1, 9)))) for i in range(60)]
    rows += [(70 + i % 2, text) for i, (_, text) in enumerate(rng.choices(rows, k=8))]
    assert dropped(spark, rows) == brute(rows)


def test_blocks_of_short_lines(spark):
    verse = "roses are red\n\nviolets\n\nblue"
    rows = [(1, f"a\n{verse}\nb"), (2, f"c\n{verse}\nd"), (3, "roses are red\nblue"), (4, f"{L}\nviolets\n\nx"), (5, f"y\n{L}\nviolets\n\nz")]
    rows += [(6, "violets\n\nq")]
    assert dropped(spark, rows)[2, rows[1][1]] == [1, 2, 3, 4, 5]
    assert dropped(spark, rows) == brute(rows)


def test_short_lines_beside_a_line_first_held_elsewhere(spark):
    rows = [(1, f"x\n{L}\ny"), (5, f"q\n{L}\nshort\nr"), (9, f"s\n{L}\nshort\nt")]
    assert dropped(spark, rows)[9, rows[2][1]] == [1, 2]


@pytest.mark.parametrize("seed", range(2))
def test_short_lines_against_all_earlier_documents(spark, seed):
    rng = random.Random(seed)
    bank = ["", "", "one", "two words", "now three words", "and here are four", "five words are a line"]
    rows = [(i, "\n".join(rng.choice([*bank, f"own {i} {n}"]) for n in range(rng.randint(1, 14)))) for i in range(40)]
    assert dropped(spark, rows) == brute(rows)


def test_scripts_without_spaces(spark):
    rows = []
    for n, line in enumerate(["我们今天去公园散步看花", "きょうはとてもよいてんきです", "วันนี้อากาศดีมากเราไปเดินเล่นกัน"]):
        rows += [(10 * n, f"a{n}\n{line}\nb"), (10 * n + 1, f"c{n}\n{line}\nd")]
    rows += [(50, "x\n你好。\ny"), (51, "z\n你好。\nw"), (52, "x2\nสวัสดี\ny"), (53, "z2\nสวัสดี\nw")]
    assert {i: lines for (i, _), lines in dropped(spark, rows).items()} == {1: [1], 11: [1], 21: [1]}


def test_moved_and_repeated_runs():
    a, b = [1, 2, 3, 9, 4, 5, 2, 3], [4, 5, 0, 2, 3, 0, 1, 2, 3, 0, 2, 7]
    assert shared_lines(a, b, [5] * 8, [5] * 12, set(range(12)), 10) == [0, 1, 3, 4, 6, 7, 8]
    assert shared_lines([0, 1, 0], [0, 1, 0], [0, 3, 0], [0, 3, 0], {1}, 5) == []


def test_pairs_grow_with_the_documents(spark):
    # One line in all documents, first held where it is no anchor: each later document is aligned with the first one only.
    rows = [(0, f"x\n{L}\ny\n{L}\nz")] + [(i, f"own {i}\n{L}\nshort {i % 40}\nend {i}") for i in range(1, 300)]
    assert {lines for (_, _), lines in ((k, tuple(v)) for k, v in dropped(spark, rows).items())} <= {(1,), (1, 2)}
    assert dropped(spark, rows) == brute(rows)
