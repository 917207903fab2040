import random

import pytest

WORDS = "der die das is at of and the ein thing stone river über größe año niño 12 x1 don't end. stop, go!".split()


def text_of(rng, words, lines=False):
    return "".join(rng.choice(WORDS) + (rng.choice([" ", " ", " ", "  ", "\n", "\t"]) if lines else " ") for _ in range(words))


@pytest.fixture(scope="session")
def odd_rows():
    """Documents with null and empty texts, null and repeated ids, ties, repeated rows, copies and near copies."""
    rng = random.Random(5)
    rows = [(i, text_of(rng, rng.randint(0, 120), lines=True)) for i in range(40)]
    long = text_of(rng, 400)
    rows += [(50 + i, long) for i in range(4)]
    rows += [(60 + i, long.replace("stone", "rock", 1) + " tail" * (i == 2)) for i in range(3)]
    rows += [(70, None), (71, ""), (72, "  \n\t "), (73, None), (None, long), (None, None), (74, "one"), (75, "one two")]
    rows += [(80, "same row again and again"), (80, "same row again and again"), (80, "another text of that id")]
    rows += [(81, "Same  Row again\nand again"), (82, "samerowagainandagain"), (90, "very " * 3000 + "long"), (91, "very " * 3000)]
    return rows


@pytest.fixture
def odd(spark, odd_rows):
    """The same with columns whose names the operators use themselves."""
    wide = [(i, t, "x", 1.0, True, 7, "y", [1]) for i, t in odd_rows]
    shape = "doc_id long, text string, digest string, fingerprint double, kept boolean, block int, _text string, version array<int>"
    return spark.createDataFrame(wide, shape).repartition(5)


@pytest.fixture
def empty(odd):
    return odd.limit(0)


@pytest.fixture
def sf():
    return "/root/testdata/sf0.001"
