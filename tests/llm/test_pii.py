import hashlib
import itertools
import random
import re

import numpy as np

from tidemark.llm import pii as P

PIECES = ["a", "b.c", "@", "x.org", ".", "-", "+", "1", "22", "333", "4444", " ", "  ", "(", ")", "255", "256", "\n", "é", "4111111111111111", "+1 555 123 4567", "10.0.0.1", "jo@mail.example.com"]


def plain(text):
    spans = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            spans.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m[0] if c in "0123456789"]
        total = sum(sum(divmod(d * (1 + k % 2), 10)) for k, d in enumerate(reversed(digits)))
        if 16 <= len(digits) <= 19 and total % 10 == 0:
            spans.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= sum(c in "0123456789" for c in m[0]) <= 15:
            spans.append(("phone", *m.span()))
    return spans


def test_patterns():
    rng = random.Random(0)
    for _ in range(5000):
        text = "".join(rng.choices(PIECES, k=rng.randint(0, 25)))
        assert P.base_spans(text) == plain(text), text


def test_long_runs_take_no_long_time():
    for text in ("1" * 200_000, "1." * 100_000, "a" * 200_000 + "@", "@" * 100_000, "+1" * 100_000, "1 " * 100_000):
        P.base_spans(text)


def test_leading_zeros():
    text = "0" * 6000 + "1.002.3.255 and 1.2.3.256"
    assert P.base_spans(text) == [("ip", 0, 6011)]


def test_messages_are_exact_on_a_tree():
    rng = np.random.default_rng(0)
    field = P.Field({f"f{i}": rng.normal(size=5) for i in range(4)}, rng.normal(size=(5, 5)), rng.normal(size=(5, 5)))
    field.chain, field.skip = field.chain + field.chain.T, field.skip + field.skip.T
    tokens = P.Tokens([0] * 4, [1] * 4, ["t"] * 4, [[f"f{i}"] for i in range(4)], [(0, 1), (2, 3)], [(1, 2)])
    exact = np.zeros((4, 5))
    for labels in itertools.product(range(5), repeat=4):
        weight = sum(field.weights[f"f{i}"][k] for i, k in enumerate(labels))
        weight += field.chain[labels[0], labels[1]] + field.chain[labels[2], labels[3]] + field.skip[labels[1], labels[2]]
        for i, k in enumerate(labels):
            exact[i, k] += np.exp(weight)
    exact /= exact.sum(axis=1, keepdims=True)
    assert np.allclose(field.marginals(tokens, rounds=60), exact, atol=1e-2)


def test_skip_links_carry_a_label_through_the_document():
    agree = np.full((5, 5), -2.0)
    np.fill_diagonal(agree, 2.0)
    sure, open_ = np.array([0, 0, 0, 0, 4.0]), np.array([0.3, 0, 0, 0, 0])
    field = P.Field({"sure": sure, "open": open_}, np.zeros((5, 5)), agree)
    tokens = P.Tokens([0, 9], [1, 10], ["t", "t"], [["sure"], ["open"]], [], [(0, 1)])
    assert field.marginals(tokens).argmax(axis=1).tolist() == [4, 4]
    tokens.skip = []
    assert field.marginals(tokens).argmax(axis=1).tolist() == [4, 0]


def test_repeated_tokens_have_one_link_each():
    tokens = P.tokens_of("555-1234 and " * 5000)
    assert len(tokens.form) == 5000 and len(tokens.skip) == 4999


def test_documents(spark, odd, odd_rows):
    rng = random.Random(1)
    rows = [*odd_rows, *((300 + i, "".join(rng.choices(PIECES, k=40))) for i in range(300))]
    rows += [(900, "Call +1 (013) 555-9871 now or (013) 555-9871 or 555-9871 later, +1 (013) 555-9871")]
    docs = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, n_ip int").repartition(3)
    got = {(r.doc_id, r.base_sha256): r for r in P.find_personal_data(docs).collect()}
    for i, text in rows:
        spans = sorted(plain(text or ""), key=lambda s: (P.KINDS.index(s[0]), s[1]))
        shown = [f"{k}:{a}:{b}" for k, a, b in spans]
        row = got[i, hashlib.sha256(",".join(shown).encode()).hexdigest()]
        assert [row[f"n_{k}"] for k in P.KINDS] == [sum(s[0] == k for s in spans) for k in P.KINDS]
        assert set(shown) <= set(row.spans.split(","))
    assert P.find_personal_data(odd).count() == odd.count()


def test_held_out_tokens(spark):
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()]
    field = P.train_field(texts[::2])
    right = total = 0
    for text in texts[1::2]:
        tokens = P.tokens_of(text)
        if tokens.form:
            labels = P.labels_of(tokens, P.base_spans(text))
            right += int((field.marginals(tokens).argmax(axis=1) == labels).sum())
            total += len(labels)
    assert total > 50 and right / total > 0.95


def test_no_rows(empty):
    assert P.find_personal_data(empty).collect() == []
