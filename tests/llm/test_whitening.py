from collections import defaultdict

import numpy as np
import pytest

from tidemark.llm import queries
from tidemark.llm.whitening import Spectrum, secular_roots, whiten

SHAPE = "vec_id long, embedding array<float>, vector string, n string, component int"


def frame(spark, rows, parts=5):
    return spark.createDataFrame([(i, v, "x", "y", 1) for i, v in rows], SHAPE).repartition(parts)


def brute(vectors):
    """Whole numbers, deviations, and rising eigenvalues with their vectors, in exact sums and double precision."""
    x = np.floor(64 * np.array(vectors, np.float32).astype(float)).astype(np.int64) + 1_000_000
    n, sums = len(x), x.sum(axis=0)
    apart = n * x - sums
    centred = apart / n
    values, basis = np.linalg.eigh(centred.T @ centred / n)
    return n, (apart.astype(object) ** 2).sum(axis=1), centred, values, basis


def check(result, rows, components=32, error=1e-9):
    held = [(i, v) for i, v in rows if v is not None]
    n, deviations, centred, values, basis = brute([v for _, v in held])
    size = min(components, len(values))
    top = [len(values) - 1 - k for k in range(size)]
    found = defaultdict(list)
    for r in result.collect():
        found[r.component].append(r)
    assert sorted(found) == list(range(1, size + 1))
    errors = {r.identity_error for part in found.values() for r in part}
    assert len(errors) == 1 and next(iter(errors)) <= 1e-4
    for k, at in enumerate(top, 1):
        got = sorted(((r.vec_id, r.deviation, r.whitened) for r in found[k]), key=repr)
        assert {r.n for r in found[k]} == {n}
        assert all(abs(r.explained - values[at] / values.sum()) <= 1e-9 for r in found[k])
        alone = all(abs(values[at] - values[o]) > 1e-6 * values[-1] for o in range(len(values)) if o != at)
        for sign in (1, -1):
            white = sign * (centred @ basis[:, at]) / np.sqrt(values[at])
            want = sorted(zip([i for i, _ in held], deviations, white), key=repr)
            pairs = zip(sorted(got, key=lambda r: (repr(r[:2]), r[2])), sorted(want, key=lambda r: (repr((r[0], int(r[1]))), r[2])))
            if all(a[0] == b[0] and a[1] == b[1] and abs(a[2] - b[2]) <= error * max(1, abs(b[2])) for a, b in pairs):
                break
        else:
            assert not alone, k


def test_against_a_whole_decomposition(spark):
    rng = np.random.default_rng(1)
    mix = rng.normal(size=(40, 40)) * 10.0 ** rng.uniform(-1, 1, 40)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(300, 40)) @ mix)]
    rows += [(None, rows[3][1]), (7, rows[9][1]), (8, rows[8][1])] + [(400 + i, rows[0][1]) for i in range(200)]
    bad = [(901, None), (902, [None] + [1.0] * 39), (903, [float("nan")] + [1.0] * 39), (904, [float("-inf")] * 40), (905, []), (906, [1.0] * 39)]
    check(whiten(frame(spark, rows + bad)), rows)


def test_fewer_dimensions_and_partitions_of_one_row(spark):
    rows = [(i, [float(i % 7), float(i * i % 11), i / 3]) for i in range(30)]
    check(whiten(frame(spark, rows, 40)), rows)


def test_test_data(spark, sf):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    check(queries.op12_whitening(spark, sf), rows, error=1e-7)


def test_components_without_variance(spark):
    rows = [(i, [1.0, float(i), float(2 * i)]) for i in range(5)]
    got = whiten(frame(spark, rows)).collect()
    assert all((r.whitened is None) == (r.component > 1) and (r.explained == 0) == (r.component > 1) for r in got) and len(got) == 15
    alone = whiten(frame(spark, [(1, [2.0, 3.0])])).collect()
    assert [(r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in alone] == [(k, 1, 0, None, None, None) for k in (1, 2)]


def test_deviations_beyond_a_long_are_null(spark):
    rows = [(i, [float(1 << (35 if i else 3)), 1.0]) for i in range(3)]
    assert {r.deviation for r in whiten(frame(spark, rows)).collect()} == {None}


def test_no_rows(spark):
    columns = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    for rows in ([], [(1, None), (2, [])]):
        result = whiten(frame(spark, rows))
        assert result.collect() == [] and result.columns == columns


@pytest.mark.parametrize("squares", [[1e-30, 1.0, 1e-12], [1.0, 1e-25, 1.0], [3.0, 2.0, 1.0]])
def test_roots_lie_between_poles(squares):
    poles, squares = np.array([0.0, 1e-8, 5.0]), np.array(squares)
    roots = poles - np.diagonal(secular_roots(poles, squares))
    whole = np.linalg.eigvalsh(np.diag(poles) + np.outer(np.sqrt(squares), np.sqrt(squares)))
    assert np.allclose(roots, whole, rtol=1e-12, atol=1e-14)


@pytest.mark.parametrize("scales", [[1.0] * 20, [10.0 ** (k % 7 - 3) for k in range(20)], [1.0] * 12 + [0.0] * 8])
def test_updates_and_merges_keep_the_scatter(scales):
    rows = (np.random.default_rng(2).normal(size=(90, 20)) * 1e4 * scales).astype(np.int64)
    parts = [Spectrum.empty(20) for _ in range(3)]
    for at, row in enumerate(rows):
        parts[at % 3].add_row(row, 1 + at % 2)
    whole = Spectrum.of([part.pack() for part in parts])
    weights = 1 + np.arange(90) % 2
    mean = weights @ rows / weights.sum()
    scatter = ((rows - mean).T * weights) @ (rows - mean)
    assert np.abs(whole.vectors * whole.values @ whole.vectors.T - scatter).max() <= 1e-12 * whole.values[-1]
    assert np.abs(whole.vectors.T @ whole.vectors - np.eye(20)).max() <= 1e-12
    assert whole.count == weights.sum() and (whole.sums == weights @ rows).all()
