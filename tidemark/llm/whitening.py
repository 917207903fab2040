"""Whitening of embeddings by an incremental eigendecomposition."""

from __future__ import annotations

import io
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


COMPONENTS = 32
STEP, SHIFT = 64, 1_000_000
#: Entries beyond this make a vector count as not finite, so that sums of whole numbers stay exact.
LARGEST = float(1 << 36)
_EPS = np.finfo(float).eps
_ROUNDS = 100


def secular_roots(poles: np.ndarray, squares: np.ndarray) -> np.ndarray:
    """Differences pole - root, a column for each root of 1 + sum(squares / (poles - x)), accurate near the poles.

    ``poles`` rise strictly and ``squares`` are positive, so there is one root after each pole. All roots are sought at
    once: the poles on either side of a root are each replaced by one pole with the same value and slope, which leaves a
    quadratic equation; steps that leave the bracket of a root halve it instead.
    """
    count = len(poles)
    gaps = np.append(np.diff(poles), squares.sum())
    inner = np.arange(count) < count - 1
    middle = poles + gaps / 2
    right = inner & (1 + (squares[:, None] / (poles[:, None] - middle)).sum(axis=0) < 0)
    origin = np.arange(count) + right
    shifted = poles[:, None] - poles[origin]
    low = np.where(right, -gaps / 2, 0.0)
    high = np.where(right, 0.0, np.where(inner, gaps / 2, gaps))
    near = np.where(right, -gaps, 0.0)  # the pole on the left of the root, from the origin
    upper = np.tri(count, dtype=bool).T  # poles up to the root's own
    left_squares, right_squares = np.where(upper, squares[:, None], 0.0), np.where(upper, 0.0, squares[:, None])
    x = (low + high) / 2
    with np.errstate(all="ignore"):
        for _ in range(_ROUNDS):
            apart = shifted - x
            left, after = left_squares / apart, right_squares / apart
            psi, phi = left.sum(axis=0), after.sum(axis=0)
            value = 1 + psi + phi
            low, high = np.where(value < 0, x, low), np.where(value < 0, high, x)
            done = np.abs(value) <= 4 * _EPS * count * (1 - psi + phi)
            if done.all():
                break
            a, b = near - x, near + gaps - x
            left_slope, right_slope = (left / apart).sum(axis=0), (after / apart).sum(axis=0)
            s, t = a * a * left_slope, b * b * right_slope
            c = 1 + psi - a * left_slope + np.where(inner, phi - b * right_slope, 0.0)
            p = np.where(inner, c * (a + b) + s + t, 0.0)
            root = np.sqrt(np.maximum(p * p - 4 * c * a * b * value, 0))
            step = np.where(p <= 0, (p - root) / (2 * c), 2 * a * b * value / (p + root))
            step = np.where(inner, step, a + s / c)
            after_step = x + step
            inside = (after_step > low) & (after_step < high)
            after_step = np.where(inside, after_step, (low + high) / 2)
            if (done | (after_step == x)).all():
                break
            x = np.where(done, x, after_step)
    return shifted - x


@dataclass
class Spectrum:
    """Scatter of rows around their mean as eigenvalues (rising) and eigenvectors, with the exact count and sums."""

    count: int
    sums: np.ndarray
    values: np.ndarray
    vectors: np.ndarray

    @classmethod
    def empty(cls, size: int) -> Spectrum:
        return cls(0, np.zeros(size, np.int64), np.zeros(size), np.eye(size))

    def add_row(self, row: np.ndarray, times: int) -> None:
        """Take in a row of whole numbers, ``times`` over."""
        if self.count:
            apart = (self.count * row - self.sums) / self.count
            self.update(apart, self.count * times / (self.count + times))
        self.count += times
        self.sums = self.sums + times * row

    def add(self, other: Spectrum) -> None:
        """Take in the rows of another spectrum: one update for each of its eigenpairs, and one for the means."""
        for value, vector in zip(other.values, other.vectors.T):
            if value > 0:
                self.update(vector, value)
        if self.count and other.count:
            apart = self.sums / self.count - other.sums / other.count
            self.update(apart, self.count * other.count / (self.count + other.count))
        self.count += other.count
        self.sums = self.sums + other.sums

    def update(self, vector: np.ndarray, weight: float) -> None:
        """The eigendecomposition of the scatter plus ``weight`` times the outer product of ``vector`` with itself.

        Directions that the vector hardly touches keep their eigenpairs, and of equal eigenvalues a reflection leaves only
        one direction that it touches (deflation). The others move to the roots of the secular equation. Their vectors
        come from the touch that these roots would be exact for, which keeps them orthogonal.
        """
        touch = np.sqrt(weight) * (vector @ self.vectors)
        total = touch @ touch
        if not total > 0:
            return
        scale = 8 * _EPS * max(self.values[-1], total)
        touch[np.abs(touch) * np.sqrt(total) <= scale] = 0.0
        moved = np.flatnonzero(touch)
        if len(moved) > 1:
            breaks = np.flatnonzero(np.diff(self.values[moved]) > scale / len(moved)) + 1
            if len(breaks) + 1 < len(moved):
                for same in np.split(moved, breaks):
                    if len(same) > 1:
                        self._reflect(same, touch)
                moved = np.flatnonzero(touch)
        poles, held = self.values[moved], touch[moved]
        if len(moved) == 1:
            self.values[moved] = poles + held * held
        elif len(moved):
            apart = secular_roots(poles, held * held)
            ratio = -apart
            ratio[:, :-1] /= np.where(np.tri(len(poles), len(poles) - 1, -1, dtype=bool), poles[:-1] - poles[:, None], poles[1:] - poles[:, None])
            exact = np.copysign(np.sqrt(np.abs(ratio.prod(axis=1))), held)
            turned = exact[:, None] / apart
            turned /= np.sqrt((turned * turned).sum(axis=0))
            self.values[moved] = poles - np.diagonal(apart)
            self.vectors[:, moved] = self.vectors[:, moved] @ turned
        order = np.argsort(self.values, kind="stable")
        self.values, self.vectors = self.values[order], self.vectors[:, order]

    def _reflect(self, same: np.ndarray, touch: np.ndarray) -> None:
        normal = touch[same]
        length = np.sqrt(normal @ normal)
        end = -np.copysign(length, normal[-1])
        normal[-1] -= end
        held = self.vectors[:, same]
        self.vectors[:, same] = held - np.outer(held @ normal, normal * (2 / (normal @ normal)))
        touch[same] = 0.0
        touch[same[-1]] = end

    def pack(self) -> dict[str, np.ndarray]:
        return {"count": np.array(self.count), "sums": self.sums, "values": self.values, "vectors": self.vectors}

    @classmethod
    def of(cls, parts: list[dict[str, np.ndarray]]) -> Spectrum:
        spectra = [cls(int(part["count"]), part["sums"], part["values"], part["vectors"]) for part in parts]
        first = spectra[0]
        for other in spectra[1:]:
            first.add(other)
        return first


def _packed(arrays: dict[str, np.ndarray]) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def _unpacked(data: bytes) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(data)) as found:
        return dict(found)


def _spectra(parts: list[dict[str, np.ndarray]]) -> dict[str, np.ndarray]:
    return Spectrum.of(parts).pack()


def _added(parts: list[dict[str, np.ndarray]]) -> dict[str, np.ndarray]:
    return {name: sum(part[name] for part in parts) for name in parts[0]}


def _gathered(
    rows: DataFrame,
    of_rows: Callable[[Iterator[np.ndarray]], dict[str, np.ndarray] | None],
    merge: Callable[[list[dict[str, np.ndarray]]], dict[str, np.ndarray]],
    size: int,
) -> dict[str, np.ndarray]:
    """What ``of_rows`` makes of each partition, merged in groups and then over the groups. One value reaches the driver.

    The number of groups is about the root of the number of partitions, so that no task merges more than that.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = of_rows(_numbers(batch, size) for batch in batches if batch.num_rows)
        if found is not None:
            yield pa.RecordBatch.from_arrays([pa.array([_packed(found)], pa.binary())], ["state"])

    def combine(frame: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"state": [_packed(merge([_unpacked(data) for data in frame["state"]]))]})

    parts = rows.select("vector").mapInArrow(run, "state binary")
    groups = max(1, round(rows.rdd.getNumPartitions() ** 0.5))
    parts = parts.withColumn("part", F.pmod(F.spark_partition_id(), F.lit(groups)))
    parts = parts.groupBy("part").applyInPandas(combine, "state binary")
    whole = parts.withColumn("part", F.lit(0)).groupBy("part").applyInPandas(combine, "state binary").first()
    return _unpacked(bytes(whole["state"]))


def _numbers(batch: pa.RecordBatch, size: int) -> np.ndarray:
    """The whole numbers of a batch of vectors."""
    held = batch["vector"].flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
    return np.floor(STEP * held).astype(np.int64) + SHIFT


def whiten(embeddings: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The first ``components`` principal components of every vector, scaled to variance 1.

    Entries c count as whole numbers floor(64 c) + 1,000,000. First, each partition updates an eigendecomposition row by
    row, equal rows of a batch at once, and the partitions' spectra are merged. Then a Rayleigh-Ritz step makes it exact to
    double precision: rows are projected on the merged vectors, and the small matrix of their covariance, added up over
    all partitions, is solved. A third pass measures how far the whitened rows are from covariance 1.

    Vectors that are null, or hold null, not finite or larger entries than 2^36, are dropped; so are vectors of another
    length than the most frequent one (the largest of equally frequent ones). Null ids, repeated ids and repeated rows are
    handed through. Components of no variance have null in ``whitened`` and 0 in ``explained`` (null where no component
    has any). A ``deviation`` that no long holds is null. Other columns are not read.

    Columns: vec_id, component (from 1), n, deviation, whitened, explained, identity_error.
    """
    entry = F.col(vector_col).cast("array<double>")
    # Comparisons with NaN: it is larger than all numbers.
    bad = F.exists(entry, lambda x: x.isNull() | (F.abs(x) > LARGEST))
    rows = embeddings.select(F.col(id_col).alias("vec_id"), entry.alias("vector")).where(F.col("vector").isNotNull() & ~bad & (F.size("vector") > 0))
    sizes = rows.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    shape = f"vec_id {rows.schema['vec_id'].dataType.simpleString()}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if sizes is None:
        return embeddings.sparkSession.createDataFrame([], shape)
    size = sizes["size"]
    rows = rows.where(F.size("vector") == size)

    def spectrum(blocks: Iterator[np.ndarray]) -> dict[str, np.ndarray] | None:
        found = Spectrum.empty(size)
        for block in blocks:
            for row, times in zip(*np.unique(block, axis=0, return_counts=True)):
                found.add_row(row, int(times))
        return found.pack() if found.count else None

    first = _gathered(rows, spectrum, _spectra, size)
    n, sums, basis = int(first["count"]), first["sums"], first["vectors"]

    def centred(block: np.ndarray) -> np.ndarray:
        return (n * block - sums) / n

    def ritz(blocks: Iterator[np.ndarray]) -> dict[str, np.ndarray] | None:
        total = np.zeros((size, size))
        for block in blocks:
            projected = centred(block) @ basis
            total += projected.T @ projected
        return {"total": total}

    covariance = _gathered(rows, ritz, _added, size)["total"] / n
    values, turned = np.linalg.eigh((covariance + covariance.T) / 2)
    values, turned = values[::-1][:components], turned[:, ::-1][:, :components]
    trace = float(np.trace(covariance))
    kept = values > 4 * size * _EPS * max(values[0], 0.0)
    scaled = (basis @ turned) / np.sqrt(np.where(kept, values, 1.0))

    def moments(blocks: Iterator[np.ndarray]) -> dict[str, np.ndarray] | None:
        sums, total = np.zeros(len(values)), np.zeros((len(values), len(values)))
        for block in blocks:
            white = centred(block) @ scaled
            sums, total = sums + white.sum(axis=0), total + white.T @ white
        return {"sums": sums, "total": total}

    found = _gathered(rows, moments, _added, size)
    whitened = found["total"] / n - np.outer(found["sums"], found["sums"]) / n**2
    off = np.abs(whitened - np.eye(len(values)))[np.ix_(kept, kept)]
    error = float(off.max()) if off.size else None
    explained = pa.array([float(v / trace) if k else 0.0 for v, k in zip(values, kept)] if trace > 0 else [None] * len(values), pa.float64())

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            block = _numbers(batch, size)
            count, many = len(block), len(values)
            white = (centred(block) @ scaled).ravel()
            again = np.repeat(np.arange(count), many)
            columns = [
                batch["vec_id"].take(pa.array(again)),
                pa.array(np.tile(np.arange(1, many + 1, dtype=np.int32), count)),
                pa.array(np.full(count * many, n)),
                pa.array(_deviations(block, n, sums), pa.int64()).take(pa.array(again)),
                pa.array(white, mask=np.tile(~kept, count)),
                explained.take(pa.array(np.tile(np.arange(many), count))),
                pa.array([error], pa.float64()).take(pa.array(np.zeros(count * many, np.int64))),
            ]
            yield pa.RecordBatch.from_arrays(columns, names)

    names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    return rows.mapInArrow(report, shape)


def _deviations(block: np.ndarray, n: int, sums: np.ndarray) -> list[int | None] | np.ndarray:
    """Squared distances of n times each row from the sums, in whole numbers of any size."""
    apart = n * block - sums
    if float(np.abs(apart).max()) ** 2 * apart.shape[1] < 2.0**62:
        return (apart * apart).sum(axis=1)
    exact = [sum(int(x) ** 2 for x in row) for row in apart]
    return [x if x < 1 << 63 else None for x in exact]
