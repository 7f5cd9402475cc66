"""Whitening of embeddings: components of the covariance of the distinct vectors, each scaled to unit variance.

Entries are put on a grid of integers, so counts, sums and the covariance are exact before the one division. Only matrices
of the vectors' dimension reach the driver, whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.llm.common import discard, written
from paperloom.llm.spectrum import leading

#: Steps of the grid in one unit, and the step of zero.
STEPS, ZERO = 64, 1_000_000
COMPONENTS = 16
EXACT = pa.decimal128(38, 0)


@dataclass(frozen=True)
class Whitening:
    """What was fitted: number and sums of the distinct grid vectors, and the components with their eigenvalues."""

    n: int
    sums: tuple[int, ...]
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    identity_error: float | None

    @property
    def explained(self) -> np.ndarray:
        return self.eigenvalues / self.trace if self.trace else self.eigenvalues


def on_grid(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(_id, _x) of the rows with a whole vector: each entry c as floor(STEPS * c) + ZERO. Vectors that are null or hold
    null or non-finite entries are left out; an entry whose step is no long is an error."""
    vector = F.col(vector_col)
    whole = vector.isNotNull() & F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")))
    x = F.transform(vector, lambda c: F.floor(c.cast("double") * STEPS) + F.lit(ZERO).cast("long"))
    return vectors.where(whole).select(F.col(id_col).alias("_id"), x.alias("_x"))


def exact_product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a' b of integer matrices as Python integers: in doubles where these hold every sum, else in parts of 20 bits."""
    tops = [int(np.abs(m).max(initial=0)) for m in (a, b)]
    if tops[0] * tops[1] * len(a) < 1 << 53:
        return (a.astype(float).T @ b.astype(float)).astype(np.int64).astype(object)
    if tops[0] < tops[1]:
        return exact_product(b, a).T
    return (exact_product(a >> 20, b) << 20) + exact_product(a & ((1 << 20) - 1), b)


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def _centred(x: np.ndarray, centre: np.ndarray) -> np.ndarray:
    if int(np.abs(x).max(initial=0)) >= 1 << 61:
        raise ValueError("entries beyond 2^61 grid steps")
    return x - centre


def _sums(grid: DataFrame, size: int) -> tuple[int, list[int]]:
    """Number and exact sums of the vectors; tasks send one row for each dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(size, object)
        for batch in batches:
            x = _matrix(batch.column(0), size)
            n += len(x)
            total += exact_product(np.ones((len(x), 1), np.int64), _centred(x, np.int64(ZERO)))[0]
        yield pa.RecordBatch.from_arrays([pa.array(range(size), pa.int32()), pa.array(list(total), EXACT), pa.array([n] * size, pa.int64())], names=["i", "s", "n"])

    rows = grid.mapInArrow(run, "i int, s decimal(38,0), n long").groupBy("i").agg(F.sum("s").alias("s"), F.sum("n").alias("n")).collect()
    n = rows[0].n
    return n, [int(r.s) + n * ZERO for r in sorted(rows)]


def _scatter(grid: DataFrame, size: int, centre: np.ndarray) -> np.ndarray:
    """Exact sums of products of the entries less ``centre``: one row for each pair of dimensions and task."""
    upper = np.triu_indices(size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size), object)
        for batch in batches:
            y = _centred(_matrix(batch.column(0), size), centre)
            total += exact_product(y, y)
        yield pa.RecordBatch.from_arrays([*(pa.array(u, pa.int32()) for u in upper), pa.array(list(total[upper]), EXACT)], names=["i", "j", "s"])

    out = np.zeros((size, size), object)
    for i, j, s in grid.mapInArrow(run, "i int, j int, s decimal(38,0)").groupBy("i", "j").agg(F.sum("s")).collect():
        out[i, j] = out[j, i] = int(s)
    return out


def _projector(model: Whitening):
    """Function from grid vectors to (integers n x - sums, whitened values); the mean is taken off before any product."""
    n, k = model.n, len(model.eigenvalues)
    centre = np.array([round(Fraction(s, n)) for s in model.sums], np.int64)
    rest = [s - n * int(c) for s, c in zip(model.sums, centre, strict=True)]
    offset = np.array([r / n for r in rest])
    scaled = (model.components / np.sqrt(model.eigenvalues)[:, None]).T if k else np.zeros((len(centre), 0))

    def project(x: np.ndarray) -> tuple[list[int], np.ndarray]:
        y = _centred(x, centre)
        moved = y - offset
        if len(y) and float((moved**2).sum(1).max()) * n * n < 2.0**62:
            numerators = n * y - np.array(rest, np.int64)
            deviation = (numerators**2).sum(1).tolist()
        else:
            deviation = [sum((n * int(v) - r) ** 2 for v, r in zip(row, rest, strict=True)) for row in y.tolist()]
        return deviation, moved @ scaled

    return project


def _identity_error(grid: DataFrame, model: Whitening) -> float | None:
    """Largest entry of |covariance of the whitened fit list - identity|, from the whitened vectors themselves."""
    size, k = len(model.sums), len(model.eigenvalues)
    if not k:
        return None
    project = _projector(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k))
        for batch in batches:
            w = project(_matrix(batch.column(0), size))[1]
            total += np.vstack([w.T @ w, w.sum(0)])
        at = np.indices(total.shape).reshape(2, -1)
        yield pa.RecordBatch.from_arrays([*(pa.array(v, pa.int32()) for v in at), pa.array(total.ravel())], names=["i", "j", "s"])

    total = np.zeros((k + 1, k))
    for i, j, s in grid.mapInArrow(run, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s")).collect():
        total[i, j] = s / model.n
    return float(np.abs(total[:k] - np.outer(total[k], total[k]) - np.eye(k)).max())


def fit(vectors: DataFrame, most: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding") -> Whitening:
    """Fit to the distinct grid vectors. Rows that repeat count once; groups of copies shrink before the shuffle.

    Vectors of unlike lengths are an error. No vectors, or equal ones only, give no components; nor do directions whose
    variance is zero up to rounding. Ids and other columns are ignored. The driver gets size^2 numbers of the dimension.
    """
    grid = written(on_grid(vectors, id_col, vector_col).select("_x").distinct(), "grid")
    least, size = grid.agg(F.min(F.size("_x")), F.max(F.size("_x"))).first()
    if least != size:
        raise ValueError(f"vectors of {least} and of {size} entries")
    if not size:
        return Whitening(0 if size is None else 1, (), np.zeros((0, 0)), np.zeros(0), 0.0, None)
    n, sums = _sums(grid, size)
    centre = [round(Fraction(s, n)) for s in sums]
    rest = np.array([s - n * c for s, c in zip(sums, centre, strict=True)], object)
    exact = n * _scatter(grid, size, np.array(centre, np.int64)) - np.outer(rest, rest)
    covariance = np.array([[float(Fraction(int(v), n * n)) for v in row] for row in exact])
    values, components = leading(covariance, most)
    model = Whitening(n, tuple(sums), components, values, float(np.trace(covariance)), None)
    model = Whitening(model.n, model.sums, components, values, model.trace, _identity_error(grid, model))
    discard(grid)
    return model


def transform(vectors: DataFrame, model: Whitening, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """id, deviation (decimal, exact: sum over dimensions of (n x - sum)^2) and whitened (array, one entry a component).

    One row for each row with a whole vector, repeats included; null ids stay, other columns are ignored.
    """
    size = len(model.sums)
    grid = on_grid(vectors, id_col, vector_col)
    project = _projector(model) if size else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.num_rows
            lengths = pa.compute.list_value_length(batch.column(1)).to_numpy(zero_copy_only=False)
            if (lengths != size).any():
                raise ValueError(f"vectors of other than {size} entries")
            deviation, w = project(_matrix(batch.column(1), size)) if size else ([0] * rows, np.zeros((rows, 0)))
            ends = pa.array(np.arange(rows + 1, dtype=np.int32) * w.shape[1])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(deviation, EXACT), pa.ListArray.from_arrays(ends, pa.array(w.ravel()))], names=["_id", "deviation", "whitened"])

    kind = grid.schema["_id"].dataType.simpleString()
    return grid.mapInArrow(run, f"_id {kind}, deviation decimal(38,0), whitened array<double>").withColumnRenamed("_id", id_col)


def report(vectors: DataFrame, most: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row for each whole vector and component: id, component, n, deviation (a long; an error where it needs more),
    whitened, explained, identity_error. Nulls, repeats, ties and empty tables are as in ``fit`` and ``transform``."""
    model = fit(vectors, most, id_col, vector_col)
    shares = F.array(*map(F.lit, model.explained.tolist())).cast("array<double>")
    rows = transform(vectors, model, id_col, vector_col).select(id_col, "deviation", F.posexplode("whitened").alias("_k", "whitened"))
    return rows.select(
        id_col,
        (F.col("_k") + 1).cast("int").alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        F.col("deviation").cast("long").alias("deviation"),
        "whitened",
        F.get(shares, F.col("_k")).alias("explained"),
        F.lit(model.identity_error).cast("double").alias("identity_error"),
    )
