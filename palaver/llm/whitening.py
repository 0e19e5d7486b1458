"""Whitening of embeddings by shifted Cholesky QR.

Entries are put on a grid of 1/256 and become whole numbers. The rows to fit are the distinct
vectors, centred exactly before they are rounded. A pass over them forms their Gram matrix, the
Cholesky factor of which makes the rows nearly orthogonal by triangular solves; the next pass does the
same with what is left, and the factors are composed. A Gram matrix that may have no Cholesky factor
gets a shift of the size of its rounding errors first. When the rows are orthogonal, the composed
factor R has the singular values and right singular vectors of the rows, which give the components.
Passes solve again from the stored whole numbers, so nothing between them is kept but factors.

The driver and each task hold a few matrices of the width of the vectors, which ``MAX_WIDTH`` bounds.

Left out are rows whose vector is null, holds null or non-finite entries, or has not the most frequent
length (of lengths as frequent, the longest). Entries beyond the range of long stand at its end. Vectors
that repeat count once in the fit and have a row each in the result, ids that repeat or are null as well. Equal
eigenvalues keep the order in which the decomposition gives them. A component without variance has no
whitened values; without any variance shares are null too. An empty table gives no rows. Further
columns play no part.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from palaver.llm.common import table
from palaver.session import materialise

#: Widest vectors: a matrix of 4,096 squared takes 128 MB.
MAX_WIDTH = 4096
#: Vectors that a task turns into one matrix at a time, at most.
BLOCK = 2048
#: More passes than this are never needed: three settle a matrix of full rank, two more one without.
MAX_PASSES = 8
UNIT = float(np.finfo(np.float64).eps) / 2

Rows = Callable[[np.ndarray], np.ndarray]


@dataclass(frozen=True)
class Whitening:
    """``mean`` is ``sums / rows``; a column of ``basis`` times a centred row is a whitened value.

    ``values`` are the eigenvalues of the covariance, ``shares`` their parts of its trace; a component
    without variance has a column of NaN.
    """

    width: int
    rows: int
    sums: tuple[int, ...]
    basis: np.ndarray
    values: np.ndarray
    shares: np.ndarray
    identity_error: float | None


def whole(vector: Column, scale: int = 256) -> Column:
    """``floor(scale * entry)`` of every entry, computed in double and held within long."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * F.lit(float(scale))).cast("long"))


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its entries are finite numbers."""
    fine = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))
    return vector.isNotNull() & F.forall(vector, lambda c: F.coalesce(fine(c.cast("double")), F.lit(False)))


def gridded(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", scale: int = 256) -> DataFrame:
    """``key, x`` of the usable vectors of the most frequent length, stored."""
    kept = rows.where(usable(F.col(vector)) & (F.size(vector) > 0))
    stored = materialise(kept.select(F.col(key).alias("key"), whole(F.col(vector), scale).alias("x")), "grid")
    lengths = stored.groupBy(F.size("x").alias("width")).agg(F.count("*").alias("n"))
    # at most MAX_WIDTH lengths can be used, and one row is read of them
    found = lengths.orderBy(F.desc("n"), F.desc("width")).first()
    if found is None:
        return stored
    if found["width"] > MAX_WIDTH:
        raise ValueError(f"vectors of {found['width']} entries; at most {MAX_WIDTH} are supported")
    return stored.where(F.size("x") == found["width"])


def _blocks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            part = batch.slice(at, BLOCK)
            x = part.column("x").flatten().to_numpy(zero_copy_only=False)
            yield part, x.reshape(part.num_rows, width)


def _totals(fit: DataFrame, width: int) -> tuple[int, list[int]]:
    """Number of rows and exact sum of each entry."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, high, low = 0, [0] * width, [0] * width
        for part, x in _blocks(batches, width):
            n += part.num_rows
            # halves, so that a block's sum cannot pass the range of a long
            high = [a + int(b) for a, b in zip(high, (x >> 32).sum(axis=0))]
            low = [a + int(b) for a, b in zip(low, (x & 0xFFFFFFFF).sum(axis=0))]
        if n:
            ids = pa.array([-1, *range(width)], pa.int32())
            sums = [n, *(str((a << 32) + b) for a, b in zip(high, low))]
            yield pa.RecordBatch.from_arrays([ids, pa.array([str(s) for s in sums])], ["i", "s"])

    parts = fit.select("x").mapInArrow(run, "i int, s string")
    found = {r["i"]: int(r["s"]) for r in parts.groupBy("i").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()}
    return found.get(-1, 0), [found.get(i, 0) for i in range(width)]


def _wrapped(value: int) -> int:
    return (value + (1 << 63)) % (1 << 64) - (1 << 63)


def _centred(n: int, sums: list[int] | tuple[int, ...]) -> tuple[Rows, Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]]]:
    """Functions of a block: its rows less the mean, and their squared lengths times n squared with a flag
    that says whether these fit a long. ``n * x - sums`` is exact in arithmetic modulo 2 ** 64 where it fits."""
    modular = np.array([_wrapped(s) for s in sums], np.int64)
    mean = np.array([s / n for s in sums])

    def scaled(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rough = x.astype(np.float64) * n - mean * n
        with np.errstate(over="ignore"):
            return x * np.int64(n) - modular, rough

    def rows(x: np.ndarray) -> np.ndarray:
        exact, rough = scaled(x)
        return np.where(np.abs(rough) < 2.0**62, exact / n, rough / n)

    def deviations(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        exact, rough = scaled(x)
        with np.errstate(over="ignore"):
            return (exact * exact).sum(axis=1), (rough * rough).sum(axis=1) < 2.0**63 * (1 - 1e-9)

    return rows, deviations


def solved(rows: np.ndarray, factor: np.ndarray) -> np.ndarray:
    """``rows`` times the inverse of an upper triangular ``factor``, column by column."""
    out = np.empty_like(rows)
    for j in range(factor.shape[0]):
        out[:, j] = (rows[:, j] - out[:, :j] @ factor[:j, j]) / factor[j, j]
    return out


def _gram(fit: DataFrame, width: int, rows: Rows, size: int) -> np.ndarray:
    """The Gram matrix of ``rows`` of all blocks. Tasks add up their own; Spark adds up the tasks'."""
    upper = np.triu_indices(size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, any_rows = np.zeros((size, size)), False
        for _, x in _blocks(batches, width):
            q = rows(x)
            total += q.T @ q
            any_rows = True
        if any_rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array((upper[0] * size + upper[1]).astype(np.int64)), pa.array(total[upper])], ["cell", "g"]
            )

    cells = fit.select("x").mapInArrow(run, "cell long, g double").groupBy("cell").agg(F.sum("g").alias("g"))
    out = np.zeros((size, size))
    for cell, g in cells.toPandas().itertuples(index=False):
        out[cell // size, cell % size] = out[cell % size, cell // size] = g
    return out


def _factor(gram: np.ndarray, n: int) -> np.ndarray:
    """Upper triangular factor of ``gram``, shifted by its rounding errors where it is close to singular."""
    width = gram.shape[0]
    values = np.linalg.eigvalsh(gram)
    # the published shift, with the square root of n: rounding errors of long sums grow no faster
    shift = 11 * UNIT * width * (np.sqrt(n) + width + 1) * max(values[-1], np.finfo(np.float64).tiny)
    if values[0] < 0.01 * values[-1]:
        gram = gram + shift * np.eye(width)
    return np.linalg.cholesky(gram).T


def fit(grid: DataFrame, components: int = 4) -> Whitening | None:
    """Learn a whitening from the distinct vectors of ``gridded`` rows; None where there are none."""
    first = grid.select(F.size("x").alias("width")).first()
    if first is None:
        return None
    width = first["width"]
    distinct = materialise(grid.select("x").distinct(), "fit")
    n, sums = _totals(distinct, width)
    centred, _ = _centred(n, sums)
    factors: list[np.ndarray] = []
    composed = np.eye(width)

    def orthogonal(x: np.ndarray) -> np.ndarray:
        q = centred(x)
        for factor in factors:
            q = solved(q, factor)
        return q

    for _ in range(MAX_PASSES):
        gram = _gram(distinct, width, orthogonal, width)
        if not factors and not gram.any():
            break
        left, spread, _ = np.linalg.svd(composed)
        real = left[:, spread > max(n, width) * UNIT * spread[0]]
        if factors and np.abs(real.T @ gram @ real - np.eye(real.shape[1])).max() < 64 * width * UNIT:
            break
        factors.append(_factor(gram, n))
        composed = factors[-1] @ composed

    k = min(components, width)
    _, spread, right = np.linalg.svd(composed)
    if not factors:
        spread = np.zeros(width)
    spread = np.where(spread > max(n, width) * UNIT * spread[0], spread, 0.0)
    values = spread**2 / n
    total = values.sum()
    with np.errstate(divide="ignore", invalid="ignore"):
        basis = np.where(values[:k] > 0, right[:k].T / np.sqrt(values[:k]), np.nan)
        shares = values[:k] / total
    held = [j for j in range(k) if values[j] > 0]
    error = None
    if held:
        whitened = basis[:, held]
        covariance = _gram(distinct, width, lambda x: centred(x) @ whitened, len(held)) / n
        error = float(np.abs(covariance - np.eye(len(held))).max())
    return Whitening(width, n, tuple(sums), basis, values[:k], shares, error)


def whitened(grid: DataFrame, model: Whitening) -> DataFrame:
    """``key, component, deviation, whitened`` for every row and component."""
    centred, deviations = _centred(model.rows, model.sums)
    width, basis = model.width, model.basis
    k = basis.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in _blocks(batches, width):
            far, fits = deviations(x)
            values = (centred(x) @ basis).reshape(-1)
            at = np.repeat(np.arange(part.num_rows), k)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("key").take(pa.array(at)),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), part.num_rows)),
                    pa.array(far[at], mask=~fits[at]),
                    pa.array(values, mask=np.isnan(values)),
                ],
                ["key", "component", "deviation", "whitened"],
            )

    kind = grid.schema["key"].dataType.simpleString()
    return grid.mapInArrow(run, f"key {kind}, component int, deviation long, whitened double")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four whitened components of every embedding, with the figures of the fit."""
    grid = gridded(table(spark, sf_dir, "embeddings"))
    model = fit(grid)
    if model is None:
        kind = grid.schema["key"].dataType.simpleString()
        return spark.createDataFrame(
            [], f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
        )
    shares = F.array(*[F.lit(None if np.isnan(s) else float(s)).cast("double") for s in model.shares])
    return whitened(grid, model).select(
        F.col("key").alias("vec_id"),
        "component",
        F.lit(model.rows).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.element_at(shares, F.col("component")).alias("explained"),
        F.lit(model.identity_error).cast("double").alias("identity_error"),
    )
