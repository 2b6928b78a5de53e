"""Whitening of embeddings by shifted CholeskyQR.

Entries become whole numbers ``x = floor(scale * c) + offset``. Every distinct
x-vector counts once: the fit list. Its sums are added up exactly, its rows centred
by them (difference of whole numbers first, one rounding after), and the centred
rows are made orthonormal in passes over the list: each pass adds up the Gram
matrix of the rows, takes its Cholesky factor, and the next pass solves the rows
by that triangle. The first Gram matrix, and any that is singular, is shifted by a
multiple of the rounding error of its norm, so that the factor exists however badly
the dimensions are scaled. Two passes that follow on a well-conditioned one restore
full precision. The product R of the factors has the singular values and right singular
vectors of the centred rows: components and eigenvalues of the covariance are
never read off a squared matrix.

The rows stay distributed. A pass is a map over the fit list that adds up one square
matrix a task in numpy; the matrices are added up cell by cell in a grouping, and
dimension^2 numbers reach the driver, whatever the number of rows. A vector that a
third of all rows share is reduced before the shuffle (``distinct``). The fit list is
written to the shared folder once, so that a lost executor costs its own tasks.

Results: vectors that are NULL, empty or hold NULL or non-finite entries are dropped,
and so are vectors of another length than the most frequent one of the distinct
vectors (ties: the longer). Entries beyond 2^62 / scale count as that bound.
Components without variance (fewer distinct vectors than dimensions, constant
dimensions) cannot be whitened and are left out; so an empty table, or one of equal
vectors, has no rows in the result. ``deviation`` is NULL where it does not fit a long.
Repeated and NULL ids are rows of their own; equal vectors get equal rows. Of a
component's two signs the one is taken that makes its greatest entry positive.
Other columns, whatever their names, are not carried.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import new_work_dir

# fixed values of the whole-number form of an entry
SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 16
LARGEST = float(2 ** 62)
EPS = np.finfo(float).eps / 2
MAX_PASSES = 6


def whole_numbers(vector: Column, scale: int = SCALE, offset: int = OFFSET) -> Column:
    """The whole-number form of a vector; NULL if it is NULL, empty or holds an entry that is NULL or not finite."""
    vector = vector.cast("array<double>")
    fine = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    x = F.transform(vector, lambda c: F.floor(F.least(F.greatest(c * scale, F.lit(-LARGEST)), F.lit(LARGEST))).cast("long") + offset)
    return F.when((F.size(vector) > 0) & fine, x)


def _rows(batch: pa.RecordBatch, d: int, column: str = "x") -> np.ndarray:
    return batch.column(column).flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(-1, d)


class Center:
    """The exact mean ``S / n``: per dimension the whole part, and the rest over n."""

    def __init__(self, n: int, sums: list[int]):
        self.n, self.d = n, len(sums)
        self.whole = np.array([s // n for s in sums], np.int64)
        self.rest = np.array([s % n for s in sums], np.int64)

    def rows(self, x: np.ndarray) -> np.ndarray:
        """Centred rows: exact differences, then one rounding."""
        return (x - self.whole) - self.rest / self.n

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Per row the sum of (n x - S)^2, exactly; None where it does not fit a long."""
        y = x - self.whole
        if float(np.abs(y).max(initial=0)) * self.n < 2.0 ** 61 and (
                ((y.astype(float) * self.n - self.rest) ** 2).sum(1).max(initial=0) < 2.0 ** 62):
            return ((y * self.n - self.rest) ** 2).sum(1).tolist()
        rest = [int(r) for r in self.rest]
        exact = [sum((v * self.n - r) ** 2 for v, r in zip(row, rest)) for row in y.tolist()]
        return [v if v < 2 ** 63 else None for v in exact]


def solve_triangles(y: np.ndarray, factors: list[np.ndarray]) -> np.ndarray:
    """``y R1^-1 R2^-1 ...`` for upper triangles R1, R2, ..., column by column."""
    for r in factors:
        q = np.empty_like(y)
        for j in range(r.shape[0]):
            q[:, j] = (y[:, j] - q[:, :j] @ r[:j, j]) / r[j, j]
        y = q
    return y


def _sums(fit: DataFrame) -> tuple[int, list[int]] | None:
    """n and the exact sums of the vectors of the most frequent length; None if there is no vector."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict = {}
        for batch in batches:
            sizes = np.diff(batch.column("x").offsets.to_numpy())
            for d in np.unique(sizes).tolist():
                x = _rows(batch.filter(pa.array(sizes == d)), d)
                # halves of the numbers, so that no sum of a task can overflow
                total = totals.setdefault(d, [0, np.zeros(d, np.int64), np.zeros(d, np.int64)])
                total[0] += len(x)
                total[1] += (x >> 31).sum(0)
                total[2] += (x & (2 ** 31 - 1)).sum(0)
        for d, (n, high, low) in totals.items():
            yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in ([d] * d, [n] * d, range(d), high, low)], ["d", "n", "i", "high", "low"])

    add = [F.sum(F.col(c).cast("decimal(20,0)")).alias(c) for c in ("n", "high", "low")]
    found = fit.mapInArrow(work, "d long, n long, i long, high long, low long").groupBy("d", "i").agg(*add)
    most = found.where("i = 0").orderBy(F.desc("n"), F.desc("d")).first()
    if most is None:
        return None
    rows = found.where(F.col("d") == most["d"]).orderBy("i").collect()      # a row for each dimension
    return int(most["n"]), [int(r["high"]) * 2 ** 31 + int(r["low"]) for r in rows]


def _gram(fit: DataFrame, center: Center, factors: list[np.ndarray], last: np.ndarray | None = None) -> np.ndarray:
    """The Gram matrix of the centred rows solved by ``factors`` (and multiplied by ``last``)."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            sizes = np.diff(batch.column("x").offsets.to_numpy())
            q = solve_triangles(center.rows(_rows(batch.filter(pa.array(sizes == center.d)), center.d)), factors)
            q = q if last is None else q @ last
            total = q.T @ q if total is None else total + q.T @ q
        if total is not None:
            k = total.shape[0]
            yield pa.RecordBatch.from_arrays([pa.array(range(k), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], ["i", "cells"])

    cells = (fit.mapInArrow(work, "i int, cells array<double>").select("i", F.posexplode("cells").alias("j", "v"))
             .groupBy("i", "j").agg(F.sum("v").alias("v")).collect())       # dimension^2 numbers
    k = center.d if last is None else last.shape[1]
    gram = np.zeros((k, k))
    for r in cells:
        gram[r["i"], r["j"]] = r["v"]
    return (gram + gram.T) / 2


def orthogonalise(fit: DataFrame, center: Center) -> tuple[list[np.ndarray], np.ndarray]:
    """Triangles that the centred rows are solved by, and R with ``R^T R`` = their Gram matrix."""
    d, factors = center.d, []
    for _ in range(MAX_PASSES):
        gram = _gram(fit, center, factors)
        if not gram.any():
            return factors, np.zeros((d, d))
        least = np.linalg.eigvalsh(gram)[0]
        if factors and least > 0.5:         # orthonormal up to rounding: the last factor needs no further pass
            break
        norm = np.linalg.norm(gram, 2)
        shift = 0.0 if factors and least > 1e-6 * norm else 11 * (center.n * d + d * (d + 1)) * EPS * norm
        factors.append(np.linalg.cholesky(gram + shift * np.eye(d)).T)
    values, vectors = np.linalg.eigh(gram)
    root = (vectors * np.sqrt(np.maximum(values, 0))) @ vectors.T
    return factors, root @ reduce(lambda r, f: f @ r, factors)


def whiten(vectors: DataFrame, components: int = COMPONENTS, scale: int = SCALE, offset: int = OFFSET,
           id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error): a row for each valid vector and component."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).alias("vec_id"), whole_numbers(F.col(vector_col), scale, offset).alias("x")).where("x IS NOT NULL")
    id_type = rows.schema["vec_id"].dataType.simpleString()
    schema = (f"vec_id {id_type}, component int, n long, deviation long, whitened double, explained double, identity_error double")
    path = f"{new_work_dir(spark, 'whitening')}/fit"
    rows.select("x").distinct().write.parquet(path)
    fit = spark.read.parquet(path)
    found = _sums(fit)
    if found is None:
        return spark.createDataFrame([], schema)
    center = Center(*found)
    factors, r = orthogonalise(fit, center)
    _, sigma, v = np.linalg.svd(r)
    k = int((sigma > sigma[0] * 1e-13).sum())
    if k == 0:
        return spark.createDataFrame([], schema)
    k = min(k, components)
    sigma, total, v = sigma[:k], float((sigma ** 2).sum()), v[:k]
    v = v * np.where(v[np.arange(k), np.abs(v).argmax(1)] < 0, -1, 1)[:, None]
    explained = sigma ** 2 / total
    # a row projected on the components, over their standard deviations; in terms of its solved form, so that
    # a component of little variance does not lose its digits to one of much
    solved = reduce(lambda m, f: f @ m, factors, v.T)
    projection = solved / (sigma / np.sqrt(center.n))
    covariance = _gram(fit, center, factors, projection) / center.n
    error = float(np.abs(covariance - np.eye(k)).max())
    n, d = center.n, center.d

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(np.diff(batch.column("x").offsets.to_numpy()) == d))
            x = _rows(batch, d)
            m = len(x)
            if not m:
                continue
            whitened = solve_triangles(center.rows(x), factors) @ projection
            each = np.repeat(np.arange(m), k)
            yield pa.RecordBatch.from_arrays([
                batch.column("vec_id").take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                pa.array(np.full(m * k, n, np.int64)), pa.array(center.deviations(x), pa.int64()).take(pa.array(each)),
                pa.array(whitened.ravel()), pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error))],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(work, schema)
