"""Whitening of embeddings on their principal components, by refined eigenvectors.

Entries are counted in steps, ``floor(steps * c) + shift``, so sums are whole
numbers. Each distinct vector counts once in the fit.

1. One pass sums each dimension. A second one multiplies what is left of each
   vector after its mean, rounded to whole steps, is taken off: products of small
   whole numbers, whose sums are exact in any order and on any number of
   partitions. The fraction of the mean is then taken off exactly too.
2. The eigenvectors of that covariance come from a float32 solver and are
   corrected in higher precision by the iterations of Ogita and Aishima, which
   are matrix products and converge quadratically: with ``R = I - X'X``,
   ``S = X'AX`` and ``l_i = S_ii / (1 - R_ii)`` the correction is
   ``X (S_ij + l_j R_ij) / (l_j - l_i)``. Eigenvalues closer to one another than the
   present error cannot be told apart that way; such a cluster is solved as a
   problem of its own, shifted to its middle and scaled, and rotates its vectors.
3. Two more passes over the fit list measure the covariance of the result.

The matrices have a row per dimension. They are the only thing that is collected
or broadcast, and do not grow with the table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from decimal import Decimal
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .workspace import Workspace, ship, small_batches

COMPONENTS = 16
STEPS, SHIFT = 64, 1_000_000
FAN_IN = 1000  # partial matrices that one task adds up
EXACT = 1 << 53  # whole numbers up to here are exact in double precision
LONG_DIMENSIONS = 1024  # up to so many dimensions the last corrections use extended precision
ROUNDS = 12  # iterations in one precision, and
SOLVES = 6  # sub-solves one after or in another; both end earlier when nothing is gained
TURN = 0.01

VECTOR = "_x"


# -- eigenvectors ----------------------------------------------------------


def _correct(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """One iteration: corrected vectors, values, which pairs of values cannot be told apart yet, the largest correction."""
    r = np.eye(len(a), dtype=a.dtype) - x.T @ x
    s = x.T @ (a @ x)
    values = np.diag(s) / (1 - np.diag(r))
    off = s - np.diag(values)
    near = 2 * (np.sqrt((off * off).sum()) + np.abs(values).max() * np.sqrt((r * r).sum()))
    gap = values[None, :] - values[:, None]
    apart = np.abs(gap) > near
    e = np.where(apart, (s + values[None, :] * r) / np.where(apart, gap, 1), r / 2)
    # A correction must be small; a turn by a larger angle is left to the sub-solve.
    mixed = ~apart | (np.abs(e) > TURN)
    e = np.where(mixed, r / 2, e)
    return x + x @ e, values, mixed, float(np.max(np.abs(e)))


def _refine(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Iterate in the precision of ``a`` until nothing is gained."""
    x, last = x.astype(a.dtype), np.inf
    eps = float(np.finfo(a.dtype).eps)
    for turn in range(ROUNDS):
        x, values, mixed, change = _correct(a, x)
        if change <= 4 * eps or (turn > 2 and change > last / 2):
            break
        last = change
    return x, values, mixed


def _clusters(values: np.ndarray, mixed: np.ndarray) -> list[np.ndarray]:
    """Groups of values in a row, neighbours of which cannot be told apart, by index."""
    order = np.argsort(values, kind="stable")
    ranked = mixed[np.ix_(order, order)] | mixed[np.ix_(order, order)].T
    np.fill_diagonal(ranked, False)
    # A pair that is mixed binds all between the two.
    reach = np.maximum.accumulate(np.where(ranked.any(axis=1), ranked.shape[0] - 1 - np.argmax(ranked[:, ::-1], axis=1), np.arange(len(values))))
    cut = np.flatnonzero(reach[:-1] <= np.arange(len(values) - 1)) + 1
    return [c for c in np.split(order, cut) if len(c) > 1]


def refined_eigh(matrix: np.ndarray, depth: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors as columns of a symmetric matrix.

    Vectors come from a float32 solver and are corrected in double precision and
    then in extended precision. What stays clustered is solved by itself.
    """
    n = len(matrix)
    wide = np.longdouble if n <= LONG_DIMENSIONS else np.float64
    a = matrix.astype(wide)
    scale = np.max(np.abs(a)) if n else 0
    if not scale > 0:
        return np.zeros(n, wide), np.eye(n, dtype=wide)
    a = (a + a.T) / (2 * scale)
    x = np.linalg.eigh(a.astype(np.float32))[1]
    x, _, _ = _refine(a.astype(np.float64), x)
    eps = float(np.finfo(wide).eps)
    for _ in range(SOLVES):
        x, values, mixed = _refine(a, x)
        turned = False
        for group in _clusters(values, mixed) if depth < SOLVES and n > 1 else []:
            part = x[:, group]
            inner = part.T @ (a @ part) - np.mean(values[group]) * (part.T @ part)
            loose = np.abs(inner - np.diag(np.diag(inner))).max()
            # A group as wide as the whole is no smaller problem; one of a single value may keep any basis.
            if len(group) < n and loose > 8 * n * eps:
                x[:, group] = part @ refined_eigh(inner, depth + 1)[1]
                turned = True
        if not turned:
            break
    for _ in range(2):  # orthogonal to the last bit, which no turn of the last iteration may spoil
        x = x + x @ (np.eye(n, dtype=wide) - x.T @ x) / 2
    values = (x * (a @ x)).sum(axis=0) / (x * x).sum(axis=0)
    order = np.argsort(-values, kind="stable")
    return values[order] * scale, x[:, order]


# -- sums over all partitions ----------------------------------------------


def _halves(total: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A number in extended precision as two doubles."""
    high = total.astype(np.float64)
    return high, (total - high).astype(np.float64)


def _rows(group: int, part: int, total: np.ndarray) -> pa.RecordBatch:
    high, low = _halves(total)
    n = len(total)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.arange(n, dtype=np.int32)), pa.array([group] * n, pa.int32()), pa.array([part] * n, pa.int32()), pa.array(list(high)), pa.array(list(low))],
        ["line", "group", "part", "high", "low"],
    )


def _sums(of: Callable[[np.ndarray], np.ndarray], batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The matrix ``of`` summed over the vectors of a partition, a row per line."""
    total = None
    for batch in batches:
        if batch.num_rows:
            part = of(_matrix(batch.column(0)))
            total = part if total is None else total + part
    if total is not None:
        part = TaskContext.get().partitionId()
        yield _rows(part // FAN_IN, part, total)


def _matrix(column: pa.Array) -> np.ndarray:
    """Lists of one length as the rows of a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _add(table: pa.Table) -> pa.Table:
    """One line of a matrix, added up in the order of the partitions."""
    table = table.sort_by("part")
    total = _matrix(table.column("high")).astype(np.longdouble).sum(axis=0) + _matrix(table.column("low")).astype(np.longdouble).sum(axis=0)
    high, low = _halves(total)
    return pa.table(
        {
            "line": table.column("line").slice(0, 1),
            "group": pa.array([0], pa.int32()),
            "part": table.column("group").slice(0, 1),
            "high": pa.array([high]),
            "low": pa.array([low]),
        }
    )


def _summed(fit: DataFrame, of: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The matrix ``of`` summed over all vectors; what comes back has a fixed size."""
    schema = "line int, group int, part int, high array<double>, low array<double>"
    parts = fit.mapInArrow(partial(_sums, of), schema)
    sums = parts.groupBy("line", "group").applyInArrow(_add, schema).groupBy("line").applyInArrow(_add, schema)
    rows = sorted(sums.select("line", "high", "low").collect())
    return np.array([r[1] for r in rows], np.longdouble) + np.array([r[2] for r in rows], np.longdouble)


# -- fitting ---------------------------------------------------------------


@dataclass(frozen=True)
class Whitening:
    """What turns a vector into its whitened components; its arrays have a row or column per dimension."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray  # of the components kept, falling
    vectors: np.ndarray  # unit columns
    trace: float
    identity_error: float
    steps: int
    shift: int

    @property
    def dimensions(self) -> int:
        return len(self.sums)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """``x`` less the mean: whole steps first, which is exact, and then the fraction."""
        whole, rest = self.mean
        return (x - whole).astype(np.float64) - rest / self.n

    @property
    def mean(self) -> tuple[np.ndarray, np.ndarray]:
        """The mean rounded to whole steps, and ``n`` times what is left of it."""
        whole = [(2 * s + self.n) // (2 * self.n) for s in self.sums]
        return np.array(whole, np.int64), np.array([s - self.n * w for s, w in zip(self.sums, whole)], np.int64)

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ (self.vectors / np.sqrt(self.values))

    def deviation(self, x: np.ndarray) -> pa.Array:
        """The sum over dimensions of ``(n x - sum) ** 2``, exact."""
        whole, rest = self.mean
        off = x - whole
        most = int(np.abs(off).max(initial=0)) * self.n + self.n
        if most * most * max(1, self.dimensions) < 1 << 63:
            return pa.array(((off * self.n - rest) ** 2).sum(axis=1)).cast(pa.decimal128(38, 0))
        exact = (off.astype(object) * self.n - rest.astype(object)) ** 2
        return pa.array([Decimal(int(v)) for v in exact.sum(axis=1)], pa.decimal128(38, 0))


def in_steps(vector: Column, steps: int = STEPS, shift: int = SHIFT) -> Column:
    """The entries in whole steps; NULL for a vector that is NULL or has an entry that is NULL or not finite."""
    infinite = F.lit(float("inf"))
    sound = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) != infinite))
    counted = F.transform(vector, lambda c: F.floor(c.cast("double") * steps) + F.lit(shift).cast("long"))
    return F.when(vector.isNotNull() & sound, counted)


def _gram(whole: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Products of all pairs of dimensions, summed over the rows in stretches short enough to be exact."""
    off = (x - whole).astype(np.float64)
    most = max(1.0, float(np.abs(off).max(initial=0)))
    rows = max(1, int(min(len(off), EXACT / (most * most))))
    total = np.zeros((x.shape[1], x.shape[1]), np.longdouble)
    for at in range(0, len(off), rows):
        part = off[at : at + rows]
        total += part.T @ part
    return total


def _sum_rows(x: np.ndarray) -> np.ndarray:
    """Sums of the rows and their number, in stretches short enough to be exact."""
    return np.append(x.sum(axis=0, dtype=np.int64), len(x)).astype(np.longdouble)[None, :]


def _whitened_sum(model: Whitening, x: np.ndarray) -> np.ndarray:
    return model.whitened(x).astype(np.longdouble).sum(axis=0)[None, :]


def _whitened_gram(model: Whitening, mean: np.ndarray, x: np.ndarray) -> np.ndarray:
    off = model.whitened(x) - mean
    return (off.T @ off).astype(np.longdouble)


def fit_whitening(
    rows: DataFrame, vector_col: str = "embedding", components: int = COMPONENTS, steps: int = STEPS, shift: int = SHIFT
) -> Whitening | None:
    """Mean, principal components and the measured error of whitening by them; None without a usable vector.

    Vectors that are NULL or have an entry that is NULL, NaN or infinite do not
    count, nor do those of another length than most have (of two lengths that are
    equally frequent the greater counts). Equal vectors count once. A component
    whose variance is nothing but rounding does not exist: there are fewer than
    ``components`` then, none if all vectors are equal. Entries too large for a
    64-bit number of steps fail the job.
    """
    spark = rows.sparkSession
    ship(spark)
    small_batches(spark)
    work = Workspace(spark, "whitening")
    x = rows.select(in_steps(F.col(f"`{vector_col}`"), steps, shift).alias(VECTOR)).where(f"{VECTOR} IS NOT NULL")
    distinct = work.write(x.distinct(), "fit")
    lengths = distinct.groupBy(F.size(VECTOR).alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    if not lengths or not lengths[0]["d"]:
        return None
    fit = distinct.where(F.size(VECTOR) == lengths[0]["d"])

    *sums, n = (int(v) for v in _summed(fit, _sum_rows)[0])
    model = Whitening(n, tuple(sums), np.zeros(0), np.zeros((len(sums), 0)), 0.0, 0.0, steps, shift)
    whole, rest = model.mean
    fraction = rest.astype(np.longdouble) / n
    covariance = _summed(fit, partial(_gram, whole)) / n - np.outer(fraction, fraction)
    values, vectors = refined_eigh(covariance)
    trace = float(np.trace(covariance))
    kept = int((values > trace * len(sums) * np.finfo(np.float64).eps).sum())
    kept = min(kept, components)
    vectors = vectors[:, :kept]
    top = vectors[np.abs(vectors).argmax(axis=0), np.arange(kept)] if kept else np.zeros(0)
    vectors = vectors * np.where(top < 0, -1, 1)  # one of both signs, always the same
    model = Whitening(n, model.sums, values[:kept].astype(np.float64), vectors.astype(np.float64), trace, 0.0, steps, shift)
    error = 0.0
    if kept:
        mean = (_summed(fit, partial(_whitened_sum, model))[0] / n).astype(np.float64)
        got = _summed(fit, partial(_whitened_gram, model, mean)) / n
        error = float(np.max(np.abs(got - np.eye(kept))))
    work.keep_only()
    return Whitening(n, model.sums, model.values, model.vectors, trace, error, steps, shift)


def _apply(model, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    model = model.value
    k = len(model.values)
    for batch in batches:
        x = _matrix(batch.column(VECTOR)) if batch.num_rows else np.zeros((0, model.dimensions), np.int64)
        of = pa.array(np.repeat(np.arange(batch.num_rows), k))
        whitened = model.whitened(x).reshape(-1)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("_id").take(of),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), batch.num_rows)),
                model.deviation(x).take(of),
                pa.array(whitened),
                pa.array(np.tile(model.values / model.trace, batch.num_rows) if k else whitened),
            ],
            ["_id", "component", "deviation", "whitened", "explained"],
        )


def whiten(rows: DataFrame, model: Whitening | None, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per usable vector and component: id, ``component`` from 1, ``deviation``, ``whitened``, ``explained``.

    Rows are usable as in :func:`fit_whitening`. ``deviation`` is the exact sum over
    dimensions of ``(n x - sum) ** 2``, a decimal; ``whitened`` the centred vector on
    the component over the root of its variance; ``explained`` the component's share
    of all variance. Rows are independent of one another: repeated rows come out
    alike, NULL ids are kept and other columns ignored. Without a model, as from an
    empty table, the result is empty.
    """
    spark = rows.sparkSession
    ship(spark)
    small_batches(spark)
    steps, shift = (model.steps, model.shift) if model else (STEPS, SHIFT)
    base = rows.select(F.col(f"`{id_col}`").alias("_id"), in_steps(F.col(f"`{vector_col}`"), steps, shift).alias(VECTOR))
    base = base.where(F.size(VECTOR) == model.dimensions if model else F.lit(False))
    schema = f"_id {base.schema['_id'].dataType.simpleString()}, component int, deviation decimal(38,0), whitened double, explained double"
    if model is None:
        return spark.createDataFrame([], schema).withColumnRenamed("_id", id_col)
    shared = spark.sparkContext.broadcast(model)  # a row per dimension
    return base.mapInArrow(partial(_apply, shared), schema).withColumnRenamed("_id", id_col)
