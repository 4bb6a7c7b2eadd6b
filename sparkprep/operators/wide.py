"""Principal axes of very many columns by randomised subspace iteration.

The covariance of d columns has d * d entries; here nothing is larger than d times the number of axes asked for. Each round reads
the rows once: a task adds up X'(X V) over its batches for the thin basis V that all tasks share, the sums of all
tasks are added as a tree, piece by piece, and the result is orthonormalised on the driver. Rounds go on until the variances
along the axes stand still.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkprep.functions.columns import number

PIECE = 512  #: columns of one summed piece
EXTRA = 10  #: axes of the basis beyond those asked for
TOLERANCE, MOST_ROUNDS = 1e-9, 60


def centred_array(df: DataFrame, columns: Sequence[str], means: Sequence[float]) -> Column:
    """The row's values minus the means; a missing value is an error."""
    shifted = F.array(*[number(df, c) - F.lit(float(m)) for c, m in zip(columns, means)])
    missing = F.exists(shifted, lambda v: v.isNull())
    return F.when(missing, F.raise_error(F.lit("a value for principal components is missing"))).otherwise(shifted)


def _added(table: pa.Table) -> pa.Table:
    """One row with the sum of the pieces of a group."""
    pieces = table.column("sums").to_pylist()
    total = np.frombuffer(pieces[0], dtype=np.float64).copy()
    for piece in pieces[1:]:
        total += np.frombuffer(piece, dtype=np.float64)
    first = table.slice(0, 1)
    return first.set_column(first.schema.get_field_index("sums"), "sums", pa.array([total.tobytes()], pa.binary()))


def _summed(rows: DataFrame, shape: tuple[int, int], part_of: Callable[[pa.RecordBatch], np.ndarray]) -> np.ndarray:
    """The sum over all batches of ``rows`` of what ``part_of`` makes of one, from one pass."""
    d, width = shape
    parts = max(1, math.isqrt(rows.rdd.getNumPartitions()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, width))
        for batch in batches:
            if batch.num_rows:
                total += part_of(batch)
        number_of = TaskContext.get().partitionId() % parts
        pieces = [total[at : at + PIECE].tobytes() for at in range(0, d, PIECE)]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(len(pieces), number_of, dtype=np.int32)),
                pa.array(np.arange(len(pieces), dtype=np.int32)),
                pa.array(pieces, pa.binary()),
            ],
            ["part", "piece", "sums"],
        )

    schema = "part int, piece int, sums binary"
    partial = rows.mapInArrow(run, schema)
    near = partial.groupBy("part", "piece").applyInArrow(_added, schema)
    found = near.groupBy("piece").applyInArrow(_added, schema).select("piece", "sums").collect()
    out = np.zeros((d, width))
    for r in found:
        piece = np.frombuffer(r["sums"], dtype=np.float64).reshape(-1, width)
        out[r["piece"] * PIECE : r["piece"] * PIECE + len(piece)] = piece
    return out


def twice_multiplied(rows: DataFrame, basis: np.ndarray) -> np.ndarray:
    """X'(X V) of the rows X (column ``x``) and the basis V, from one pass."""
    d, width = basis.shape
    shared = rows.sparkSession.sparkContext.broadcast(basis)

    def part_of(batch: pa.RecordBatch) -> np.ndarray:
        x = batch.column("x").flatten().to_numpy().reshape(-1, d)
        return x.T @ (x @ shared.value)

    return _summed(rows, (d, width), part_of)


def covariance(rows: DataFrame, n: int) -> np.ndarray:
    """Covariance of the ``n`` rows, whose columns are numbers near zero on the mean, from one pass; a missing value is an error."""
    d = len(rows.columns)

    def part_of(batch: pa.RecordBatch) -> np.ndarray:
        if any(c.null_count for c in batch.columns):
            raise ValueError("a value for principal components is missing")
        x = np.column_stack([c.to_numpy() for c in batch.columns])
        return np.vstack([x.T @ x, x.sum(axis=0)])

    total = _summed(rows, (d + 1, d), part_of)
    means = total[d] / n
    return (total[:d] - n * np.outer(means, means)) / (n - 1)


def principal_axes(
    rows: DataFrame, d: int, n: int, total: float, threshold: float, n_components: int | None, most: int
) -> tuple[np.ndarray, list[float]]:
    """(axes as columns, shares of the variance) of ``n`` centred rows of ``d`` values (column ``x``).

    As many axes as ``n_components`` says, or enough for ``threshold`` of the variance ``total`` and ``most`` at most; a threshold that
    so many do not reach is an error.
    """
    limit = min(d, n)
    k = min(n_components or min(16, most), limit)
    draw = np.random.Generator(np.random.PCG64(7))
    basis = np.empty((d, 0))
    while True:
        width = min(k + EXTRA, limit)
        basis = np.linalg.qr(np.hstack([basis, draw.standard_normal((d, width - basis.shape[1]))]))[0]
        before = None
        for _ in range(MOST_ROUNDS):
            image = twice_multiplied(rows, basis)
            inner = basis.T @ image
            found, turn = np.linalg.eigh((inner + inner.T) / 2)
            found, axes = found[::-1][:k], basis @ turn[:, ::-1][:, :k]
            if before is not None and np.abs(found - before).max() <= TOLERANCE * max(found[0], 1e-300):
                break
            before = found
            basis = np.linalg.qr(image)[0]
        shares = [float(max(x, 0.0)) / (n - 1) / total if total else 0.0 for x in found]
        if n_components is not None or sum(shares) >= threshold or k == limit:
            return axes, shares
        if k >= most:
            raise ValueError(f"{most} components hold {sum(shares):.3f} of the variance; allow more or fix their number")
        k = min(2 * k, most, limit)
