"""Embedding whitening on the leading principal components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tallystar.llm.spectrum import leading
from tallystar.llm.tables import plain, table
from tallystar.llm.vectors import matrices, sums

COMPONENTS = 32
#: An entry c becomes the whole number floor(SCALE * c) + SHIFT.
SCALE = 64
SHIFT = 1_000_000
#: Beyond this an entry counts as not finite: sums of 2^31 whole numbers must fit a long.
MOST = 2**31 / SCALE
#: Variance, as a share of all, below which a component is rounding error.
LEAST_SHARE = 1e-13
_LONG = 2**63


def whole(matrix: np.ndarray) -> np.ndarray:
    """Entries as whole numbers, without ``SHIFT``: it cancels wherever a mean is taken away."""
    return np.floor(SCALE * matrix).astype(np.int64)


def _centred(y: np.ndarray, n: int, total: np.ndarray) -> np.ndarray:
    """``x - S / n`` in double precision, from whole numbers that are exact up to the division."""
    mean, rest = np.divmod(total, n)
    return (y - mean) - rest / n


def _deviation(y: np.ndarray, n: int, total: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of ``(n x - S)^2``, and which of them are beyond a long."""
    apart = n * y - total
    beyond = (apart.astype(np.float64) ** 2).sum(axis=1) >= _LONG * (1 - 1e-9)
    return (np.where(beyond[:, None], 0, apart) ** 2).sum(axis=1), beyond


class Whitening:
    """Fitted on all vectors of a table, for each length of vectors by itself."""

    def __init__(self, vectors: DataFrame, components: int):
        self.totals = sums(vectors, lambda m: whole(m).sum(axis=0), MOST, "long")
        totals = self.totals

        def products(m: np.ndarray) -> np.ndarray:
            c = _centred(whole(m), *totals[m.shape[1]])
            return (c.T @ c)[np.triu_indices(c.shape[1])]

        self.values, self.directions, self.shares = {}, {}, {}
        for d, (n, upper) in sums(vectors, products, MOST, "double").items():
            v = np.zeros((d, d))
            v[np.triu_indices(d)] = upper / n
            v = v + np.triu(v, 1).T
            trace = float(np.trace(v))
            values, directions = leading(v, components)
            # Without variance there is nothing to divide by.
            some = values > LEAST_SHARE * trace
            self.values[d], self.directions[d] = np.where(some, values, np.nan), directions
            self.shares[d] = np.where(some, values, 0) / trace if trace > 0 else np.zeros(len(values))
        self.error = self._error(vectors)

    def project(self, matrix: np.ndarray) -> np.ndarray:
        """Whitened rows; nan in components without variance."""
        d = matrix.shape[1]
        return _centred(whole(matrix), *self.totals[d]) @ (self.directions[d] / np.sqrt(self.values[d])[:, None]).T

    def _error(self, vectors: DataFrame) -> float:
        """The largest absolute entry of the whitened vectors' covariance minus the identity, over components with variance."""
        project = self.project

        def moments(m: np.ndarray) -> np.ndarray:
            z = project(m)
            return np.concatenate([z.sum(axis=0), (z.T @ z).ravel()])

        worst = 0.0
        for n, total in sums(vectors, moments, MOST, "double").values():
            k = round((0.25 + len(total)) ** 0.5 - 0.5)
            mean = total[:k] / n
            error = np.abs(total[k:].reshape(k, k) / n - np.outer(mean, mean) - np.eye(k))
            worst = max(worst, float(np.nanmax(error, initial=0.0)))
        return worst


def whiten(embeddings: DataFrame, components: int = COMPONENTS, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Per vector and component the whitened coordinate, with figures of the fit.

    Vectors that are null or hold null or non-finite entries are dropped. The others, as whole numbers
    ``x = floor(64 c) + 1000000``, are centred and projected on the unit eigenvectors of their covariance (divisor n),
    numbered from 1 by falling eigenvalue e, and divided by ``sqrt(e)``. Columns: ``vec_id``, ``component``, ``n`` (vectors of the fit),
    ``deviation`` (sum over dimensions of ``(n x - S)^2``, exact; null beyond a long), ``whitened``, ``explained``
    (e / trace) and ``identity_error`` (one value: how far the whitened vectors' own covariance is from the identity).

    How: tasks add up whole numbers, then products of centred vectors, then products of whitened ones; the driver receives sums of
    as many entries as a covariance has. There counts of pivots of ``L D L^T`` isolate the leading eigenvalues, and Rayleigh quotient
    iteration finds each (``spectrum.leading``). Rows are whitened in a last pass.

    Vectors of another length are a list of their own with its own fit; one shorter than ``components`` gives as many rows as it
    has entries, and an empty one none. Components without variance (one vector, equal vectors, more components than
    the vectors span) have a null ``whitened`` and ``explained`` 0, and do not count for ``identity_error``. Entries beyond 2^25 in size count as not finite.
    Rows that share an id, null ids and repeated rows each count. Other columns are not read; an empty table gives an empty result.
    """
    if components < 1:
        raise ValueError("at least one component")
    rows = embeddings.select(plain(key).cast("long").alias("id"), plain(vector).cast("array<double>").alias("vector"))
    fit = Whitening(rows.select("vector"), components)

    def out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, matrix in matrices(batch.column(1), MOST):
                d = matrix.shape[1]
                n, total = fit.totals[d]
                z = fit.project(matrix)
                k = z.shape[1]
                deviation, beyond = _deviation(whole(matrix), n, total)
                each = np.repeat(np.arange(len(at)), k)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(at[each])),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(at))),
                        pa.array(np.full(len(each), n)),
                        pa.array(deviation[each], mask=beyond[each]),
                        pa.array(z.ravel(), mask=np.isnan(z.ravel())),
                        pa.array(np.tile(fit.shares[d], len(at))),
                        pa.array(np.full(len(each), fit.error)),
                    ],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return rows.mapInArrow(out, "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))
