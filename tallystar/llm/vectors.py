"""Vectors of Arrow list columns as matrices, and sums over all of them."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Vectors handled at once in a task.
ROWS = 2048


def matrices(lists: pa.Array, most: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and doubles of the vectors, one matrix for each length, at most ``ROWS`` rows at a time.

    Left out are null and empty vectors and those with an entry that is null, not finite or beyond ``most``.
    """
    dims = lists.value_lengths().fill_null(0).to_numpy().astype(np.int64)
    values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    begin = np.cumsum(dims) - dims
    with np.errstate(invalid="ignore"):
        wrong = np.concatenate([[0], np.cumsum(~(np.abs(values) <= most))])
    fit = (dims > 0) & (wrong[begin + dims] == wrong[begin])
    for d in np.unique(dims[fit]):
        rows = np.flatnonzero(fit & (dims == d))
        for k in range(0, len(rows), ROWS):
            some = rows[k : k + ROWS]
            yield some, values[begin[some][:, None] + np.arange(d)]


def sums(vectors: DataFrame, terms: Callable[[np.ndarray], np.ndarray], most: float, kind: str) -> dict[int, tuple[int, np.ndarray]]:
    """For each length of vectors: how many there are, and the sums of ``terms`` (of a matrix, added up over its rows).

    Each task adds up its own vectors and sends one row for each entry of its sums; these are added in groups, so that
    the driver receives as many numbers as one task's sums have. ``kind`` is ``long`` or ``double``.
    """
    number = np.int64 if kind == "long" else np.float64

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: dict[int, list] = {}
        for batch in batches:
            for rows, matrix in matrices(batch.column(0), most):
                got = own.setdefault(matrix.shape[1], [0, 0])
                got[0] += len(rows)
                got[1] = got[1] + terms(matrix).astype(number, copy=False)
        for d, (n, total) in own.items():
            entries = np.atleast_1d(total).ravel()
            at = np.arange(-1, len(entries))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(at), d, np.int32)), pa.array(at), pa.array(np.concatenate([[0], entries]).astype(number)), pa.array(np.where(at < 0, n, 0))],
                ["dim", "at", "value", "n"],
            )

    partial = vectors.mapInArrow(add, f"dim int, at long, value {kind}, n long")
    out: dict[int, tuple[int, np.ndarray]] = {}
    total = partial.groupBy("dim", "at").agg(F.sum("value").alias("value"), F.sum("n").alias("n")).toArrow()
    dims, at = total.column("dim").to_numpy(), total.column("at").to_numpy()
    value, n = total.column("value").to_numpy(), total.column("n").to_numpy()
    for d in np.unique(dims):
        mine = np.flatnonzero(dims == d)
        mine = mine[np.argsort(at[mine])]
        out[int(d)] = (int(n[mine[0]]), value[mine[1:]])
    return out
