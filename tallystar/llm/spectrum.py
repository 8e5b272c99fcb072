"""Leading eigenvalues of a symmetric matrix by slicing its spectrum."""

from __future__ import annotations

import numpy as np

_EPS = np.finfo(np.float64).eps
_ALPHA = (1 + 17**0.5) / 8  # pivots of one or two rows, as Bunch and Kaufman choose them
_STEPS = 12


def above(a: np.ndarray, shift: float) -> int:
    """How many eigenvalues of ``a`` lie above ``shift``: positive pivots of ``L D L^T = a - shift I`` (Sylvester).

    A pivot that is zero but for rounding counts as below.
    """
    s = a - shift * np.eye(len(a))
    tiny = _EPS / 8 * max(np.abs(a).max(initial=0.0), abs(shift))
    count = k = 0
    n = len(s)
    while k < n:
        column = np.abs(s[k + 1 :, k])
        r = k + 1 + int(column.argmax()) if len(column) else k
        most = abs(s[r, k]) if r > k else 0.0
        width, swap = 1, k
        if most > tiny and abs(s[k, k]) < _ALPHA * most:
            other = np.abs(s[r, k:])
            other[r - k] = 0
            size = other.max()
            if abs(s[k, k]) * size >= _ALPHA * most * most:
                pass
            elif abs(s[r, r]) >= _ALPHA * size:
                swap = r
            else:
                width, swap = 2, r
        at = k + width - 1
        if swap != at:
            s[[at, swap]] = s[[swap, at]]
            s[:, [at, swap]] = s[:, [swap, at]]
        if width == 1:
            d = s[k, k]
            if abs(d) <= tiny:
                d = -tiny
            count += d > 0
            if k + 1 < n:
                c = s[k + 1 :, k]
                s[k + 1 :, k + 1 :] -= np.outer(c, c) / d
        else:
            block = s[k : k + 2, k : k + 2].copy()
            det = block[0, 0] * block[1, 1] - block[0, 1] * block[1, 0]
            count += 1 if det < 0 else 2 * (block[0, 0] + block[1, 1] > 0)
            if k + 2 < n:
                c = s[k + 2 :, k : k + 2].copy()
                inverse = np.array([[block[1, 1], -block[0, 1]], [-block[1, 0], block[0, 0]]]) / det
                update = c @ inverse @ c.T
                s[k + 2 :, k + 2 :] -= (update + update.T) / 2
        k += width
    return count


def _apart(v: np.ndarray, found: list[np.ndarray]) -> np.ndarray:
    """``v`` made orthogonal to the vectors found, and of length one."""
    if found:
        basis = np.array(found)
        for _ in range(2):
            v = v - basis.T @ (basis @ v)
    return v / np.linalg.norm(v)


def _solved(a: np.ndarray, shift: float, v: np.ndarray, size: float) -> np.ndarray:
    """``(a - shift I)^-1 v``, with the shift moved by a rounding error where the matrix is singular."""
    for move in (0.0, 4, -16, 64):
        try:
            out = np.linalg.solve(a - (shift + move * _EPS * size) * np.eye(len(a)), v)
        except np.linalg.LinAlgError:
            continue
        if np.isfinite(out).all() and np.any(out):
            return out
    return v


def leading(a: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``most`` largest eigenvalues of a symmetric matrix, falling, and their unit eigenvectors as rows.

    Counts of pivots (``above``) cut the line into intervals with one eigenvalue each; in each of them inverse iteration
    from its middle and then Rayleigh quotient iteration converge to its vector. A result counts only if the counts on either
    side of its quotient say that it has the number looked for; else the interval is halved and tried again. Eigenvalues no
    more than rounding errors apart are found together: any orthogonal vectors of their space will do.
    """
    n = len(a)
    most = min(most, n)
    size = float(np.abs(a).sum(axis=1).max(initial=0.0))
    if size == 0 or most == 0:
        return np.zeros(most), np.eye(n)[:most]
    a, scale, size = (a + a.T) / 2 / size, size, 1.0
    least = 16 * _EPS
    random = np.random.default_rng(n)
    values: list[float] = []
    vectors: list[np.ndarray] = []
    # Intervals (low, high], with the eigenvalues above each end; the highest is on top.
    todo = [(-size * (1 + 1e-3), size * (1 + 1e-3), n, 0)]
    while todo and len(values) < most:
        low, high, above_low, above_high = todo.pop()
        many = above_low - above_high
        if many == 0:
            continue
        if many == 1 or high - low <= least:
            got = _vectors(a, low, high, many, size, vectors, random)
            if got is not None:
                for value, vector in got:
                    values.append(value)
                    vectors.append(vector)
                continue
            if high - low <= least:
                raise ArithmeticError(f"no vector found for an eigenvalue near {low}")
        middle = (low + high) / 2
        between = min(max(above(a, middle), above_high), above_low)
        todo += [(low, middle, above_low, between), (middle, high, between, above_high)]
    order = np.argsort(-np.array(values[:most]), kind="stable")
    return scale * np.array(values[:most])[order], np.array(vectors[:most])[order]


def _vectors(a, low, high, many, size, found, random):
    """Quotients and vectors of all eigenvalues in an interval; none if the one there is not met."""
    least = 16 * _EPS * size
    out, known = [], list(found)
    for _ in range(many):
        v = _apart(random.standard_normal(len(a)), known)
        v = _apart(_solved(a, (low + high) / 2, v, size), known)
        quotient = v @ a @ v
        before = np.inf
        for _ in range(_STEPS):
            residual = np.linalg.norm(a @ v - quotient * v)
            if residual <= 2 * _EPS * size or residual >= before and residual <= least:
                break
            before = residual
            # Outside its interval the quotient says nothing yet: the middle leads back.
            shift = quotient if low <= quotient <= high else (low + high) / 2
            v = _apart(_solved(a, shift, v, size), known)
            quotient = v @ a @ v
        if not low - least <= quotient <= high + least or np.linalg.norm(a @ v - quotient * v) > least:
            return None
        known.append(v)
        out.append((float(quotient), v))
    if many == 1:
        quotient, number = out[0][0], len(found) + 1
        if not above(a, quotient - least) >= number > above(a, quotient + least):
            return None
    return sorted(out, key=lambda x: -x[0])
