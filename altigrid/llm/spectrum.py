"""Leading eigenpairs of a symmetric matrix by spectrum slicing.

The number of eigenvalues above s is the number of positive values in D of
V - sI = L D L^T (Sylvester's law of inertia). Bisection on that count isolates
each leading eigenvalue; Rayleigh quotient iteration then converges cubically to
a pair within the isolating interval, and two counts beside the eigenvalue
certify its number. Eigenvalues closer than rounding cannot be parted by counts:
they are certified as a group, with vectors made orthogonal within it.
"""

from __future__ import annotations

import numpy as np

# Fixed value: the pivot threshold of Bunch and Kaufman, (1 + sqrt(17)) / 8.
_ALPHA = (1 + 17 ** 0.5) / 8


def count_above(v: np.ndarray, shift: float) -> int:
    """Eigenvalues of v above shift: positive pivots of the shifted matrix's factors.

    Pivots are single or in pairs (Bunch and Kaufman), so it does not break
    down where the shifted matrix is indefinite.
    """
    a = v - shift * np.eye(len(v))
    n, k, above = len(a), 0, 0
    while k < n:
        below = np.abs(a[k + 1:, k])
        most = below.max(initial=0.0)
        pair = False
        if max(abs(a[k, k]), most) > 0:
            if abs(a[k, k]) < _ALPHA * most:
                r = k + 1 + int(below.argmax())
                row = np.abs(a[r, k:])
                row[r - k] = 0
                if abs(a[k, k]) * row.max() < _ALPHA * most * most:
                    pair = abs(a[r, r]) < _ALPHA * row.max()
                    to = k + 1 if pair else k
                    a[[to, r]] = a[[r, to]]
                    a[:, [to, r]] = a[:, [r, to]]
        if pair:
            # A pair of this kind has one positive and one negative eigenvalue.
            above += 1
            block, left = a[k:k + 2, k:k + 2], a[k + 2:, k:k + 2]
            if len(left):
                a[k + 2:, k + 2:] -= left @ np.linalg.solve(block, left.T)
            k += 2
        else:
            above += a[k, k] > 0
            if a[k, k] != 0 and k + 1 < n:
                left = a[k + 1:, k]
                a[k + 1:, k + 1:] -= np.outer(left, left / a[k, k])
            k += 1
    return int(above)


def _solve(v: np.ndarray, shift: float, b: np.ndarray, nudge: float) -> np.ndarray:
    for grow in (0.0, 1.0, 16.0, 256.0):
        try:
            x = np.linalg.solve(v - (shift + grow * nudge) * np.eye(len(v)), b)
        except np.linalg.LinAlgError:
            continue
        size = np.linalg.norm(x)
        if np.isfinite(size) and size > 0:
            return x / size
    return b / np.linalg.norm(b)


def _start(n: int, k: int) -> np.ndarray:
    """A fixed vector without symmetry; another for each component."""
    return np.cos(1.0 + (k + 1) * np.sqrt(2.0) * np.arange(1, n + 1)) + 0.5


def leading(v: np.ndarray, most: int = 4) -> tuple[np.ndarray, np.ndarray]:
    """Up to `most` largest eigenvalues above rounding, falling, and unit eigenvectors as rows.

    The largest entry of a vector by absolute value is positive.
    """
    n = len(v)
    v = (v + v.T) / 2
    bound = float(np.abs(v).sum(axis=1).max(initial=0.0))
    nudge = bound * np.finfo(float).eps
    least = 8 * n * nudge
    values, vectors = [], []
    if bound == 0:
        return np.zeros(0), np.zeros((0, n))
    total = min(most, count_above(v, least))
    low_counts = {}

    def count(s: float) -> int:
        if s not in low_counts:
            low_counts[s] = count_above(v, s)
        return low_counts[s]

    def clean(x: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
        for other in others:
            x = x - (other @ x) * other
        size = np.linalg.norm(x)
        return x / size if size > 0 else x

    while len(values) < total:
        k = len(values)
        # The interval (low, high] holds eigenvalue k: more than k above low, at most k above high.
        low, high = least, bound * (1 + 1e-12)
        for s in low_counts:
            if low < s < high:
                if low_counts[s] > k:
                    low = s
                else:
                    high = s
        found = None
        while found is None:
            alone = count(low) - count(high) == 1
            tied = high - low <= 4 * n * nudge
            if alone or tied:
                x = clean(_start(n, k), vectors)
                rho = (low + high) / 2
                for step in range(40):
                    x = clean(_solve(v, rho, x, nudge), vectors)
                    quotient = float(x @ v @ x)
                    residual = np.linalg.norm(v @ x - quotient * x)
                    if not tied and not low - nudge <= quotient <= high + nudge:
                        # Still mixed with others: go on from the middle of the interval.
                        rho = (low + high) / 2
                        if step >= 8:
                            break
                        continue
                    rho = (low + high) / 2 if tied else quotient
                    if residual <= 4 * n * nudge:
                        found = (quotient, x)
                        break
                if found is None and tied:
                    found = (quotient, x)
            if found is None:
                middle = (low + high) / 2
                if count(middle) > k:
                    low = middle
                else:
                    high = middle
        values.append(found[0])
        vectors.append(found[1])
    order = np.argsort(-np.array(values), kind="stable")
    values, vectors = np.array(values)[order], np.array(vectors)[order].reshape(-1, n)
    for x in vectors:
        if x[np.abs(x).argmax()] < 0:
            x *= -1
    certify(v, values, total)
    return values, vectors


def certify(v: np.ndarray, values: np.ndarray, total: int) -> None:
    """Counts beside each eigenvalue (or group of equal ones) must give its number."""
    gap = 64 * len(v) * np.abs(v).sum(axis=1).max(initial=0.0) * np.finfo(float).eps
    k = 0
    while k < total:
        end = k + 1
        while end < total and values[end - 1] - values[end] <= 2 * gap:
            end += 1
        if count_above(v, values[k] + gap) > k or count_above(v, values[end - 1] - gap) < end:
            raise ArithmeticError(f"counts do not confirm eigenvalues {k + 1} to {end}")
        k = end
