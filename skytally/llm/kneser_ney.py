"""Discounts of modified Kneser-Ney smoothing (Chen and Goodman, 1999)."""

from __future__ import annotations

import numpy as np


def discounts(n1: float, n2: float, n3: float, n4: float) -> np.ndarray:
    """Discounts for counts 0, 1, 2 and 3 or more, from the numbers of n-grams seen once to four times.

    Where a number is zero or the estimate leaves (0, k), as in tiny or dense
    data, half of the count ``k`` is the discount.
    """
    out = np.array([0.0, 0.5, 1.0, 1.5])
    if n1 and n2:
        y = n1 / (n1 + 2 * n2)
        for k, (a, b) in enumerate(((n1, n2), (n2, n3), (n3, n4)), 1):
            d = k - (k + 1) * y * b / a if a else 0.0
            if 0 < d < k:
                out[k] = d
    return out


def discount_of(counts: np.ndarray, d: np.ndarray) -> np.ndarray:
    return d[np.minimum(counts, 3).astype(np.int64)]


def counts_of_counts(counts: np.ndarray) -> list[int]:
    return [int((counts == k).sum()) for k in (1, 2, 3, 4)]
