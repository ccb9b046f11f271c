"""Weighted similarity of two strings, from its published definition, for batches."""

from __future__ import annotations

from functools import lru_cache

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def _common(a: str, b: str) -> int:
    """Length of the longest common subsequence, one bit of a machine word for each sign of a."""
    places: dict[str, int] = {}
    for k, sign in enumerate(a):
        places[sign] = places.get(sign, 0) | 1 << k
    full = (1 << len(a)) - 1
    row = full
    for sign in b:
        hit = row & places.get(sign, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def ratio(a: str, b: str) -> float:
    """Share, of 100, of the signs that neither insertion nor deletion touches."""
    return 100.0 if not a and not b else 200.0 * _common(a, b) / (len(a) + len(b))


def partial_ratio(a: str, b: str) -> float:
    """The best ratio of the shorter string with a stretch of the longer, no longer than it."""
    short, long = (a, b) if len(a) <= len(b) else (b, a)
    if not short:
        return 100.0 if not long else 0.0
    n, best, signs = len(short), 0.0, set(short)
    for start in range(1 - n, len(long)):
        piece = long[max(0, start) : start + n]
        if piece[-1] in signs or piece[0] in signs:
            best = max(best, ratio(short, piece))
            if best == 100.0:
                break
    return best


def _token_ratio(a: str, b: str, compare) -> float:
    """Best of the sorted words compared, and of their common part with what each has besides."""
    x, y = a.split(), b.split()
    both, only_x, only_y = sorted(set(x) & set(y)), sorted(set(x) - set(y)), sorted(set(y) - set(x))
    best = compare(" ".join(sorted(x)), " ".join(sorted(y)))
    if compare is partial_ratio:
        return 100.0 if both else max(best, compare(" ".join(only_x), " ".join(only_y)))
    if both and (not only_x or not only_y):
        return 100.0
    common, first, second = " ".join(both), " ".join(both + only_x), " ".join(both + only_y)
    pairs = [(first, second)] + [(common, first), (common, second)] * bool(both)
    return max(best, *(compare(p, q) for p, q in pairs))


@lru_cache(1 << 16)
def wratio(a: str, b: str) -> float:
    """0 to 100. Strings of like length by the whole or by words; of unlike length by parts too, at a discount."""
    if not a or not b:
        return 0.0
    spread = max(len(a), len(b)) / min(len(a), len(b))
    best = ratio(a, b)
    if spread < 1.5:
        return max(best, 0.95 * _token_ratio(a, b, ratio))
    scale = 0.9 if spread <= 8 else 0.6
    return max(best, scale * partial_ratio(a, b), 0.95 * scale * _token_ratio(a, b, partial_ratio))


@F.pandas_udf(DoubleType())
def wratio_column(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([wratio(x, y) if x is not None and y is not None else 0.0 for x, y in zip(a, b)], dtype="float64")
