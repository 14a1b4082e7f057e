"""String similarity from 0 to 100, by longest common subsequences.

``weighted`` is the published weighted ratio: the best of the plain, token-sorted, token-set and partial
comparisons, each scaled down by how much it overlooks. Names are compared as they are; normalize first.
"""

from __future__ import annotations

from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType


def common_length(a: str, b: str) -> int:
    """Length of the longest common subsequence, one machine word of bits a character of ``a``."""
    if not a or not b:
        return 0
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    s = full
    for c in b:
        u = s & places.get(c, 0)
        s = (s + u | s - u) & full
    return len(a) - s.bit_count()


def ratio(a: str, b: str) -> float:
    total = len(a) + len(b)
    return 200.0 * common_length(a, b) / total if total else 100.0


def partial_ratio(a: str, b: str, least: float = 0.0) -> float:
    """The best ratio of the shorter string with a window of the longer one, cut at its ends; of equal lengths, either way.

    Below ``least`` the result may be any lower value.
    """
    if len(a) == len(b):
        return max(_windows(a, b, least), _windows(b, a, least))
    return _windows(a, b, least) if len(a) < len(b) else _windows(b, a, least)


def _windows(short: str, long_: str, least: float) -> float:
    """Windows whose characters in common, whatever their order, can't reach ``least`` or better the best are not compared."""
    n, m, best, held = len(short), len(long_), 0.0, 0
    free: dict[str, int] = {}
    for c in short:
        free[c] = free.get(c, 0) + 1
    for end in range(1, n + m) if n else ():
        if end <= m:
            k = free.get(c := long_[end - 1], 0)
            held += k > 0
            free[c] = k - 1
        if end > n:
            free[c] = k = free[c := long_[end - n - 1]] + 1
            held -= k > 0
        most = 200.0 * held / (n + min(end, m) - max(0, end - n))
        if most > best and most >= least:
            best = max(best, ratio(short, long_[max(0, end - n) : end]))
            if best == 100.0:
                break
    return best


def _joined(tokens) -> str:
    return " ".join(sorted(tokens))


def token_ratio(a: str, b: str) -> float:
    x, y = a.split(), b.split()
    best = ratio(_joined(x), _joined(y))
    both, only_x, only_y = set(x) & set(y), set(x) - set(y), set(y) - set(x)
    if both and (not only_x or not only_y):
        return 100.0
    base = _joined(both)
    left, right = (base + " " + _joined(only_x)).strip(), (base + " " + _joined(only_y)).strip()
    best = max(best, ratio(left, right))
    return max(best, ratio(base, left), ratio(base, right)) if base else best


def partial_token_ratio(a: str, b: str, least: float = 0.0) -> float:
    x, y = a.split(), b.split()
    if set(x) & set(y):
        return 100.0
    forms = {(_joined(x), _joined(y)), (_joined(set(x)), _joined(set(y)))}
    return max(partial_ratio(*f, least) for f in forms)


def weighted_from(a: str, b: str, least: float) -> float:
    """The weighted ratio where it is at least ``least``; a lower value may be any, which saves most of the work."""
    if not a or not b:
        return 0.0
    lengths = max(len(a), len(b)) / min(len(a), len(b))
    best = ratio(a, b)
    if lengths < 1.5:
        return max(best, 0.95 * token_ratio(a, b))
    scale = 0.9 if lengths <= 8 else 0.6
    enough = lambda scale: least / scale - 1e-9
    return max(best, scale * partial_ratio(a, b, enough(scale)), 0.95 * scale * partial_token_ratio(a, b, enough(0.95 * scale)))


@lru_cache(maxsize=200_000)
def weighted(a: str, b: str) -> float:
    return weighted_from(a, b, 0.0)


@lru_cache(maxsize=200_000)
def _reaches(a: str, b: str, least: float) -> bool:
    return weighted_from(a, b, least) >= least


def reaches(a: Column, b: Column, least: float) -> Column:
    """Whether ``weighted`` of two columns is at least ``least``, which takes less than the score itself; null where either is null."""

    @F.pandas_udf(BooleanType())
    def test(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([None if x is None or y is None else _reaches(x, y, least) for x, y in zip(a, b)], dtype=object)

    return test(a, b)


@F.pandas_udf(DoubleType())
def weighted_column(a: pd.Series, b: pd.Series) -> pd.Series:
    """``weighted`` of two columns; null where either is null."""
    return pd.Series([None if x is None or y is None else weighted(x, y) for x, y in zip(a, b)], dtype=float)


@F.pandas_udf(DoubleType())
def ratio_column(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([None if x is None or y is None else ratio(x, y) for x, y in zip(a, b)], dtype=float)
