"""Statistics as column functions over Arrow batches; numpy and the standard library only."""

from __future__ import annotations

import math
from functools import lru_cache
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

_UNIT = NormalDist()


@lru_cache(8)
def _hypergeometric_tails(size: int, marked: int) -> np.ndarray:
    """``tails[n, x]``: probability of ``x`` or more marked ones among ``n`` drawn of ``size``."""
    fact = np.array([math.lgamma(i + 1) for i in range(size + 1)])
    n, x = np.ogrid[: size + 1, : marked + 1]
    possible = (x <= n) & (n - x <= size - marked)
    rest = np.clip(n - x, 0, size - marked)
    logs = fact[marked] - fact[x] - fact[marked - x] + fact[size - marked] - fact[rest] - fact[size - marked - rest] - (fact[size] - fact[n] - fact[size - n])
    mass = np.where(possible, np.exp(np.where(possible, logs, 0.0)), 0.0)
    return np.minimum(mass[:, ::-1].cumsum(axis=1)[:, ::-1], 1.0)


def hypergeometric_tail(phase: int, window: int = 15):
    """Column function (drawn, marked drawn) -> upper tail, rounded to 10 places; null where more are drawn than exist."""
    size, marked = window * phase * 2, window * 2 * 3

    @F.pandas_udf(DoubleType())
    def tail(drawn: pd.Series, hits: pd.Series) -> pd.Series:
        tails = _hypergeometric_tails(size, marked)
        ok = drawn.notna() & hits.notna() & (drawn <= size) & (drawn >= 0)
        n, x = drawn[ok].astype(int).to_numpy(), hits[ok].astype(int).to_numpy()
        p = np.where(x > marked, 0.0, tails[n, np.clip(x, 0, marked)])
        out = pd.Series(np.nan, index=drawn.index)
        out[ok] = p.round(10)
        return out.astype(object).where(ok, None).astype("Float64")

    return tail


@lru_cache(4096)
def _exact_u_tails(n: int, m: int) -> np.ndarray:
    """Upper tails of U over all rank orders of ``n`` and ``m`` different values, from the Gaussian binomial."""
    counts = np.zeros(n * m + 1)
    counts[0] = 1
    for i in range(1, n + 1):
        if m + i <= n * m:
            counts[m + i :] -= counts[: n * m + 1 - m - i].copy()
        for first in range(i):
            counts[first::i] = np.cumsum(counts[first::i])
    tails = counts[::-1].cumsum()[::-1]
    return np.append(tails / tails[0], 0.0)


_erfc = np.frompyfunc(math.erfc, 1, 1)
_inverse = np.frompyfunc(_UNIT.inv_cdf, 1, 1)


def normal_tails(z: np.ndarray) -> np.ndarray:
    return 0.5 * _erfc(z / math.sqrt(2)).astype(float)


def rank_sum_tails(u: np.ndarray, n: np.ndarray, m: np.ndarray, ties: np.ndarray) -> np.ndarray:
    """One-sided tails of rank-sum statistics: exact for untied samples with a side of 8 at most, else normal with both corrections."""
    u, n, m, ties = (np.asarray(c, float) for c in (u, n, m, ties))
    total = n + m
    out = np.full(len(u), np.nan)
    with np.errstate(invalid="ignore", divide="ignore"):
        var = n * m / 12 * ((total + 1) - ties / (total * (total - 1)))
        known = var == var
        out[known & (var <= 0)] = 1.0
        at = known & (var > 0)
        out[at] = normal_tails((u[at] - n[at] * m[at] / 2 - 0.5) / np.sqrt(var[at]))
    few, many = np.minimum(n, m), np.maximum(n, m)
    exact = np.flatnonzero((ties == 0) & (few <= 8) & (u == u))
    if len(exact):
        sizes, of = np.unique(np.stack([few[exact], many[exact]]), axis=1, return_inverse=True)
        for k, (a, b) in enumerate(sizes.T.astype(int)):
            rows = exact[of.ravel() == k]
            out[rows] = _exact_u_tails(a, b)[np.clip(np.ceil(u[rows]), 0, a * b + 1).astype(int)]
    return np.minimum(out, 1.0)


@F.pandas_udf(DoubleType())
def rank_sum_p(u: pd.Series, n: pd.Series, m: pd.Series, ties: pd.Series) -> pd.Series:
    """Column form of :func:`rank_sum_tails`, rounded to 10 places; null inputs give null."""
    p = rank_sum_tails(*(c.to_numpy(float, na_value=np.nan) for c in (u, n, m, ties)))
    return pd.Series(p.round(10)).astype("Float64").mask(np.isnan(p))


def combined_tails(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Stouffer's combination of two p-values; infinite where one is 0 or 1, NaN where these contradict or one is NaN."""
    total = np.zeros(len(a))
    with np.errstate(invalid="ignore"):
        for p in (np.asarray(a, float), np.asarray(b, float)):
            z = np.where(p <= 0, np.inf, np.where(p >= 1, -np.inf, np.nan))
            inner = (p > 0) & (p < 1)
            z[inner] = -_inverse(p[inner]).astype(float)
            total += z
    total /= math.sqrt(2)
    out = np.full(len(total), np.nan)
    ok = total == total
    out[ok] = normal_tails(total[ok]).round(15)
    return out


@F.pandas_udf(DoubleType())
def stouffer(a: pd.Series, b: pd.Series) -> pd.Series:
    """Column form of :func:`combined_tails`; null inputs and contradicting ones give null."""
    p = combined_tails(*(c.to_numpy(float, na_value=np.nan) for c in (a, b)))
    return pd.Series(p).astype("Float64").mask(np.isnan(p))


def log_gamma_tail(k: float, x: float) -> float:
    """Natural logarithm of the regularised upper incomplete gamma function."""
    if x <= 0:
        return 0.0
    front = -x + k * math.log(x) - math.lgamma(k)
    if x < k + 1:  # series of the lower part
        term = total = 1.0 / k
        i = k
        while True:
            i += 1
            term *= x / i
            total += term
            if term < total * 1e-16:
                break
        lower = math.exp(front) * total
        return math.log1p(-min(lower, 1.0)) if lower < 1 else -math.inf
    tiny = 1e-300
    b = x + 1 - k
    c, d = 1 / tiny, 1 / b
    h = d
    for i in range(1, 1_000_000):  # continued fraction
        an = -i * (i - k)
        b += 2
        d = an * d + b
        d = tiny if abs(d) < tiny else d
        c = b + an / c
        c = tiny if abs(c) < tiny else c
        d = 1 / d
        h *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return front + math.log(h)


@F.pandas_udf(DoubleType())
def fisher_log10(sum_of_logs: pd.Series, count: pd.Series) -> pd.Series:
    """log10 of Fisher's combined p-value from the sum of natural logarithms and the number of p-values."""
    return pd.Series([log_gamma_tail(int(k), -float(s)) / math.log(10) if k else 0.0 for s, k in zip(sum_of_logs.fillna(0.0), count.fillna(0))], dtype=float)
