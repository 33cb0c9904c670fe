"""Tail probabilities without further libraries, over numpy arrays; each is a small helper for a pandas UDF."""

from __future__ import annotations

import math
from functools import lru_cache
from itertools import combinations

import numpy as np

_lgamma = np.vectorize(math.lgamma, otypes=[float])
_erfc = np.vectorize(math.erfc, otypes=[float])


def beta_inc(a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Regularised incomplete beta function by Lentz's continued fraction."""
    a, b, x = np.broadcast_arrays(*(np.asarray(v, float) for v in (a, b, x)))
    inside = (x > 0) & (x < 1)
    out = np.where(x >= 1, 1.0, 0.0)
    if inside.any():
        p, q, z = a[inside], b[inside], x[inside]
        swap = z > (p + 1) / (p + q + 2)
        p, q, z = np.where(swap, q, p), np.where(swap, p, q), np.where(swap, 1 - z, z)
        front = np.exp(_lgamma(p + q) - _lgamma(p) - _lgamma(q) + p * np.log(z) + q * np.log1p(-z)) / p
        tiny = 1e-300
        c, d = np.ones_like(z), 1 - (p + q) * z / (p + 1)
        d = 1 / np.where(np.abs(d) < tiny, tiny, d)
        f = d.copy()
        for m in range(1, 400):
            for top in (m * (q - m) * z / ((p + 2 * m - 1) * (p + 2 * m)), -(p + m) * (p + q + m) * z / ((p + 2 * m) * (p + 2 * m + 1))):
                d = 1 + top * d
                d = 1 / np.where(np.abs(d) < tiny, tiny, d)
                c = 1 + top / c
                c = np.where(np.abs(c) < tiny, tiny, c)
                f *= c * d
            if (np.abs(c * d - 1) < 1e-15).all():
                break
        value = front * f
        out[inside] = np.where(swap, 1 - value, value)
    return out


def t_two_sided(t: np.ndarray, df: np.ndarray) -> np.ndarray:
    t, df = np.asarray(t, float), np.asarray(df, float)
    return beta_inc(df / 2, 0.5, df / (df + t * t))


def f_upper(f: np.ndarray, d1: np.ndarray, d2: np.ndarray) -> np.ndarray:
    f, d1, d2 = (np.asarray(v, float) for v in (f, d1, d2))
    return beta_inc(d2 / 2, d1 / 2, d2 / (d2 + d1 * f))


_FACTORIALS = np.concatenate([[0.0], np.cumsum(np.log(np.arange(1, 256)))])


def log_factorial(n: np.ndarray) -> np.ndarray:
    """Logarithm of n! of whole numbers: a short table, and Stirling's series beyond it."""
    x = np.maximum(n, 256).astype(float)
    series = x * np.log(x) - x + 0.5 * np.log(2 * np.pi * x) + 1 / (12 * x) - 1 / (360 * x**3) + 1 / (1260 * x**5)
    return np.where(n < 256, _FACTORIALS[np.clip(n, 0, 255)], series)


def gamma_upper(a: float, x: float) -> float:
    """Regularised upper incomplete gamma function."""
    if x <= 0:
        return 1.0
    front = math.exp(a * math.log(x) - x - math.lgamma(a))
    if x < a + 1:
        term = total = 1 / a
        n = a
        while term > total * 1e-16:
            n += 1
            term *= x / n
            total += term
        return 1 - front * total
    b, c = x + 1 - a, 1e300
    d = 1 / b
    h = d
    for i in range(1, 1000):
        step = -i * (i - a)
        b += 2
        d = 1 / (step * d + b)
        c = b + step / c
        h *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return front * h


def chi2_upper(x: np.ndarray, df: np.ndarray) -> np.ndarray:
    return np.array([gamma_upper(k / 2, v / 2) if k > 0 and v == v else np.nan for v, k in zip(np.atleast_1d(x), np.broadcast_to(df, np.shape(np.atleast_1d(x))), strict=True)])


def normal_two_sided(z: np.ndarray) -> np.ndarray:
    return _erfc(np.abs(np.asarray(z, float)) / math.sqrt(2))


def average_ranks(values: np.ndarray) -> np.ndarray:
    _, back, counts = np.unique(values, return_inverse=True, return_counts=True)
    ends = np.cumsum(counts)
    return (ends - (counts - 1) / 2)[back]


def rank_sum(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Wilcoxon's W and two-sided p: exact without ties below 50 values a side, else normal with a continuity correction."""
    n, m = len(x), len(y)
    if not n or not m:
        return math.nan, math.nan
    ranks = average_ranks(np.concatenate([x, y]))
    w = float(ranks[:n].sum() - n * (n + 1) / 2)
    _, counts = np.unique(np.concatenate([x, y]), return_counts=True)
    if n < 50 and m < 50 and (counts == 1).all():
        ways = np.zeros((n + 1, n * m + 1))  # ways[k]: k of the first i ranks, by W
        ways[0, 0] = 1
        for i in range(1, n + m + 1):
            for k in range(min(i, n), 0, -1):
                shift = i - k
                if shift <= n * m:
                    ways[k, shift:] += ways[k - 1, : n * m + 1 - shift]
        total = ways[n] / ways[n].sum()
        tail = total[: int(w) + 1].sum() if w <= n * m / 2 else total[int(w) :].sum()
        return w, min(1.0, 2 * float(tail))
    z = w - n * m / 2
    sigma = math.sqrt(n * m / 12 * (n + m + 1 - (counts**3 - counts).sum() / ((n + m) * (n + m - 1))))
    return w, float(normal_two_sided((z - math.copysign(0.5, z) * (z != 0)) / sigma)) if sigma else math.nan


def ks_distance(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Kolmogorov-Smirnov D and its two-sided p: exact by counting lattice paths below 10000 cells, else the limit."""
    n, m = len(x), len(y)
    if not n or not m:
        return math.nan, math.nan
    both = np.concatenate([x, y])
    order = np.sort(np.unique(both))
    d = float(np.max(np.abs(np.searchsorted(np.sort(x), order, "right") / n - np.searchsorted(np.sort(y), order, "right") / m)))
    if n * m < 10_000:
        cut = (math.floor(d * n * m - 1e-7) + 0.5) / (n * m)
        row = [float(j / m <= cut) for j in range(m + 1)]
        for i in range(1, n + 1):
            weight = i / (i + m)
            row[0] = weight * row[0] if i / n <= cut else 0.0
            for j in range(1, m + 1):
                row[j] = weight * row[j] + row[j - 1] if abs(i / n - j / m) <= cut else 0.0
        return d, min(1.0, max(0.0, 1 - row[m]))
    z = d * math.sqrt(n * m / (n + m))
    return d, min(1.0, max(0.0, 2 * sum((-1) ** (k - 1) * math.exp(-2 * (k * z) ** 2) for k in range(1, 101))))


def ks_without_ties(x: np.ndarray, y: np.ndarray, step: float = 1e-5) -> tuple[float, float]:
    """ks_distance after ties are broken, as the exact test has it: repeats within a group, then values of y that x has, go down by a step, up to ten times."""
    x, y = (np.array(v, float) for v in (x, y))
    for own in (x, y):
        for _ in range(10):
            _, first = np.unique(own, return_index=True)
            if len(first) == len(own):
                break
            again = np.ones(len(own), bool)
            again[first] = False
            own[again] -= step
    for _ in range(10):
        y[np.isin(y, x)] -= step
    return ks_distance(x, y)


def ansari_bradley(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """AB statistic of x and its two-sided p: exact below 50 values a side without ties, else the normal limit with ties."""
    n, m = len(x), len(y)
    if not n or not m:
        return math.nan, math.nan
    total = n + m
    ranks = average_ranks(np.concatenate([x, y]))
    scores = np.minimum(ranks, total - ranks + 1)
    ab = float(scores[:n].sum())
    if n < 50 and m < 50 and len(np.unique(ranks)) == total:
        ways = np.zeros((n + 1, int(scores.sum()) + 1))  # ways[k]: k of the scores so far, by their sum
        ways[0, 0] = 1
        for s in scores.astype(int):
            ways[1:, s:] += ways[:-1, : ways.shape[1] - s].copy()
        chance = ways[n] / ways[n].sum()
        low, high = chance[: int(ab) + 1].sum(), chance[int(ab) :].sum()
        return ab, min(1.0, 2 * float(min(low, high)))
    sigma = math.sqrt(n * m * scores.var() / (total - 1)) if total > 1 else 0.0
    return ab, float(normal_two_sided((ab - n * scores.mean()) / sigma)) if sigma else math.nan


def signed_rank(d: np.ndarray) -> tuple[float, float]:
    """V, the sum of the ranks of positive differences, and its two-sided p: exact below 50 without ties or zeros, else normal with a continuity correction."""
    own = d[d != 0]
    n = len(own)
    if not n:
        return math.nan, math.nan
    ranks = average_ranks(np.abs(own))
    v = float(ranks[own > 0].sum())
    if n < 50 and n == len(d) and len(np.unique(ranks)) == n:
        ways = np.zeros(n * (n + 1) // 2 + 1)
        ways[0] = 1
        for r in range(1, n + 1):
            ways[r:] = ways[r:] + ways[:-r]
        chance = ways / ways.sum()
        return v, min(1.0, 2 * float(min(chance[: int(v) + 1].sum(), chance[int(v) :].sum())))
    _, counts = np.unique(ranks, return_counts=True)
    z, sigma = v - n * (n + 1) / 4, math.sqrt(n * (n + 1) * (2 * n + 1) / 24 - (counts**3 - counts).sum() / 48)
    return v, float(normal_two_sided((z - math.copysign(0.5, z) * (z != 0)) / sigma)) if sigma else math.nan


def cucconi_statistic(ranks: np.ndarray, n: int) -> float:
    total = len(ranks)
    m, r = total - n, ranks[:n]
    den = math.sqrt(n * m * (total + 1) * (2 * total + 1) * (8 * total + 11) / 5)
    u = (6 * (r**2).sum() - n * (total + 1) * (2 * total + 1)) / den
    v = (6 * ((total + 1 - r) ** 2).sum() - n * (total + 1) * (2 * total + 1)) / den
    rho = 2 * (total**2 - 4) / ((2 * total + 1) * (8 * total + 11)) - 1
    return (u * u + v * v - 2 * rho * u * v) / (2 * (1 - rho * rho))


def permuted(statistic, ranks: np.ndarray, n: int, draws: int, seed: int) -> float:
    """Share of splits whose statistic is as large or larger: of all splits if they are no more than `draws`, else of random ones."""
    own = statistic(ranks, n)
    if math.comb(len(ranks), n) <= draws:
        every = np.arange(len(ranks))
        splits = (np.concatenate([ranks[list(c)], ranks[np.setdiff1d(every, c)]]) for c in combinations(range(len(ranks)), n))
        return float(np.mean([statistic(x, n) >= own - 1e-12 for x in splits]))
    rng = np.random.default_rng(seed)
    return sum(statistic(rng.permutation(ranks), n) >= own - 1e-12 for _ in range(draws)) / draws


def cucconi(x: np.ndarray, y: np.ndarray, draws: int = 2000, seed: int = 1) -> tuple[float, float]:
    if not len(x) or not len(y) or len(x) + len(y) < 3:
        return math.nan, math.nan
    ranks = average_ranks(np.concatenate([x, y]))
    return cucconi_statistic(ranks, len(x)), permuted(cucconi_statistic, ranks, len(x), draws, seed)


def lepage_statistic(ranks: np.ndarray, n: int) -> float:
    total = len(ranks)
    m = total - n
    w, scores = ranks[:n].sum(), np.minimum(ranks, total - ranks + 1)
    var_w, var_a = n * m * ranks.var() / (total - 1), n * m * scores.var() / (total - 1)
    if not var_w or not var_a:
        return 0.0
    return float((w - n * ranks.mean()) ** 2 / var_w + (scores[:n].sum() - n * scores.mean()) ** 2 / var_a)


def lepage(x: np.ndarray, y: np.ndarray, draws: int = 2000, seed: int = 1) -> tuple[float, float]:
    if not len(x) or not len(y) or len(x) + len(y) < 3:
        return math.nan, math.nan
    ranks = average_ranks(np.concatenate([x, y]))
    return lepage_statistic(ranks, len(x)), permuted(lepage_statistic, ranks, len(x), draws, seed)


@lru_cache(32)
def _normal_range(groups: int, step: float = 0.01, reach: int = 1600) -> np.ndarray:
    """P(range of `groups` normal values <= r) for r on a lattice of `step`; the lattice of the integral is the same, so one table of the normal distribution serves all."""
    z = np.arange(-800, 801)
    cdf = 1 - 0.5 * _erfc(np.arange(-800 - reach, 801) * step / math.sqrt(2))
    density = np.exp(-((z * step) ** 2) / 2) / math.sqrt(2 * math.pi)
    own = cdf[z + 800 + reach]
    return np.array([groups * np.trapezoid(density * np.maximum(own - cdf[z + 800 + reach - r], 0) ** (groups - 1), dx=step) for r in range(reach + 1)])


def tukey_upper(q: np.ndarray, groups: np.ndarray, df: np.ndarray) -> np.ndarray:
    """Upper tail of the studentised range: the range's distribution, tabulated once for each number of groups, averaged over the spread."""
    q, groups, df = np.broadcast_arrays(np.asarray(q, float), np.asarray(groups), np.asarray(df, float))
    nodes, weights = np.polynomial.legendre.leggauss(200)
    out = np.where(np.isnan(q), np.nan, 1.0)
    for k, d in {(int(k), float(d)) for k, d in zip(groups, df, strict=True) if d > 0}:
        rows = np.flatnonzero((groups == k) & (df == d) & (q > 0))
        low, high = max(1e-6, 1 - 9 / math.sqrt(2 * d)), 1 + 9 / math.sqrt(2 * d)
        s = low + (nodes + 1) * (high - low) / 2
        density = np.exp(d / 2 * math.log(d / 2) - math.lgamma(d / 2) + math.log(2) + (d - 1) * np.log(s) - d * s * s / 2) * weights * (high - low) / 2
        table = _normal_range(k)
        for at in range(0, len(rows), 10_000):
            part = rows[at : at + 10_000]
            below = np.interp(q[part, None] * s * 100, np.arange(len(table)), table)
            out[part] = np.clip(1 - below @ density, 0, 1)
    return out
