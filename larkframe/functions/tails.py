"""Tail probabilities for test statistics. They run on one result row per test, never on data rows."""

from __future__ import annotations

import math


def _beta_fraction(a: float, b: float, x: float) -> float:
    # Continued fraction of the incomplete beta function, evaluated by Lentz's method.
    tiny = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, 500):
        for num in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 + num * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + num / c
            c = c if abs(c) > tiny else tiny
            h *= c * d
        if abs(c * d - 1) < 1e-15:
            break
    return h


def beta_cdf(a: float, b: float, x: float) -> float:
    if x <= 0:
        return 0.0
    if x >= 1:
        return 1.0
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x))
    if x < (a + 1) / (a + b + 2):
        return front * _beta_fraction(a, b, x) / a
    return 1.0 - front * _beta_fraction(b, a, 1 - x) / b


def t_two_sided(t: float, df: float) -> float:
    return beta_cdf(df / 2, 0.5, df / (df + t * t))


def f_upper(f: float, d1: float, d2: float) -> float:
    return beta_cdf(d2 / 2, d1 / 2, d2 / (d2 + d1 * f))


def chisq_upper(x: float, df: float) -> float:
    """Upper tail by the series of the lower incomplete gamma, or its continued fraction for large x."""
    a, z = df / 2, x / 2
    if z <= 0:
        return 1.0
    front = math.exp(-z + a * math.log(z) - math.lgamma(a))
    if z < a + 1:
        term = total = 1 / a
        k = a
        while abs(term) > abs(total) * 1e-16:
            k += 1
            term *= z / k
            total += term
        return 1 - total * front
    b, c = z + 1 - a, 1e300
    d = 1 / b
    h = d
    for i in range(1, 1000):
        an = -i * (i - a)
        b += 2
        d = 1 / (an * d + b)
        c = b + an / c
        h *= c * d
        if abs(c * d - 1) < 1e-15:
            break
    return front * h


def ks_upper(d: float, n: float, m: float) -> float:
    """Asymptotic two-sample Kolmogorov-Smirnov p-value."""
    lam = math.sqrt(n * m / (n + m)) * d
    if lam < 1e-6:
        return 1.0
    if lam < 1.0:  # theta-function form converges quickly for small arguments
        s = sum(math.exp(-((2 * k - 1) ** 2) * math.pi**2 / (8 * lam * lam)) for k in range(1, 20))
        return max(0.0, min(1.0, 1 - math.sqrt(2 * math.pi) / lam * s))
    return max(0.0, min(1.0, 2 * sum((-1) ** (k - 1) * math.exp(-2 * k * k * lam * lam) for k in range(1, 100))))


def normal_quantile(p: float) -> float:
    from statistics import NormalDist

    return NormalDist().inv_cdf(p)


def t_quantile(p: float, df: float) -> float:
    """Quantile for p > 0.5 by bisection on the two-sided tail."""
    lo, hi = 0.0, 1e3
    for _ in range(200):
        mid = (lo + hi) / 2
        if 1 - t_two_sided(mid, df) / 2 < p:
            lo = mid
        else:
            hi = mid
    return (lo + hi) / 2
