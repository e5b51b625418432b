"""Tail probabilities and quantiles for one scalar at a time (the end of a distributed test)."""

from __future__ import annotations

from math import erfc, exp, lgamma, log, log1p, sqrt


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function, evaluated from the front."""
    tiny = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    value = d
    for m in range(1, 10_000):
        for top in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 + top * d
            c = 1.0 + top / c
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = c if abs(c) > tiny else tiny
            value *= c * d
        if abs(c * d - 1.0) < 1e-16:
            break
    return value


def beta_inc(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function."""
    if x <= 0 or x >= 1:
        return 0.0 if x <= 0 else 1.0
    front = exp(lgamma(a + b) - lgamma(a) - lgamma(b) + a * log(x) + b * log1p(-x))
    if x < (a + 1) / (a + b + 2):
        return front * _beta_fraction(a, b, x) / a
    return 1.0 - front * _beta_fraction(b, a, 1 - x) / b


def gamma_upper(s: float, x: float) -> float:
    """Regularised upper incomplete gamma function."""
    if x <= 0:
        return 1.0
    front = exp(s * log(x) - x - lgamma(s))
    if x < s + 1:
        term = total = 1.0 / s
        k = s
        while abs(term) > abs(total) * 1e-17:
            k += 1
            term *= x / k
            total += term
        return max(0.0, 1.0 - front * total)
    b = x + 1 - s
    c, d = 1e300, 1.0 / b
    value = d
    for i in range(1, 10_000):
        a = -i * (i - s)
        b += 2
        d = 1.0 / (a * d + b)
        c = b + a / c
        value *= c * d
        if abs(c * d - 1) < 1e-16:
            break
    return front * value


def normal_tail(z: float) -> float:
    """P(Z > z)."""
    return 0.5 * erfc(z / sqrt(2))


def t_tail(t: float, dof: float) -> float:
    """P(T > t)."""
    half = 0.5 * beta_inc(dof / 2, 0.5, dof / (dof + t * t))
    return half if t >= 0 else 1.0 - half


def f_tail(f: float, d1: float, d2: float) -> float:
    """P(F > f)."""
    return beta_inc(d2 / 2, d1 / 2, d2 / (d2 + d1 * f)) if f > 0 else 1.0


def chi2_tail(x: float, dof: float) -> float:
    """P(X > x)."""
    return gamma_upper(dof / 2, x / 2)


def t_quantile(p: float, dof: float) -> float:
    """The t with P(T <= t) = p, by bisection."""
    lo, hi = -1.0, 1.0
    while t_tail(lo, dof) < 1 - p:
        lo *= 2
    while t_tail(hi, dof) > 1 - p:
        hi *= 2
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if t_tail(mid, dof) > 1 - p else (lo, mid)
    return (lo + hi) / 2


def fisher_two_sided(a: int, b: int, c: int, d: int) -> float:
    """Two-sided exact p of a 2x2 table: all tables with the same margins at most as likely as this one.

    Walks outwards from the mode until the terms vanish, so the cost grows with the spread, not the counts.
    """
    row, col, n = a + b, a + c, a + b + c + d
    low, high = max(0, col - (n - row)), min(row, col)

    def choose(m: int, k: int) -> float:
        return lgamma(m + 1) - lgamma(k + 1) - lgamma(m - k + 1)

    def weight(k: int) -> float:
        return choose(row, k) + choose(n - row, col - k) - choose(n, col)

    mode = min(max((row + 1) * (col + 1) // (n + 2), low), high)
    limit = weight(a) + 1e-7
    total = 0.0
    for first, last, step in ((mode, high + 1, 1), (mode - 1, low - 1, -1)):
        for k in range(first, last, step):
            w = weight(k)
            if w <= limit:
                total += exp(w)
                if exp(w) < total * 1e-18:
                    break
    return min(1.0, total)
