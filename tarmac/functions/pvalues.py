"""Tail probabilities of single test statistics (one number in, one number out)."""

from __future__ import annotations

import math


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function, by modified Lentz steps."""
    tiny = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    out = d
    for m in range(1, 10_000):
        for num in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 + num * d
            c = 1.0 + num / c
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = c if abs(c) > tiny else tiny
            step = c * d
            out *= step
        if abs(step - 1.0) < 1e-15:
            break
    return out


def beta_ratio(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function."""
    if x <= 0 or x >= 1:
        return float(x >= 1)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x))
    if x < (a + 1) / (a + b + 2):
        return front * _beta_fraction(a, b, x) / a
    return 1.0 - front * _beta_fraction(b, a, 1 - x) / b


def t_two_sided(t: float, df: float) -> float:
    return beta_ratio(df / 2, 0.5, df / (df + t * t))


def gamma_upper(a: float, x: float) -> float:
    """Regularised upper incomplete gamma function."""
    if x <= 0:
        return 1.0
    front = math.exp(-x + a * math.log(x) - math.lgamma(a))
    if x < a + 1:
        term = total = 1.0 / a
        k = a
        while abs(term) > abs(total) * 1e-16:
            k += 1
            term *= x / k
            total += term
        return 1.0 - total * front
    tiny = 1e-300
    b = x + 1 - a
    c, d = 1 / tiny, 1 / b
    out = d
    for i in range(1, 10_000):
        num = -i * (i - a)
        b += 2
        d = num * d + b
        d = 1 / (d if abs(d) > tiny else tiny)
        c = b + num / c
        c = c if abs(c) > tiny else tiny
        out *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return out * front


def chi2_upper(x: float, dof: int) -> float:
    return gamma_upper(dof / 2, x / 2)


def fisher_two_sided(a: int, b: int, c: int, d: int) -> float:
    """Two-sided p of a 2x2 table: all tables with the same margins that are at most as likely.

    Walks outwards from the most likely table and stops where terms no longer count, so the work grows with the spread
    of the table, not with its counts.
    """
    r1, r2, c1 = a + b, c + d, a + c
    n = r1 + r2
    low, high = max(0, c1 - r2), min(r1, c1)

    def choose(m: int, k: int) -> float:
        return math.lgamma(m + 1) - math.lgamma(k + 1) - math.lgamma(m - k + 1)

    base = choose(n, c1)

    def log_p(k: int) -> float:
        return choose(r1, k) + choose(r2, c1 - k) - base

    limit = log_p(a) + 1e-7
    mode = min(max((r1 + 1) * (c1 + 1) // (n + 2), low), high)
    total = 0.0
    for steps in (range(mode, high + 1), range(mode - 1, low - 1, -1)):
        for k in steps:
            lp = log_p(k)
            if lp <= limit:
                total += math.exp(lp)
                if lp < -745 or math.exp(lp) < total * 1e-18:
                    break
    return min(1.0, total)
