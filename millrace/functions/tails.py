"""Tail probabilities of the usual test distributions, for one-row-per-test results."""

from __future__ import annotations

import math

import numpy as np
from statistics import NormalDist


def normal_two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2.0))


def normal_quantile(p: float) -> float:
    return NormalDist().inv_cdf(p)


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function, evaluated by the modified Lentz scheme."""
    floor = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / (d if abs(d) > floor else floor)
    value = d
    for m in range(1, 500):
        for top in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 + top * d
            d = 1.0 / (d if abs(d) > floor else floor)
            c = 1.0 + top / c
            c = c if abs(c) > floor else floor
            value *= c * d
        if abs(c * d - 1.0) < 1e-16:
            break
    return value


def incomplete_beta(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function I_x(a, b)."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x))
    if x < (a + 1.0) / (a + b + 2.0):
        return front * _beta_fraction(a, b, x) / a
    return 1.0 - front * _beta_fraction(b, a, 1.0 - x) / b


def upper_gamma(s: float, x: float) -> float:
    """Regularised upper incomplete gamma function Q(s, x)."""
    if x <= 0.0:
        return 1.0
    front = math.exp(s * math.log(x) - x - math.lgamma(s))
    if x < s + 1.0:
        term = total = 1.0 / s
        k = s
        while abs(term) > abs(total) * 1e-17:
            k += 1.0
            term *= x / k
            total += term
        return max(0.0, 1.0 - front * total)
    floor = 1e-300
    b = x + 1.0 - s
    c, d = 1.0 / floor, 1.0 / b
    value = d
    for i in range(1, 1000):
        a = -i * (i - s)
        b += 2.0
        d = a * d + b
        d = 1.0 / (d if abs(d) > floor else floor)
        c = b + a / c
        c = c if abs(c) > floor else floor
        value *= c * d
        if abs(c * d - 1.0) < 1e-16:
            break
    return front * value


def student_two_sided(t: float, dof: float) -> float:
    return incomplete_beta(dof / 2.0, 0.5, dof / (dof + t * t))


def f_upper(f: float, d1: float, d2: float) -> float:
    if f <= 0:
        return 1.0
    return incomplete_beta(d2 / 2.0, d1 / 2.0, d2 / (d2 + d1 * f))


def chi2_upper(x: float, dof: float) -> float:
    return upper_gamma(dof / 2.0, x / 2.0)


def kolmogorov_upper(x: float) -> float:
    """Survival function of the limiting Kolmogorov distribution."""
    if x <= 0:
        return 1.0
    if x < 1.18:
        # theta-function dual, which converges fast for small arguments
        k = math.sqrt(2.0 * math.pi) / x
        total = sum(math.exp(-((2 * i - 1) ** 2) * math.pi**2 / (8.0 * x * x)) for i in range(1, 20))
        return max(0.0, min(1.0, 1.0 - k * total))
    total = sum((-1) ** (i - 1) * math.exp(-2.0 * i * i * x * x) for i in range(1, 101))
    return max(0.0, min(1.0, 2.0 * total))


def kolmogorov_exact(gap: float, n1: int, n2: int) -> float:
    """Chance that two samples of one continuous distribution differ by ``gap`` or more.

    The pooled order is a random path through an n1 x n2 lattice.  Its distribution walks from diagonal
    to diagonal, and what first reaches a point of that distance is added up and leaves: only positive
    terms, so that small chances stay precise.
    """
    n1, n2 = sorted((n1, n2))
    total, limit = n1 + n2, round(gap * n1 * n2)
    if limit <= 0:
        return 1.0
    first = np.arange(n1 + 1)
    mass, gone = np.zeros(n1 + 1), 0.0
    mass[0] = 1.0
    for step in range(total):
        left = total - step
        drawn = mass * (n1 - first) / left
        mass *= (n2 - (step - first)) / left
        mass[1:] += drawn[:-1]
        far = np.abs(first * total - (step + 1) * n1) >= limit
        gone += float(mass[far].sum())
        mass[far] = 0.0
    return min(1.0, gone)
