"""Quantiles of Student's distribution, as numbers and as columns."""

from __future__ import annotations

import functools
import math
from statistics import NormalDist

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Degrees of freedom up to which quantiles are tabulated; beyond, the expansion in their inverse is good to ten digits.
TABLE = 200


def _beta_fraction(a: float, b: float, x: float) -> float:
    """The continued fraction of the incomplete beta function, by Lentz's method."""
    tiny = 1e-300
    c, d = 1.0, 1 - (a + b) * x / (a + 1)
    d = 1 / (d if abs(d) > tiny else tiny)
    total = d
    for m in range(1, 10_000):
        step = total
        for top in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d, c = 1 + top * d, 1 + top / c
            d, c = 1 / (d if abs(d) > tiny else tiny), (c if abs(c) > tiny else tiny)
            total *= d * c
        if abs(total - step) <= 1e-16 * abs(total):
            break
    return total


def log_tail(t: float, df: int) -> tuple[float, float]:
    """Logarithm of the probability of more than t in size, and its slope in log t."""
    a, b = df / 2, 0.5
    x, y = df / (df + t * t), t * t / (df + t * t)
    scale = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log(y)
    if x < (a + 1) / (a + b + 2):
        tail = scale - math.log(a) + math.log(_beta_fraction(a, b, x))
    else:
        tail = math.log1p(-math.exp(scale - math.log(b)) * _beta_fraction(b, a, y))
    # the density times 2 t over the tail
    density = math.lgamma((df + 1) / 2) - math.lgamma(df / 2) - 0.5 * math.log(df * math.pi) - (df + 1) / 2 * math.log1p(t * t / df)
    return tail, -2 * math.exp(density + math.log(t) - tail)


@functools.lru_cache(maxsize=65536)
def t_quantile(level: float, df: int) -> float:
    """Two-sided quantile: the t that a share ``level`` does not exceed in size.

    The tail's logarithm is a concave function of log t, so Newton's steps on it come from the right after the first.
    """
    if df == 1:
        return math.tan(math.pi * level / 2)
    goal = math.log1p(-level)
    u = math.log(NormalDist().inv_cdf((1 + level) / 2))
    for _ in range(60):
        tail, slope = log_tail(math.exp(u), df)
        step = (tail - goal) / slope
        u -= step
        if abs(step) < 1e-14:
            break
    return math.exp(u)


def expanded_quantile(z: Column, df: Column) -> Column:
    """The quantile from that of the normal distribution, z, by four terms of the expansion in 1 / df (published coefficients)."""
    z2 = z * z
    g1 = z * (z2 + 1) / 4
    g2 = z * ((5 * z2 + 16) * z2 + 3) / 96
    g3 = z * (((3 * z2 + 19) * z2 + 17) * z2 - 15) / 384
    g4 = z * ((((79 * z2 + 776) * z2 + 1482) * z2 - 1920) * z2 - 945) / 92160
    r = 1 / df.cast("double")
    return z + r * (g1 + r * (g2 + r * (g3 + r * g4)))


def critical_values(levels: tuple[float, ...], n: Column) -> Column:
    """Array of (level, t) for n values, n - 1 degrees of freedom (I7); null under two values.

    A fixed table up to ``TABLE`` degrees of freedom, the expansion beyond: no job, and nothing that grows with the number of dates.
    """
    df = n - 1
    each = []
    for level in levels:
        known = F.array(*(F.lit(t_quantile(level, k)) for k in range(1, TABLE + 1)))
        z = F.lit(NormalDist().inv_cdf((1 + level) / 2))
        each.append(F.struct(F.lit(level).alias("level"), F.when(df <= TABLE, F.get(known, (df - 1).cast("int"))).otherwise(expanded_quantile(z, df)).alias("t")))
    return F.when(n >= 2, F.array(*each))
