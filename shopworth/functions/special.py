"""Special functions that Spark SQL lacks, as column expressions.

The gamma family uses the asymptotic series after shifting the argument up by
eight, so every term stays inside generated code.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

_SHIFT = 8


def _product(columns: list[Column]) -> Column:
    result = columns[0]
    for column in columns[1:]:
        result = result * column
    return result


def log_gamma(z: Column) -> Column:
    """ln of the gamma function for ``z > 0``."""
    w = z + _SHIFT
    series = 1 / (12 * w) - 1 / (360 * w**3) + 1 / (1260 * w**5) - 1 / (1680 * w**7)
    stirling = (w - 0.5) * F.ln(w) - w + 0.5 * math.log(2 * math.pi) + series
    return stirling - F.ln(_product([z + i for i in range(_SHIFT)]))


def digamma(z: Column) -> Column:
    """First derivative of :func:`log_gamma`."""
    w = z + _SHIFT
    series = 1 / (12 * w**2) - 1 / (120 * w**4) + 1 / (252 * w**6) - 1 / (240 * w**8)
    return F.ln(w) - 0.5 / w - series - sum((1 / (z + i) for i in range(_SHIFT)), F.lit(0.0))


def trigamma(z: Column) -> Column:
    """Second derivative of :func:`log_gamma`."""
    w = z + _SHIFT
    series = 1 / (6 * w**3) - 1 / (30 * w**5) + 1 / (42 * w**7) - 1 / (30 * w**9)
    shifted = sum((1 / (z + i) ** 2 for i in range(_SHIFT)), F.lit(0.0))
    return 1 / w + 0.5 / w**2 + series + shifted


def softplus(u: Column) -> Column:
    """ln(1 + e^u) without overflow."""
    return F.greatest(u, F.lit(0.0)) + F.log1p(F.exp(-F.abs(u)))


def sigmoid(u: Column) -> Column:
    """1 / (1 + e^-u); an overflowing exponential gives the right limit 0."""
    return 1 / (1 + F.exp(-u))


def hyp2f1(a: Column, b: Column, c: Column, z: Column) -> Column:
    """Gauss hypergeometric series for ``0 <= z < 1``, nested from the last term inwards.

    The length is where the sum of the terms left out, which shrink like
    ``z^k * k^(a+b-c-1)``, falls below 1e-15. ``z`` is read once per term, so pass
    a column or lambda variable rather than a long expression.
    """
    decay = -F.ln(F.greatest(z, F.lit(1e-300)))
    growth = F.greatest(a + b - c - 1, F.lit(0.0))
    base = 34.54 / decay
    length = (34.54 - F.log1p(-z) + growth * F.ln(base + 10 * growth / decay + 1)) / decay + 10
    steps = F.sequence(F.ceil(length).cast("int"), F.lit(0), F.lit(-1))
    return F.aggregate(
        steps,
        F.lit(1.0),
        lambda tail, k: 1 + (a + k) * (b + k) / ((c + k) * (k + 1)) * z * tail,
    )
