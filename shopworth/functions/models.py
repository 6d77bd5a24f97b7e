"""The BG/NBD and Gamma-Gamma models as column expressions.

Published forms: Fader, Hardie and Lee, "Counting Your Customers the Easy Way",
Marketing Science 24(2), 2005; Fader and Hardie, "The Gamma-Gamma Model of
Monetary Value", 2013.

Names: ``x`` repeat purchases, ``tx`` time from first to last purchase, ``age``
time from first purchase to the cutoff, ``m`` mean repeat value. SQL ignores
case, so neither ``T`` nor ``t`` is used.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

from shopworth.functions.special import hyp2f1, log_gamma, sigmoid


class BgParams(NamedTuple):
    """BG/NBD parameters; ``alpha`` is in the time unit of the summary."""

    r: float
    alpha: float
    a: float
    b: float


class GgParams(NamedTuple):
    """Gamma-Gamma parameters; ``v`` is in the money unit of the summary."""

    p: float
    q: float
    v: float


def drop_out_logit(x: Column, tx: Column, age: Column, params: BgParams) -> Column:
    """Log odds of having dropped out, for customers with ``x > 0``."""
    r, alpha, a, b = params
    return F.ln(F.lit(a)) - F.ln(b + x - 1) + (r + x) * (F.ln(alpha + age) - F.ln(alpha + tx))


def alive(x: Column, tx: Column, age: Column, params: BgParams) -> Column:
    """Probability that the customer is still buying; 1 without repeat purchases."""
    return F.when(x > 0, sigmoid(-drop_out_logit(x, tx, age, params))).otherwise(F.lit(1.0))


def off_singular(params: BgParams) -> BgParams:
    """Step off ``a = 1`` and ``a + b = 1``, where the formula divides by zero."""
    if abs(params.a - 1) < 1e-9:
        params = params._replace(a=1 + 1e-9)
    if abs(params.a + params.b - 1) < 1e-9:
        params = params._replace(b=params.b + 1e-9)
    return params


def horizon_share(age: Column, horizon: Column, params: BgParams) -> Column:
    """Argument of the series: the horizon's share of all time seen and projected."""
    return horizon / (params.alpha + age + horizon)


def expected_if_alive(x: Column, z: Column, params: BgParams) -> Column:
    """Expected purchases of a customer known to be alive, from ``horizon_share``.

    Euler's transformation of the published form: its terms shrink for any ``x``,
    whereas those of the direct series grow before they shrink.
    """
    r, _, a, b = off_singular(params)
    series = hyp2f1(F.lit(a + b - 1 - r), F.lit(a - 1), a + b - 1 + x, z)
    return (a + b - 1 + x) / (a - 1) * (1 - F.pow(1 - z, F.lit(a - 1)) * series)


def mean_value(x: Column, m: Column, params: GgParams) -> Column:
    """Expected mean purchase value; NULL where ``q <= 1`` leaves it undefined."""
    p, q, v = params
    if q <= 1:
        return F.lit(None).cast("double")
    return F.when(x > 0, p * (v + x * m) / (p * x + q - 1)).otherwise(F.lit(p * v / (q - 1)))


def value_loglik(x: Column, m: Column, params: GgParams) -> Column:
    """Gamma-Gamma log-likelihood of one customer with ``x > 0``."""
    p, q, v = params
    shape = p * x
    return (
        log_gamma(shape + q)
        - log_gamma(shape)
        - log_gamma(F.lit(q))
        + q * F.ln(F.lit(v))
        + (shape - 1) * F.ln(m)
        + shape * F.ln(x)
        - (shape + q) * F.ln(x * m + v)
    )
