"""Gamma-Gamma: expected average profit per purchase from the repeat purchases.

``count`` names the column with the number of purchases that ``m`` averages:
``x`` by default, ``m_count`` for a summary made with ``include_first``.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopworth.functions.models import GgParams, mean_value, value_loglik
from shopworth.functions.special import digamma, log_gamma, trigamma
from shopworth.operators.bgnbd import PENALTIES
from shopworth.operators.maximum import Certificate, Evaluation, Maximum, Penalty, Trial, certify, maximise

GG_BOUNDS = ((1e-3, 1e4), (1e-3, 1e4))
# Centre of the priors for values divided by their mean: p v / (q - 1) = 1.
GG_CENTRE = (2.0, 3.0, 1.0)


def _repeat(summary: DataFrame, count: str) -> DataFrame:
    """Customers with repeat purchases and a mean value, the same for check, likelihood and fit."""
    return summary.filter((F.col(count) > 0) & (F.col("m") > 0))


def gg_check(summary: DataFrame, count: str = "x") -> DataFrame:
    """Correlation of purchase count and mean value; the model assumes none."""
    repeat = _repeat(summary, count)
    return repeat.agg(F.count("*").alias("customers"), F.corr(count, "m").alias("correlation"))


def gg_loglik(summary: DataFrame, params: GgParams, count: str = "x") -> DataFrame:
    """One row: customers with repeat purchases and their total log-likelihood."""
    repeat = _repeat(summary, count)
    return repeat.agg(
        F.count("*").alias("customers"),
        F.sum(value_loglik(F.col(count), F.col("m"), params)).alias("loglik"),
    )


class _Likelihood:
    """Log-likelihood, gradient and Hessian as aggregates over all customers.

    The gamma functions depend on ``x`` alone and run on the few distinct counts;
    the pass over all customers takes only logarithms and powers of ``x m + v``.
    The expressions name the parameters as columns and are built once; an
    evaluation only sets those columns to constants, which Spark folds in.
    """

    def __init__(self, values: DataFrame, counts: DataFrame):
        self.values, self.counts = values, counts
        p, q = F.col("_p"), F.col("_q")
        x, m = F.col("x"), F.col("m")
        self.fixed = values.agg(
            F.count("*").alias("n"),
            F.sum(F.ln(m)).alias("log_m"),
            F.sum(x * F.ln(m)).alias("x_log_m"),
            F.sum(x * F.ln(x)).alias("x_log_x"),
        ).first()
        reach = x * m + F.col("_v")
        self.terms = {"log_reach": F.ln(reach), "inverse": 1 / reach}
        log_reach, inverse = F.col("log_reach"), F.col("inverse")
        self.sums = [
            F.sum(log_reach).alias("log_reach"),
            F.sum(x * log_reach).alias("x_log_reach"),
            F.sum(inverse).alias("inverse"),
            F.sum(x * inverse).alias("x_inverse"),
            F.sum(inverse * inverse).alias("inverse2"),
            F.sum(x * inverse * inverse).alias("x_inverse2"),
        ]
        # A gamma function of every shape, with its sign and slopes by p and q.
        weight = F.col("customers")

        def shape(z: Column, sign: Column, by_p: Column, by_q: int) -> Column:
            named = {"z": z, "w": sign, "by_p": by_p.cast("double"), "by_q": F.lit(float(by_q))}
            return F.struct(*[column.alias(name) for name, column in named.items()])

        self.shapes = F.array(
            shape(p * x + q, weight, x, 1),
            shape(p * x, -weight, x, 0),
            shape(q, -weight, F.lit(0), 1),
        )
        z, w, by_p, by_q = (F.col(name) for name in ("z", "w", "by_p", "by_q"))
        self.gammas = {"g": w * log_gamma(z), "d": w * digamma(z), "t": w * trigamma(z)}
        slope, curve = F.col("d"), F.col("t")
        self.count_sums = [
            F.sum("g").alias("value"),
            F.sum(by_p * slope).alias("p"),
            F.sum(by_q * slope).alias("q"),
            F.sum(by_p * by_p * curve).alias("p_p"),
            F.sum(by_p * by_q * curve).alias("p_q"),
            F.sum(by_q * by_q * curve).alias("q_q"),
        ]

    def __call__(self, theta: Sequence[float]) -> Evaluation:
        p, q, v = theta
        constants = {"_p": F.lit(p), "_q": F.lit(q), "_v": F.lit(v)}
        # Both one-row sums in one job.
        sums = self.values.withColumns(constants).withColumns(self.terms).agg(*self.sums)
        shapes = self.counts.withColumns(constants).select(F.inline(self.shapes))
        more = shapes.withColumns(self.gammas).agg(*self.count_sums)
        packed = [df.select(F.array(*df.columns)) for df in (sums, more)]
        s, g = (
            dict(zip(df.columns, values[0]))
            for df, values in zip((sums, more), packed[0].union(packed[1]).collect())
        )
        fixed = self.fixed
        n, log_v = fixed["n"], float(np.log(v))
        repeats = p * (fixed["x_log_m"] + fixed["x_log_x"] - s["x_log_reach"]) - fixed["log_m"]
        value = g["value"] + q * (n * log_v - s["log_reach"]) + repeats
        gradient = [
            g["p"] + fixed["x_log_m"] + fixed["x_log_x"] - s["x_log_reach"],
            g["q"] + n * log_v - s["log_reach"],
            q * n / v - p * s["x_inverse"] - q * s["inverse"],
        ]
        p_v, q_v = -s["x_inverse"], n / v - s["inverse"]
        v_v = p * s["x_inverse2"] + q * s["inverse2"] - q * n / v**2
        hessian = [[g["p_p"], g["p_q"], p_v], [g["p_q"], g["q_q"], q_v], [p_v, q_v, v_v]]
        return Evaluation(value, np.array(gradient), np.array(hessian))


def gg_slopes(summary: DataFrame, params: GgParams, count: str = "x") -> Evaluation:
    """Log-likelihood, gradient and curvature at given parameters."""
    values = _repeat(summary, count).select(F.col(count).alias("x"), "m")
    counts = values.groupBy("x").agg(F.count("*").alias("customers"))
    return _Likelihood(values, counts)(params)


def gg_fit(
    summary: DataFrame,
    bounds: Sequence[tuple[float, float]] = GG_BOUNDS,
    count: str = "x",
    penalty: float = 0.0,
    start: Sequence[float] | None = None,
) -> Maximum:
    """Fit ``p, q, v``; every step aggregates all customers with repeat purchases.

    ``bounds`` are those of ``p`` and ``q``. Values are divided by their mean, so
    that ``v`` fits in range whatever the currency, and ``v`` is scaled back. ``penalty``
    is the weight of normal priors on the logarithms of the parameters, about values
    whose mean is that of the data.
    """
    with _fitting(summary, count) as (likelihood, scale):
        begin = [1.0, 2.0, 1.0] if start is None else [start[0], start[1], start[2] / scale]
        found = maximise(likelihood, begin, _with_v(bounds), penalty=Penalty(penalty, GG_CENTRE))
    p, q, v = found.theta
    # The density of a mean changes by the factor 1/scale with the unit of money.
    value = found.value - likelihood.fixed["n"] * float(np.log(scale))
    return found._replace(theta=[p, q, v * scale], value=value)


def gg_certificate(
    summary: DataFrame,
    fit: Maximum,
    bounds: Sequence[tuple[float, float]] = GG_BOUNDS,
    count: str = "x",
) -> Certificate:
    """Whether ``fit``, with its penalty, is a maximum on ``summary``; seven aggregates over all customers.

    As in the fit, values are divided by their mean, and ``v`` is scaled back.
    """
    with _fitting(summary, count) as (likelihood, scale):
        p, q, v = fit.theta
        prior = Penalty(fit.penalty, GG_CENTRE)
        found = certify(likelihood, GgParams._fields, [p, q, v / scale], _with_v(bounds), prior)
    loglik = found.loglik - likelihood.fixed["n"] * float(np.log(scale))
    return found._replace(checks=[*found.checks[:2], found.checks[2]._replace(value=v)], loglik=loglik)


def _with_v(bounds: Sequence[tuple[float, float]]) -> list[tuple[float, float]]:
    """The bounds of ``p`` and ``q``, and those of ``v`` for values divided by their mean."""
    top = bounds[0][1] * bounds[1][1]
    return [*bounds, (1 / top, top)]


@contextmanager
def _fitting(summary: DataFrame, count: str) -> Iterator[tuple[_Likelihood, float]]:
    """The likelihood over values divided by their mean, which stay on the executors, and that mean."""
    repeat = _repeat(summary, count).select(F.col(count).alias("x"), "m")
    scale = repeat.agg(F.avg("m")).first()[0]
    if scale is None:
        raise ValueError("no customers with repeat purchases to fit")
    values = repeat.select("x", (F.col("m") / scale).alias("m")).persist()
    try:
        counts = values.groupBy("x").agg(F.count("*").alias("customers")).persist()
        try:
            yield _Likelihood(values, counts), scale
        finally:
            counts.unpersist()
    finally:
        values.unpersist()


def gg_penalties(
    summary: DataFrame,
    weights: Sequence[float] = PENALTIES,
    id: str = "customer_id",
    bounds: Sequence[tuple[float, float]] = GG_BOUNDS,
    count: str = "x",
) -> list[Trial]:
    """For each weight, a fit on half of the customers and the likelihood of the other half."""
    half = F.abs(F.hash(F.lit("half"), F.col(id))) % 2
    taught, held = (summary.where(half == i) for i in (0, 1))
    trials, start = [], None
    for weight in sorted(weights, reverse=True):
        fit = gg_fit(taught, bounds, count, weight, start if weight else None)
        start = fit.theta
        trials.append(Trial(weight, fit, gg_loglik(held, GgParams(*fit.theta), count).first()["loglik"]))
    return trials


def gg_expected(summary: DataFrame, params: GgParams, count: str = "x") -> DataFrame:
    """Add the expected mean value of a customer's purchases."""
    return summary.withColumn(
        "expected_average_profit", mean_value(F.col(count), F.col("m"), params)
    )
