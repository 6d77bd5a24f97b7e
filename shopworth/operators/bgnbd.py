"""BG/NBD: expected purchases from the times of past ones.

A purchase occasion is a customer-day. Time is counted in whole days and divided
by ``unit`` (days per model time unit) where the model needs it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopworth.functions.models import (
    BgParams,
    alive,
    drop_out_logit,
    expected_if_alive,
    horizon_share,
)
from shopworth.functions.special import sigmoid, softplus
from shopworth.operators.maximum import Certificate, Evaluation, Maximum, Penalty, Trial, certify, maximise
from shopworth.operators.prepare import exact_sum, money_sum, significant
from shopworth.sources.pinned import pin

WEEK = 7
# Weights of the penalty that are tried; 0 is the plain fit.
PENALTIES = (30.0, 3.0, 0.3, 0.03, 0.003, 0.0)
BG_BOUNDS = ((1e-4, 1e4), (1e-4, 1e6), (1e-4, 1e4), (1e-4, 1e4))


def occasions(txn: DataFrame) -> DataFrame:
    """Merge the orders of one customer on one day.

    The grouping key includes the day, so a customer with very many orders is
    spread over as many keys as there are days.
    """
    return txn.groupBy("customer_id", "order_date").agg(
        money_sum(F.col("amount")).alias("amount")
    )


def bg_summary(
    occ: DataFrame, cutoff=None, unit: int = WEEK, include_first: bool = False
) -> DataFrame:
    """Per customer: repeat occasions ``x``, ``tx``, ``age`` and mean value ``m``.

    ``cutoff`` is exclusive and defaults to the day after the last occasion of
    all. The customer table is pinned: every model reads it several times.
    ``m`` averages the repeat occasions. ``include_first`` averages all of them
    and adds ``m_count``, the count to pass to Gamma-Gamma with that mean.
    """
    if cutoff is not None:
        occ = occ.filter(F.col("order_date") < F.lit(cutoff).cast("date"))
    history = occ.groupBy("customer_id").agg(
        F.count("*").alias("purchases"),
        F.min("order_date").alias("first_day"),
        F.max("order_date").alias("last_day"),
        exact_sum(F.col("amount")).alias("total"),
        F.min_by("amount", "order_date").alias("first_amount"),
    )
    history = pin(history)
    if cutoff is None:
        cutoff = history.agg(F.date_add(F.max("last_day"), 1)).first()[0]
    day = F.lit(cutoff).cast("date")
    x = F.col("purchases") - 1
    tx_days = F.date_diff("last_day", "first_day")
    age_days = F.date_diff(day, "first_day")
    repeat_amount = significant(F.col("total") - F.col("first_amount"), of=F.col("total"))
    values = [F.try_divide(repeat_amount, x).alias("m")]
    if include_first:
        mean = significant(F.col("total")) / F.col("purchases")
        values = [mean.alias("m"), F.col("purchases").alias("m_count")]
    return history.select(
        "customer_id",
        x.alias("x"),
        tx_days.alias("tx_days"),
        age_days.alias("age_days"),
        (tx_days / unit).alias("tx"),
        (age_days / unit).alias("age"),
        *values,
    )


def bg_stats(summary: DataFrame) -> DataFrame:
    """Customers per distinct history; the likelihood needs nothing else."""
    return summary.groupBy("x", "tx_days", "age_days").agg(F.count("*").alias("customers"))


def _repeat_counts(stats: DataFrame) -> DataFrame:
    """For ``i`` = 0, 1, ...: customers with more than ``i`` repeat purchases.

    At most one row per day of history, since an occasion is a customer-day.
    Sums over the purchases of every customer become sums over these rows.
    """
    by_count = stats.filter(F.col("x") > 0).groupBy("x").agg(F.sum("customers").alias("customers"))
    earlier = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("x") - 1)).alias("i")
    return (
        by_count.select(earlier, "customers")
        .groupBy("i")
        .agg(F.sum("customers").alias("customers"))
    )


def _in_units(stats: DataFrame, unit: int) -> DataFrame:
    return stats.select(
        "x",
        (F.col("tx_days") / unit).alias("tx"),
        (F.col("age_days") / unit).alias("age"),
        "customers",
    )


def _weighted(columns: dict[str, Column]) -> list[Column]:
    return [
        F.coalesce(F.sum(F.col("customers") * column), F.lit(0.0)).alias(name)
        for name, column in columns.items()
    ]


def _history_term(x: Column, tx: Column, age: Column, params: BgParams) -> Column:
    """The part of a customer's log-likelihood that depends on purchase times."""
    r, alpha, _, _ = params
    dropped = F.when(x > 0, softplus(drop_out_logit(x, tx, age, params))).otherwise(F.lit(0.0))
    return r * F.ln(F.lit(alpha)) - (r + x) * F.ln(alpha + age) + dropped


def _repeat_term(i: Column, params: BgParams) -> Column:
    """The part added by the purchase after ``i`` repeat purchases."""
    r, _, a, b = params
    return F.ln(r + i) + F.ln(b + i) - F.ln(a + b + i)


def bg_loglik(stats: DataFrame, params: BgParams, unit: int = WEEK) -> DataFrame:
    """One row: number of customers and their total log-likelihood.

    No gamma function is needed: ratios of gamma functions at whole distances are
    products, whose logarithms are summed over ``_repeat_counts``.
    """
    repeats = _repeat_counts(stats).agg(
        *_weighted({"loglik": _repeat_term(F.col("i"), params)})
    )
    histories = _in_units(stats, unit).agg(
        F.coalesce(F.sum("customers"), F.lit(0).cast("bigint")).alias("customers"),
        *_weighted({"loglik": _history_term(F.col("x"), F.col("tx"), F.col("age"), params)}),
    )
    return histories.select(
        "customers", (F.col("loglik") + repeats.select("loglik").scalar()).alias("loglik")
    )


class _Likelihood:
    """Log-likelihood, gradient and Hessian as aggregates over all histories.

    The expressions name the parameters as columns and are built once; an
    evaluation only sets those columns to constants, which Spark folds in.
    """

    def __init__(self, stats: DataFrame, repeats: DataFrame):
        self.stats, self.repeats = stats, repeats
        params = BgParams(*[F.col(f"_{name}") for name in BgParams._fields])
        r, alpha, a, b = params
        x, tx, age = F.col("x"), F.col("tx"), F.col("age")
        repeated = x > 0
        u = F.when(repeated, drop_out_logit(x, tx, age, params))
        end, last = 1 / (alpha + age), 1 / (alpha + tx)
        self.terms = {
            "u": u,
            "n": r + x,
            "log_end": F.ln(alpha + age),
            "end": end,
            "last": last,
            "u_r": F.ln(alpha + age) - F.ln(alpha + tx),
            "u_a": 1 / a,
            "u_b": F.when(repeated, -1 / (b + x - 1)).otherwise(F.lit(0.0)),
        }
        self.odds = {
            "s": F.coalesce(sigmoid(F.col("u")), F.lit(0.0)),
            "u_alpha": F.col("n") * (F.col("end") - F.col("last")),
        }
        s, n, end, last = F.col("s"), F.col("n"), F.col("end"), F.col("last")
        second = {
            "r_alpha": end - last,
            "alpha_alpha": n * (last**2 - end**2),
            "a_a": -F.col("u_a") ** 2,
            "b_b": F.col("u_b") ** 2,
        }
        plain = {
            "r": F.ln(alpha) - F.col("log_end"),
            "alpha": r / alpha - n * end,
            "r_alpha": 1 / alpha - end,
            "alpha_alpha": n * end**2 - r / alpha**2,
        }
        dropped = F.coalesce(softplus(F.col("u")), F.lit(0.0))
        sums = {"value": r * F.ln(alpha) - n * F.col("log_end") + dropped}
        names = BgParams._fields
        for i, p in enumerate(names):
            sums[p] = s * F.col(f"u_{p}") + plain.get(p, F.lit(0.0))
            for q in names[i:]:
                curve = s * (1 - s) * F.col(f"u_{p}") * F.col(f"u_{q}")
                if f"{p}_{q}" in second:
                    curve = curve + s * second[f"{p}_{q}"]
                sums[f"{p}_{q}"] = curve + plain.get(f"{p}_{q}", F.lit(0.0))
        self.sums = _weighted(sums)
        i = F.col("i")
        self.repeat_sums = _weighted(
            {
                "value": _repeat_term(i, params),
                "r": 1 / (r + i),
                "b": 1 / (b + i),
                "ab": 1 / (a + b + i),
                "r_r": -1 / (r + i) ** 2,
                "b_b": -1 / (b + i) ** 2,
                "ab_ab": 1 / (a + b + i) ** 2,
            }
        )

    def __call__(self, theta: Sequence[float]) -> Evaluation:
        names = BgParams._fields
        constants = {f"_{name}": F.lit(value) for name, value in zip(names, theta)}
        histories = self.stats.withColumns(constants).withColumns(self.terms)
        # Both one-row sums in one job.
        sums = histories.withColumns(self.odds).agg(*self.sums)
        more = self.repeats.withColumns(constants).agg(*self.repeat_sums)
        packed = [df.select(F.array(*df.columns)) for df in (sums, more)]
        row, extra = (
            dict(zip(df.columns, values[0]))
            for df, values in zip((sums, more), packed[0].union(packed[1]).collect())
        )
        gradient = np.array([row[p] for p in names])
        gradient += [extra["r"], 0.0, -extra["ab"], extra["b"] - extra["ab"]]
        hessian = np.zeros((4, 4))
        for i, p in enumerate(names):
            for j, q in enumerate(names[i:], i):
                hessian[i, j] = hessian[j, i] = row[f"{p}_{q}"]
        hessian[0, 0] += extra["r_r"]
        hessian[2:, 2:] += extra["ab_ab"]
        hessian[3, 3] += extra["b_b"]
        return Evaluation(row["value"] + extra["value"], gradient, hessian)


def bg_slopes(stats: DataFrame, params: BgParams, unit: int = WEEK) -> Evaluation:
    """Log-likelihood, gradient and curvature at given parameters."""
    histories = _in_units(stats, unit)
    return _Likelihood(histories, _repeat_counts(histories))(params)


def bg_fit(
    stats: DataFrame,
    bounds: Sequence[tuple[float, float]] = BG_BOUNDS,
    unit: int = WEEK,
    penalty: float = 0.0,
    start: Sequence[float] | None = None,
) -> Maximum:
    """Fit ``r, alpha, a, b``; every step aggregates all histories once.

    ``penalty`` is the weight of normal priors on the logarithms of the parameters,
    about the usual start: rates of one purchase in a quarter of the mean age.
    """
    with _fitting(stats, unit) as (likelihood, centre):
        return maximise(likelihood, start or centre, bounds, penalty=Penalty(penalty, centre))


def bg_certificate(
    stats: DataFrame,
    fit: Maximum,
    bounds: Sequence[tuple[float, float]] = BG_BOUNDS,
    unit: int = WEEK,
) -> Certificate:
    """Whether ``fit``, with its penalty, is a maximum on ``stats``; nine aggregates over all histories."""
    with _fitting(stats, unit) as (likelihood, centre):
        return certify(likelihood, BgParams._fields, fit.theta, bounds, Penalty(fit.penalty, centre))


@contextmanager
def _fitting(stats: DataFrame, unit: int) -> Iterator[tuple[_Likelihood, list[float]]]:
    """The likelihood over histories that stay on the executors, and the usual start."""
    histories = _in_units(stats, unit).persist()
    try:
        repeats = _repeat_counts(histories).persist()
        try:
            scale = histories.agg(
                F.sum(F.col("customers") * F.col("age")) / F.sum("customers")
            ).first()[0]
            if scale is None:
                raise ValueError("no customers to fit")
            yield _Likelihood(histories, repeats), [1.0, scale / 4, 0.8, 2.0]
        finally:
            repeats.unpersist()
    finally:
        histories.unpersist()


def bg_penalties(
    summary: DataFrame,
    weights: Sequence[float] = PENALTIES,
    id: str = "customer_id",
    bounds: Sequence[tuple[float, float]] = BG_BOUNDS,
    unit: int = WEEK,
) -> list[Trial]:
    """For each weight, a fit on half of the customers and the likelihood of the other half.

    Customers are halved by a hash of their id and only counted by history, so a trial
    costs what a fit does. Each fit starts where the one before ended. Weight 0 is
    the plain fit.
    """
    half = F.abs(F.hash(F.lit("half"), F.col(id))) % 2
    keys = ["x", "tx_days", "age_days"]
    halves = pin(summary.groupBy(half.alias("half"), *keys).agg(F.count("*").alias("customers")))
    taught, held = (halves.where(F.col("half") == i).drop("half") for i in (0, 1))
    trials, start = [], None
    for weight in sorted(weights, reverse=True):
        fit = bg_fit(taught, bounds, unit, weight, start if weight else None)
        start = fit.theta
        trials.append(Trial(weight, fit, bg_loglik(held, BgParams(*fit.theta), unit).first()["loglik"]))
    return trials


def bg_alive(summary: DataFrame, params: BgParams) -> DataFrame:
    """Add the probability that the customer is still buying."""
    return summary.withColumn(
        "p_alive", alive(F.col("x"), F.col("tx"), F.col("age"), params)
    )


def per_history(summary: DataFrame, add: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Add columns that depend on ``x`` and ``age`` alone, once per distinct pair.

    A billion customers share a few million pairs, and a pair costs a long series,
    so the pairs are spread over the cores. Adaptive execution sees how many there
    are and broadcasts or shuffles them; a pair that very many customers share can
    be split, as the pairs' side has one row of it per horizon.
    """
    pairs = summary.select("x", "age_days", "age").distinct()
    cores = summary.sparkSession.sparkContext.defaultParallelism
    shared = add(pairs.repartition(cores)).drop("age")
    added = [name for name in shared.columns if name not in ("x", "age_days")]
    return summary.join(shared, ["x", "age_days"]).select(*summary.columns, *added)


def bg_expected(summary: DataFrame, params: BgParams, horizons: Sequence[float]) -> DataFrame:
    """Expected purchases over each horizon, one row per customer and horizon."""
    x = F.col("x")

    def add(rows: DataFrame) -> DataFrame:
        lengths = F.array(*[F.lit(float(h)) for h in horizons])
        rows = rows.withColumn("horizon", F.explode(lengths))
        rows = rows.withColumn("_z", horizon_share(F.col("age"), F.col("horizon"), params))
        return rows.withColumn("_if_alive", expected_if_alive(x, F.col("_z"), params)).drop("_z")

    p_alive = alive(x, F.col("tx"), F.col("age"), params)
    rows = per_history(summary, add)
    return rows.withColumn("expected_purchases", F.col("_if_alive") * p_alive).drop("_if_alive")


def bg_total(expected: DataFrame) -> DataFrame:
    """Expected purchases of all customers per horizon."""
    return expected.groupBy("horizon").agg(
        F.count("*").alias("customers"),
        F.sum("expected_purchases").alias("expected_purchases"),
    )


def bg_holdout(
    occ: DataFrame, cutoff, horizon: float, params: BgParams, unit: int = WEEK
) -> DataFrame:
    """Predicted against actual occasions in the ``horizon`` after ``cutoff``, by ``x``.

    One aggregate splits each customer's occasions at the cutoff, so the two
    periods need no join.
    """
    day = F.lit(cutoff).cast("date")
    date = F.col("order_date")
    seen = date < day
    after = (date >= day) & (date < F.date_add(day, int(round(horizon * unit))))
    history = (
        occ.groupBy("customer_id")
        .agg(
            F.count_if(seen).alias("purchases"),
            F.min(F.when(seen, date)).alias("first_day"),
            F.max(F.when(seen, date)).alias("last_day"),
            F.count_if(after).alias("actual"),
        )
        .filter(F.col("purchases") > 0)
    )
    age_days = F.date_diff(day, "first_day")
    split = history.select(
        (F.col("purchases") - 1).alias("x"),
        (F.date_diff("last_day", "first_day") / unit).alias("tx"),
        age_days.alias("age_days"),
        (age_days / unit).alias("age"),
        "actual",
    )
    return bg_expected(pin(split), params, [horizon]).groupBy("x").agg(
        F.count("*").alias("customers"),
        F.sum("expected_purchases").alias("predicted"),
        F.sum("actual").alias("actual"),
    )
