"""Whole analyses: one call from transactions to labelled customers.

Each reads the purchases once, pins the customer table and labels it from there.
"""

from __future__ import annotations

import warnings
from collections.abc import Sequence
from numbers import Integral
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopworth.functions.models import BgParams, GgParams
from shopworth.operators import predicted
from shopworth.operators.bgnbd import WEEK, bg_fit, bg_penalties, bg_stats, bg_summary, occasions
from shopworth.operators.descriptive import (
    customer_base,
    population,
    with_aov,
    with_clv,
    with_frequency,
    with_margin,
    with_value,
)
from shopworth.operators.gammagamma import gg_fit, gg_penalties
from shopworth.operators.maximum import Maximum, best_penalty
from shopworth.operators.rank import segment
from shopworth.operators.rfm import DEFAULT_RULES, rfm_metrics, rfm_scores, rfm_segments
from shopworth.sources.pinned import pin

LABELS = ("D", "C", "B", "A")


def _before(txn: DataFrame, cutoff) -> DataFrame:
    if cutoff is None:
        return txn
    return txn.filter(F.col("order_date") < F.lit(cutoff).cast("date"))


def clv(
    txn: DataFrame,
    rate: float = 0.10,
    labels: Sequence[str] = LABELS,
    cutoff=None,
    unique_orders: bool = False,
) -> DataFrame:
    """Descriptive lifetime value and segment of every customer."""
    base = pin(customer_base(_before(txn, cutoff), unique_orders))
    pop = population(base).first()
    valued = (
        base.transform(with_aov)
        .transform(with_frequency, pop)
        .transform(with_margin, rate)
        .transform(with_value)
        .transform(with_clv, pop)
    )
    return segment(valued, "clv", labels)


def rfm(
    txn: DataFrame,
    analysis_date=None,
    rules: Sequence[tuple[int, int, str]] = DEFAULT_RULES,
    k: int = 5,
    unique_orders: bool = False,
) -> DataFrame:
    """RFM metrics, scores and segment of every customer at ``analysis_date``.

    ``rules`` must name a segment for every pair of scores from 1 to ``k``.
    """
    if {(r, f) for r, f, _ in rules} != {(r, f) for r in range(1, k + 1) for f in range(1, k + 1)}:
        raise ValueError(f"rules must cover exactly the pairs of scores from 1 to {k}")
    metrics = rfm_metrics(_before(txn, analysis_date), analysis_date, unique_orders)
    return rfm_segments(rfm_scores(metrics, k), rules)


class Fits(NamedTuple):
    """Both models' fits, None where parameters were given or nothing can be fitted.

    ``reason`` says why there is no prediction, and is None where there is one.
    """

    bg: Maximum | None
    gg: Maximum | None
    reason: str | None


def fit_cltv(
    summary: DataFrame,
    bg: BgParams | None = None,
    gg: GgParams | None = None,
    unit: int = WEEK,
    count: str = "x",
    penalty: float | str = 0.0,
) -> Fits:
    """Fit the models whose parameters are not given; warn of fits not to be relied on.

    ``penalty`` is the weight of the priors, or ``"holdout"`` for the weight, one for each
    model, under which half of the customers are likeliest when the others are fitted.
    """
    repeats = summary.agg(
        F.count("*").alias("all"), F.count_if(F.col("x") > 0).alias("x"), F.count_if(F.col("m") > 0).alias("m")
    ).first()
    if not repeats["all"]:
        return Fits(None, None, "no customers")
    if (bg is None and not repeats["x"]) or (gg is None and not repeats["m"]):
        return Fits(None, None, "no repeat purchases to fit")
    chosen = penalty == "holdout"
    fits = Fits(None, None, None)
    if bg is None:
        weight = best_penalty(bg_penalties(summary, unit=unit)) if chosen else float(penalty)
        fits = fits._replace(bg=bg_fit(bg_stats(summary), unit=unit, penalty=weight))
    if gg is None:
        weight = best_penalty(gg_penalties(summary, count=count)) if chosen else float(penalty)
        fits = fits._replace(gg=gg_fit(summary, count=count, penalty=weight))
    for name, fit in (("purchase", fits.bg), ("value", fits.gg)):
        if fit is not None and not fit.converged:
            warnings.warn(f"the {name} model's fit did not converge", stacklevel=2)
        if fit is not None and fit.at_bound:
            warnings.warn(f"the {name} model's fit lies on a bound: the data have no inner maximum", stacklevel=2)
    q = gg.q if gg is not None else fits.gg.theta[1]
    return fits if q > 1 else fits._replace(reason="the mean purchase value is undefined (q <= 1)")


def fitted_cltv(
    txn: DataFrame,
    periods: int | Sequence[int],
    cutoff=None,
    discount: float = 0.0,
    margin: float = 1.0,
    bg: BgParams | None = None,
    gg: GgParams | None = None,
    labels: Sequence[str] = LABELS,
    unit: int = WEEK,
    include_first: bool = False,
    penalty: float | str = 0.0,
) -> tuple[DataFrame, Fits]:
    """Predicted lifetime value and segment of every customer, and the fits behind it.

    Models whose parameters are not given are fitted to the same purchases, once
    for all horizons. With several ``periods`` there is one row per customer and
    ``horizon``, with segments of their own. Where no prediction is possible the
    values are NULL and ``reason`` says why. ``penalty`` as in :func:`fit_cltv`.
    """
    summary = bg_summary(occasions(txn), cutoff, unit, include_first)
    count = "m_count" if include_first else "x"
    fits = fit_cltv(summary, bg, gg, unit, count, penalty)
    several = not isinstance(periods, Integral)
    horizons = [int(h) for h in periods] if several else None
    names = ("expected_purchases", "expected_average_profit", "cltv")
    if fits.reason and not (fits.bg or bg):
        valued = summary.withColumns({name: F.lit(None).cast("double") for name in names})
        if several:
            valued = valued.withColumn("horizon", F.explode(F.array(*[F.lit(h) for h in horizons])))
    else:
        purchase = bg or BgParams(*fits.bg.theta)
        value = gg or (GgParams(*fits.gg.theta) if fits.gg else GgParams(1.0, 1.0, 1.0))
        valued = predicted.cltv(summary, purchase, value, horizons or int(periods), discount, margin, count)
    columns = [*summary.columns, *names, F.lit(fits.reason).cast("string").alias("reason")]
    valued = pin(valued.select(*columns, *(["horizon"] if several else [])))
    if several:
        return segment(valued, "cltv", labels, by="horizon", groups=sorted(set(horizons))), fits
    return segment(valued, "cltv", labels), fits


def predict_cltv(txn: DataFrame, periods: int | Sequence[int], *args, **options) -> DataFrame:
    """The predictions of :func:`fitted_cltv` alone."""
    return fitted_cltv(txn, periods, *args, **options)[0]
