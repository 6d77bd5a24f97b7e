"""Predicted lifetime value from the two models."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from numbers import Integral

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopworth.functions.models import (
    BgParams,
    GgParams,
    alive,
    expected_if_alive,
    horizon_share,
    mean_value,
)
from shopworth.operators.bgnbd import per_history


def cltv(
    summary: DataFrame,
    bg: BgParams,
    gg: GgParams,
    periods: int | Sequence[int],
    discount: float = 0.0,
    margin: float = 1.0,
    count: str = "x",
) -> DataFrame:
    """Add ``expected_purchases``, ``expected_average_profit`` and ``cltv``.

    ``periods`` and ``discount`` are per model time unit. With several ``periods`` there is
    one row per customer and ``horizon``; all are worked out on the same distinct
    histories, which are joined once. Without discount only
    the whole horizon counts. With it, the gain of each period is discounted;
    summed by parts that is a weighted sum of the expectations at every period
    end, which a row works out by itself without a shuffle.
    """
    x, age = F.col("x"), F.col("age")
    several = not isinstance(periods, Integral)
    horizons = [int(h) for h in (periods if several else [periods])]

    def discounted(horizon: int) -> Column:
        factors = [(1 + discount) ** -k for k in range(1, horizon + 1)]
        weights = F.array(*[F.lit(f - g) for f, g in zip(factors, [*factors[1:], 0.0])])
        ends = F.transform(
            F.sequence(F.lit(1), F.lit(horizon)), lambda k: horizon_share(age, k.cast("double"), bg)
        )
        values = F.transform(ends, lambda z: expected_if_alive(x, z, bg))
        weighted = F.zip_with(values, weights, lambda value, weight: value * weight)
        return F.aggregate(weighted, F.lit(0.0), lambda total, part: total + part)

    def add(rows: DataFrame) -> DataFrame:
        # One horizon after the other as rows, so that each series is one expression.
        parts = []
        for horizon in horizons:
            part = rows.withColumn("horizon", F.lit(horizon))
            part = part.withColumn("_z", horizon_share(age, F.lit(float(horizon)), bg))
            part = part.withColumn("_if_alive", expected_if_alive(x, F.col("_z"), bg)).drop("_z")
            counted = F.col("_if_alive") if discount == 0 else discounted(horizon)
            parts.append(part.withColumn("_counted", counted))
        return reduce(DataFrame.union, parts) if several else parts[0].drop("horizon")

    p_alive = alive(x, F.col("tx"), age, bg)
    profit = F.col("expected_average_profit")
    return (
        per_history(summary, add)
        .withColumn("expected_purchases", F.col("_if_alive") * p_alive)
        .withColumn("expected_average_profit", mean_value(F.col(count), F.col("m"), gg))
        .withColumn("cltv", margin * profit * F.col("_counted") * p_alive)
        .drop("_if_alive", "_counted")
    )
