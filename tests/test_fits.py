"""Fits on simulated customers with known parameters, and their derivatives."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from shopworth.functions.models import BgParams, GgParams
from shopworth.operators.bgnbd import _in_units, _Likelihood, _repeat_counts, bg_fit, bg_loglik, bg_stats
from shopworth.operators.gammagamma import _Likelihood as ValueLikelihood
from shopworth.operators.gammagamma import gg_check, gg_fit, gg_loglik

BG = BgParams(r=0.243, alpha=4.414, a=0.793, b=2.426)
GG = GgParams(p=6.25, q=3.74, v=15.44)
CUSTOMERS = 20_000


@pytest.fixture(scope="module")
def simulated(spark):
    """Customers who buy at a gamma rate until a beta chance of leaving ends it."""
    rng = np.random.default_rng(42)
    age_days = rng.integers(27 * 7, 39 * 7, CUSTOMERS)
    rows = []
    for customer in range(CUSTOMERS):
        rate = rng.gamma(BG.r, 1 / BG.alpha)
        leave = rng.beta(BG.a, BG.b)
        clock, x, last = 0.0, 0, 0.0
        while rate > 0:
            clock += rng.exponential(1 / rate)
            if clock > age_days[customer] / 7:
                break
            x, last = x + 1, clock
            if rng.random() < leave:
                break
        nu = rng.gamma(GG.q, 1 / GG.v)
        mean = rng.gamma(GG.p * x, 1 / (nu * x)) if x else None
        tx_days = min(max(round(last * 7), 1 if x else 0), int(age_days[customer]))
        rows.append((customer, x, tx_days, int(age_days[customer]), mean))
    schema = "customer_id bigint, x bigint, tx_days int, age_days int, m double"
    df = spark.createDataFrame(rows, schema).repartition(4).persist()
    return df.withColumns({"tx": F.col("tx_days") / 7, "age": F.col("age_days") / 7})


def lgamma_loglik(rows, params):
    r, alpha, a, b = params
    total = 0.0
    for x, tx, age in rows:
        total += math.lgamma(r + x) - math.lgamma(r) + r * math.log(alpha)
        total += math.lgamma(b + x) - math.lgamma(a + b + x) - math.lgamma(b) + math.lgamma(a + b)
        first = -(r + x) * math.log(alpha + age)
        if x:
            second = math.log(a / (b + x - 1)) - (r + x) * math.log(alpha + tx)
            top = max(first, second)
            first = top + math.log(math.exp(first - top) + math.exp(second - top))
        total += first
    return total


def test_loglik_equals_gamma_functions(spark, simulated):
    rows = [(r["x"], r["tx"], r["age"]) for r in simulated.collect()]
    row = bg_loglik(bg_stats(simulated), BG).first()
    assert row["customers"] == CUSTOMERS
    assert row["loglik"] == pytest.approx(lgamma_loglik(rows, BG), rel=1e-10)


def _check_derivatives(evaluate, theta):
    at = evaluate(theta)
    for i in range(len(theta)):
        step = 1e-4 * theta[i]
        up, down = list(theta), list(theta)
        up[i] += step
        down[i] -= step
        above, below = evaluate(up), evaluate(down)
        assert at.gradient[i] == pytest.approx((above.value - below.value) / (2 * step), rel=1e-4, abs=1e-2)
        slopes = (above.gradient - below.gradient) / (2 * step)
        assert at.hessian[i] == pytest.approx(slopes, rel=1e-4, abs=1e-2)


def test_purchase_derivatives(simulated):
    stats = _in_units(bg_stats(simulated), 7).persist()
    repeats = _repeat_counts(stats).persist()
    likelihood = _Likelihood(stats, repeats)
    theta = [0.5, 3.0, 0.6, 1.7]
    assert likelihood(theta).value == pytest.approx(
        bg_loglik(bg_stats(simulated), BgParams(*theta)).first()["loglik"], rel=1e-12
    )
    _check_derivatives(likelihood, theta)


def test_value_derivatives(simulated):
    repeat = simulated.filter("x > 0").select("x", "m").persist()
    counts = repeat.groupBy("x").agg(F.count("*").alias("customers"))
    likelihood = ValueLikelihood(repeat, counts)
    theta = [3.0, 2.5, 20.0]
    assert likelihood(theta).value == pytest.approx(
        gg_loglik(simulated, GgParams(*theta)).first()["loglik"], rel=1e-10
    )
    _check_derivatives(likelihood, theta)


def test_purchase_fit_recovers_parameters(simulated):
    found = bg_fit(bg_stats(simulated))
    assert found.converged and not found.at_bound
    assert found.theta == pytest.approx(BG, rel=0.2)
    truth = bg_loglik(bg_stats(simulated), BG).first()["loglik"]
    assert truth < found.value < truth + 10
    for i in range(4):
        for factor in (0.98, 1.02):
            theta = list(found.theta)
            theta[i] *= factor
            moved = bg_loglik(bg_stats(simulated), BgParams(*theta)).first()["loglik"]
            assert moved < found.value


def test_value_fit_recovers_parameters(simulated):
    found = gg_fit(simulated)
    assert found.converged and not found.at_bound
    p, q, v = found.theta
    assert p * v / (q - 1) == pytest.approx(GG.p * GG.v / (GG.q - 1), rel=0.03)
    assert (p, q, v) == pytest.approx(GG, rel=0.35)
    assert found.value == pytest.approx(
        gg_loglik(simulated, GgParams(*found.theta)).first()["loglik"], rel=1e-9
    )


def test_value_fit_does_not_depend_on_the_currency(simulated):
    p, q, v = gg_fit(simulated).theta
    cents = simulated.withColumn("m", F.col("m") * 100)
    assert gg_fit(cents).theta == pytest.approx([p, q, 100 * v], rel=1e-4)


def test_count_and_value_are_independent(simulated):
    assert abs(gg_check(simulated).first()["correlation"]) < 0.05


def test_nothing_to_fit(spark):
    schema = "customer_id bigint, x bigint, tx_days int, age_days int, tx double, age double, m double"
    with pytest.raises(ValueError):
        bg_fit(bg_stats(spark.createDataFrame([], schema)))
    once = spark.createDataFrame([(1, 0, 0, 7, 0.0, 1.0, None)], schema)
    with pytest.raises(ValueError):
        gg_fit(once)
    assert bg_loglik(bg_stats(once), BG).first()["loglik"] < 0
