"""Certificates of fits: what they accept, what they refuse, and their figures by plain sums."""

import math

import numpy as np
import pytest

from shopworth.functions.models import BgParams, GgParams
from shopworth.operators import bgnbd, gammagamma
from shopworth.operators.maximum import Evaluation, Penalty, certify

FREE = Penalty(0.0, [1.0, 1.0])
WIDE = [(1e-3, 1e3), (1e-3, 1e3)]


def hill(peak, bend=1.0):
    """A likelihood whose logarithm is a paraboloid in the logarithms of two parameters."""

    def evaluate(theta):
        theta = np.array(theta)
        away = np.log(theta) - np.log(peak)
        slope, curve = -2 * away, np.diag([-2.0, -2.0 * bend])
        slope[1] *= bend
        # by the parameters themselves
        gradient = slope / theta
        hessian = curve / np.outer(theta, theta) - np.diag(slope / theta**2)
        return Evaluation(-10.0 - away[0] ** 2 - bend * away[1] ** 2, gradient, hessian)

    return evaluate


def test_a_peak_is_certified():
    found = certify(hill([2.0, 3.0]), ["a", "b"], [2.0, 3.0], WIDE, FREE)
    assert found.certified and found.loglik == -10 and found.steepest == pytest.approx(-2)
    assert [c.bound for c in found.checks] == ["inner", "inner"]
    assert found.checks[0].above == pytest.approx(math.log(1.01) ** 2)
    assert found.checks[0].below == pytest.approx(math.log(0.99) ** 2)


def test_beside_the_peak_is_not():
    found = certify(hill([2.0, 3.0]), ["a", "b"], [2.0, 3.01], WIDE, FREE)
    assert not found.certified and found.gain == pytest.approx(math.log(3.01 / 3) ** 2)


def test_a_saddle_is_not():
    found = certify(hill([2.0, 3.0], bend=-1.0), ["a", "b"], [2.0, 3.0], WIDE, FREE)
    assert not found.certified and found.steepest == pytest.approx(2)


def test_a_bound_must_hold_its_parameter():
    bounds = [(1e-3, 1e3), (1e-3, 2.0)]
    held = certify(hill([2.0, 3.0]), ["a", "b"], [2.0, 2.0], bounds, FREE)
    assert held.certified and (held.checks[1].bound, held.checks[1].pushed, held.checks[1].above) == ("high", True, None)
    loose = certify(hill([2.0, 1.0]), ["a", "b"], [2.0, 2.0], bounds, FREE)
    assert not loose.certified and not loose.checks[1].pushed


def test_a_penalty_moves_the_peak():
    prior = Penalty(2.0, [1.0, 1.0])  # as steep as the hill: half way in logarithms
    found = certify(hill([4.0, 9.0]), ["a", "b"], [2.0, 3.0], WIDE, prior)
    assert found.certified and found.steepest == pytest.approx(-4)
    assert not certify(hill([4.0, 9.0]), ["a", "b"], [4.0, 9.0], WIDE, prior).certified


@pytest.fixture(scope="module")
def customers(spark):
    """Histories with a spread of rates, early leavers and values."""
    rng = np.random.default_rng(8)
    rows = []
    for i in range(3000):
        rate, leave, age = rng.gamma(0.6, 0.25), rng.beta(0.8, 2.4), int(rng.integers(150, 300))
        clock, x, last = 0.0, 0, 0
        while True:
            clock += rng.exponential(7 / rate) if rate > 1e-6 else math.inf
            if clock > age:
                break
            x, last = x + 1, max(1, int(clock))
            if rng.random() < leave:
                break
        m = float(rng.gamma(6.0 * x, 1 / (rng.gamma(3.7, 1 / 15.0) * x))) if x else None
        rows.append((i, x, last, age, m))
    df = spark.createDataFrame(rows, "customer_id long, x long, tx_days int, age_days int, m double")
    df = df.selectExpr("*", "tx_days / 7D AS tx", "age_days / 7D AS age").persist()
    yield rows, df
    df.unpersist()


def plain_purchases(rows, theta):
    r, alpha, a, b = theta
    total = 0.0
    for _, x, tx, age, _ in rows:
        total += math.lgamma(r + x) - math.lgamma(r) + r * math.log(alpha)
        total += math.lgamma(b + x) - math.lgamma(a + b + x) - math.lgamma(b) + math.lgamma(a + b)
        alive = -(r + x) * math.log(alpha + age / 7)
        if x:
            alive += math.log1p(math.exp(math.log(a / (b + x - 1)) - (r + x) * math.log(alpha + tx / 7) - alive))
        total += alive
    return total


def plain_values(rows, theta):
    p, q, v = theta
    return sum(
        math.lgamma(p * x + q) - math.lgamma(p * x) - math.lgamma(q) + q * math.log(v)
        + (p * x - 1) * math.log(m) + p * x * math.log(x) - (p * x + q) * math.log(x * m + v)
        for _, x, _, _, m in rows if x
    )


def against_plain(found, rows, plain):
    theta = [c.value for c in found.checks]
    best = plain(rows, theta)
    assert found.loglik == pytest.approx(best, rel=1e-10)
    for i, check in enumerate(found.checks):
        for step, loss in ((0.99, check.below), (1.01, check.above)):
            moved = [t * step if i == j else t for j, t in enumerate(theta)]
            assert loss > 0 and loss == pytest.approx(best - plain(rows, moved), rel=1e-3, abs=1e-7)


def test_purchases(customers):
    rows, df = customers
    stats = bgnbd.bg_stats(df)
    fit = bgnbd.bg_fit(stats)
    found = bgnbd.bg_certificate(stats, fit)
    assert found.certified and not fit.at_bound and [c.parameter for c in found.checks] == list(BgParams._fields)
    against_plain(found, rows, plain_purchases)
    off = fit._replace(theta=[fit.theta[0] * 1.02, *fit.theta[1:]])
    assert not bgnbd.bg_certificate(stats, off).certified
    held = bgnbd.bg_fit(stats, penalty=3.0)
    assert bgnbd.bg_certificate(stats, held).certified
    assert not bgnbd.bg_certificate(stats, held._replace(penalty=0.0)).certified


def test_values(customers):
    rows, df = customers
    fit = gammagamma.gg_fit(df)
    found = gammagamma.gg_certificate(df, fit)
    assert found.certified and [c.parameter for c in found.checks] == list(GgParams._fields)
    assert found.checks[2].value == fit.theta[2]
    against_plain(found, rows, plain_values)
    off = fit._replace(theta=[*fit.theta[:2], fit.theta[2] * 1.02])
    assert not gammagamma.gg_certificate(df, off).certified


def test_no_customers(customers):
    _, df = customers
    with pytest.raises(ValueError, match="no customers"):
        bgnbd.bg_certificate(bgnbd.bg_stats(df.where("false")), bgnbd.Maximum([1.0] * 4, 0.0, 1, True, False))
    with pytest.raises(ValueError, match="no customers"):
        gammagamma.gg_certificate(df.where("false"), bgnbd.Maximum([1.0] * 3, 0.0, 1, True, False))
