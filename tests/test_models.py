import math

import pytest
from pyspark.sql import functions as F

from shopworth.functions import special
from shopworth.functions.models import BgParams, GgParams, mean_value
from shopworth.operators.bgnbd import bg_alive, bg_expected, bg_holdout, bg_total, occasions
from shopworth.operators.gammagamma import gg_expected
from shopworth.operators.predicted import cltv

BG = BgParams(r=0.243, alpha=4.414, a=0.793, b=2.426)
GG = GgParams(p=6.25, q=3.74, v=15.44)


def summary_of(spark, rows):
    df = spark.createDataFrame(
        rows, "customer_id bigint, x bigint, tx double, age double, m double"
    )
    return df.withColumn("age_days", F.round(F.col("age") * 7).cast("int"))


def direct_expected(x, tx, age, horizon, params, terms=20_000):
    """The published series, summed term by term in plain Python."""
    r, alpha, a, b = params
    z = horizon / (alpha + age + horizon)
    term = total = 1.0
    for k in range(terms):
        term *= (r + x + k) * (b + x + k) / ((a + b + x - 1 + k) * (k + 1)) * z
        total += term
    top = (a + b + x - 1) / (a - 1) * (1 - (1 - z) ** (r + x) * total)
    if x == 0:
        return top
    odds = a / (b + x - 1) * ((alpha + age) / (alpha + tx)) ** (r + x)
    return top / (1 + odds)


@pytest.mark.parametrize("z", [0.01, 0.5, 1.0, 6.25, 300.0, 1e4])
def test_gamma_family(spark, z):
    step = 1e-4 * max(z, 1.0) if z > 0.1 else 1e-6
    row = spark.range(1).select(
        special.log_gamma(F.lit(z)).alias("g"),
        special.digamma(F.lit(z)).alias("d"),
        special.trigamma(F.lit(z)).alias("t"),
        special.digamma(F.lit(z + step)).alias("up"),
        special.digamma(F.lit(z - step)).alias("down"),
    ).first()
    slope = (math.lgamma(z + step) - math.lgamma(z - step)) / (2 * step)
    assert row["g"] == pytest.approx(math.lgamma(z), rel=4e-12, abs=4e-12)
    assert row["d"] == pytest.approx(slope, rel=1e-6)
    assert row["t"] == pytest.approx((row["up"] - row["down"]) / (2 * step), rel=1e-5)


def test_softplus_does_not_overflow(spark):
    row = spark.range(1).select(
        special.softplus(F.lit(1000.0)), special.softplus(F.lit(-1000.0)), special.softplus(F.lit(0.0))
    ).first()
    assert list(row) == [1000.0, 0.0, pytest.approx(math.log(2))]


def test_published_example(spark):
    customer = summary_of(spark, [(1, 2, 30.43, 38.86, None)])
    row = bg_expected(customer, BG, [39]).first()
    assert row["expected_purchases"] == pytest.approx(1.2260282, abs=1e-6)


@pytest.mark.parametrize(
    "x,tx,age,horizon,params",
    [
        (0, 0.0, 0.2, 52, BG),
        (100, 14.0, 15.0, 52, BG),
        (3, 10.0, 400.0, 1, BG),
        (4, 20.0, 30.0, 10, BgParams(1.5, 8.0, 3.2, 1.7)),
        (2, 5.0, 9.0, 40, BgParams(0.4, 6.0, 0.4, 0.3)),
        (6, 90.0, 100.0, 26, BgParams(380.0, 12_900.0, 1e-4, 5.0)),
    ],
)
def test_expected_equals_published_series(spark, x, tx, age, horizon, params):
    customer = summary_of(spark, [(1, x, tx, age, None)])
    row = bg_expected(customer, params, [horizon]).first()
    expected = direct_expected(x, tx, age, horizon, params)
    assert row["expected_purchases"] == pytest.approx(expected, rel=1e-8)


def test_customers_of_one_history_share_its_series(spark):
    rows = [(i, i % 4, 1.0 * (i % 4), 8.0 + i % 3, 20.0 + i) for i in range(60)]
    for compute in (
        lambda df: bg_expected(df, BG, [4, 26]),
        lambda df: cltv(df, BG, GG, 5, discount=0.01),
        lambda df: cltv(df, BG, GG, 5),
    ):
        together = compute(summary_of(spark, rows)).collect()
        alone = [r for i in (0, 7, 59) for r in compute(summary_of(spark, rows[i : i + 1])).collect()]
        assert set(alone) <= set(together)


def test_singular_parameters_are_stepped_over(spark):
    customers = summary_of(spark, [(1, 0, 0.0, 10.0, None), (2, 3, 5.0, 10.0, None)])
    for params in (BG._replace(a=1.0), BG._replace(a=0.4, b=0.6)):
        near = params._replace(a=params.a + 1e-5)
        exact = [r["expected_purchases"] for r in bg_expected(customers, params, [8]).orderBy("x").collect()]
        close = [r["expected_purchases"] for r in bg_expected(customers, near, [8]).orderBy("x").collect()]
        assert exact == pytest.approx(close, rel=1e-3)


def test_expected_rises_with_the_horizon(spark):
    customers = summary_of(spark, [(1, 0, 0.0, 10.0, None), (2, 5, 9.0, 10.0, None)])
    rows = bg_expected(customers, BG, [0, 1, 10, 100]).orderBy("customer_id", "horizon").collect()
    for customer in (rows[:4], rows[4:]):
        values = [row["expected_purchases"] for row in customer]
        assert values[0] == pytest.approx(0.0, abs=1e-12)
        assert values == sorted(values)
    totals = {r["horizon"]: r["expected_purchases"] for r in bg_total(bg_expected(customers, BG, [1, 10])).collect()}
    assert totals[10.0] == pytest.approx(rows[2]["expected_purchases"] + rows[6]["expected_purchases"])


def test_alive(spark):
    customers = summary_of(spark, [(1, 0, 0.0, 10.0, None), (2, 4, 9.0, 10.0, None), (3, 50, 1.0, 900.0, None)])
    alive = [row["p_alive"] for row in bg_alive(customers, BG).orderBy("customer_id").collect()]
    assert alive[0] == 1.0
    assert 0 < alive[1] < 1
    assert 0 <= alive[2] < 1e-12


def test_mean_value_lies_between_own_and_population_mean(spark):
    rows = [(i, i, 1.0, 2.0, m) for i in range(1, 5) for m in (5.0, 35.0, 90.0)]
    population = GG.p * GG.v / (GG.q - 1)
    assert population == pytest.approx(35.2190, abs=1e-4)
    for row in gg_expected(summary_of(spark, rows), GG).collect():
        low, high = sorted((row["m"], population))
        assert low - 1e-9 <= row["expected_average_profit"] <= high + 1e-9


def test_mean_value_without_repeats_or_mean(spark):
    customer = summary_of(spark, [(1, 0, 0.0, 2.0, None)])
    assert gg_expected(customer, GG).first()["expected_average_profit"] == pytest.approx(35.2190, abs=1e-4)
    assert customer.select(mean_value(F.col("x"), F.col("m"), GG._replace(q=0.9))).first()[0] is None


def test_discount_zero_is_the_product(spark):
    rows = [(1, 0, 0.0, 10.0, None), (2, 5, 9.0, 10.0, 40.0), (3, 1, 2.0, 50.0, 12.0)]
    customers = summary_of(spark, rows)
    plain = cltv(customers, BG, GG, 12, margin=0.5).orderBy("customer_id").collect()
    nearly = cltv(customers, BG, GG, 12, discount=1e-12, margin=0.5).orderBy("customer_id").collect()
    for a, b in zip(plain, nearly):
        product = 0.5 * a["expected_purchases"] * a["expected_average_profit"]
        assert a["cltv"] == pytest.approx(product, rel=1e-12)
        assert b["cltv"] == pytest.approx(product, rel=1e-9)


def test_discount_equals_period_sums(spark):
    customers = summary_of(spark, [(2, 5, 9.0, 10.0, 40.0)])
    row = cltv(customers, BG, GG, 6, discount=0.03).first()
    upto = [0.0] + [direct_expected(5, 9.0, 10.0, k, BG) for k in range(1, 7)]
    gains = sum((upto[k] - upto[k - 1]) / 1.03**k for k in range(1, 7))
    assert row["cltv"] == pytest.approx(gains * row["expected_average_profit"], rel=1e-9)


def test_holdout_splits_at_the_cutoff(spark, transactions):
    txn = transactions(
        [
            (1, 1, "2020-01-01", 5.0),
            (1, 2, "2020-01-15", 5.0),
            (1, 3, "2020-02-01", 5.0),
            (1, 4, "2020-02-07", 5.0),
            (1, 5, "2020-02-08", 5.0),
            (2, 6, "2020-02-03", 5.0),
            (3, 7, "2020-01-10", 5.0),
        ]
    )
    rows = {r["x"]: r for r in bg_holdout(occasions(txn), "2020-02-01", 1, BG).collect()}
    assert set(rows) == {0, 1}
    assert (rows[1]["customers"], rows[1]["actual"]) == (1, 2)
    assert (rows[0]["customers"], rows[0]["actual"]) == (1, 0)
    assert rows[1]["predicted"] == pytest.approx(direct_expected(1, 2.0, 31 / 7, 1, BG))
