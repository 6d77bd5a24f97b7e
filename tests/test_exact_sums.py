"""Sums that do not depend on the order of their parts."""

import math
import random

import pytest
from pyspark.sql import functions as F

from shopworth.operators.prepare import exact_sum, money_sum
from shopworth.operators.rfm import rfm_metrics
from shopworth.sources import release


def _sums(spark, values, orders=4):
    """The sums of the values, grouped and not, in several orders and numbers of partitions."""
    draw, found = random.Random(5), []
    for n in range(orders):
        values = list(values)
        draw.shuffle(values)
        df = spark.createDataFrame([(1, v) for v in values], "k int, v double").repartition(1 + 3 * n)
        found.append(df.agg(exact_sum(F.col("v"))).first()[0])
        found.append(df.groupBy("k").agg(exact_sum(F.col("v")).alias("s")).first()["s"])
    return found


@pytest.mark.parametrize("sign", ["plus", "minus", "both"])
def test_any_order_gives_equal_bits(spark, sign):
    draw = random.Random(sign)
    values = [draw.lognormvariate(3, 8) for _ in range(3000)]
    values = [v if sign == "plus" or sign == "both" and draw.random() < 0.5 else -v for v in values]
    values = [v for v in values if 2.0**-20 <= abs(v) < 2.0**86] + [0.0]
    found = _sums(spark, values)
    assert len({f.hex() for f in found}) == 1
    assert math.isclose(found[0], math.fsum(values), rel_tol=1e-15)


def test_sums_next_to_a_rounding_edge_do_not_flip(spark):
    values = [0.1] * 10 + [2.0**53, 1.0, -(2.0**53)] * 3 + [1e15 + 0.3, 0.7, 1e-6] * 5
    found = _sums(spark, values)
    assert len({f.hex() for f in found}) == 1 and math.isclose(found[0], math.fsum(values), rel_tol=1e-15)
    edge = [1.0, 2.0**-13, 5e-12 + 2.0**-30]  # the twelfth digit is decided by the last bits
    df = spark.createDataFrame([(v,) for v in edge * 3001], "v double")
    sums = {df.repartition(n).agg(money_sum(F.col("v"))).first()[0].hex() for n in (1, 3, 8)}
    assert len(sums) == 1


def test_small_negative_sums_keep_their_digits(spark):
    values = [-(2.0**60), 2.0**60 - 256.0, 256.0 - 3e-6]
    assert set(_sums(spark, values)) == {math.fsum(values)}


@pytest.mark.parametrize("values", [[1.0, math.inf], [math.inf, -math.inf], [math.nan, 1.0], [2.0**90, 1.0], [1e-30, 3e-30], [1e300] * 3])
def test_values_beyond_the_limbs_are_added_plainly(spark, values):
    for s in _sums(spark, values, orders=1):
        assert math.isnan(s) and math.isnan(sum(values)) or math.isclose(s, sum(values), rel_tol=1e-15)


def test_a_limb_that_overflows_is_added_plainly(spark):
    values = [2.0**85] * 6
    assert set(_sums(spark, values)) == {math.fsum(values)}


def test_nulls_and_nothing(spark):
    assert _sums(spark, [None, 2.5, None])[0] == 2.5
    assert set(_sums(spark, [None, None])) == {None}
    empty = spark.createDataFrame([], "v double").agg(exact_sum(F.col("v"))).first()
    assert empty[0] is None


def test_customers_get_equal_amounts_under_any_partitioning(spark, transactions):
    draw = random.Random(9)
    rows = [(i % 5, i, f"2020-01-{1 + i % 28:02d}", draw.lognormvariate(2, 4) + 0.01) for i in range(4000)]
    found = []
    for n in (1, 7, 16):
        draw.shuffle(rows)
        txn = transactions(rows).repartition(n)
        found.append(sorted((r.customer_id, r.monetary.hex()) for r in rfm_metrics(txn, "2020-03-01").collect()))
    assert found[0] == found[1] == found[2]
    release(spark)
