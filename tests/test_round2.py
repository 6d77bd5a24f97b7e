"""Amounts of any size, honest predictions, text ids and plans of what is pinned."""

import warnings
from unittest.mock import patch

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopworth import BgParams, GgParams, fitted_cltv, predict_cltv, rfm
from shopworth.operators import bgnbd, gammagamma, rank
from shopworth.operators.prepare import cap, prepare, significant
from shopworth.operators.rank import Tile, ntiles
from shopworth.operators.rfm import rfm_metrics
from shopworth.operators.summary import profile, summarise
from shopworth.plans import analyses, clv
from shopworth.sources import load_orders

DATA = "/root/testdata/sf0.001"
BG, GG = BgParams(0.243, 4.414, 0.793, 2.426), GgParams(6.25, 3.74, 15.44)


@pytest.mark.parametrize("unit", [1e-6, 1.0, 1e9])
def test_amounts_of_any_size(spark, transactions, unit):
    txn = transactions([(i, 10 * i + j, f"2020-01-{1 + i + j:02d}", unit * (2 + j)) for i in range(12) for j in range(2)])
    metrics = rfm_metrics(txn)
    assert metrics.count() == 12
    row = summarise(metrics.withColumn("all", F.lit(1)), "all", ["monetary"]).first()
    assert row["monetary_sum"] == pytest.approx(60 * unit, rel=1e-9)
    assert row["monetary_mean"] == pytest.approx(5 * unit, rel=1e-9)
    summary = bgnbd.bg_summary(bgnbd.occasions(txn))
    assert gammagamma.gg_loglik(summary, GG).first()["customers"] == 12
    assert summary.filter("m > 0").count() == 12


def test_significant_digits(spark):
    rows = [(0.0,), (None,), (float("nan"),), (float("inf"),), (-1234567.891,), (1e-310,), (0.1 + 0.2,)]
    got = [r[0] for r in spark.createDataFrame(rows, "v double").select(significant(F.col("v"), 6)).collect()]
    assert got[:2] == [0.0, None] and got[2] != got[2] and got[3] == float("inf")
    assert got[4] == -1234570.0 and 0 <= got[5] < 1e-300 and got[6] == 0.3


def test_nan_makes_a_sum_nan(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", float("nan"))], "g string, v double")
    row = summarise(df, "g", ["v"]).first()
    assert row["v_sum"] != row["v_sum"] and row["customers"] == 2


def test_null_amounts_stay_null_when_capped(spark):
    df = spark.createDataFrame([(float(i),) for i in range(100)] + [(None,)], "amount double")
    assert cap(df, "amount", 0.1, 0.9).filter("amount IS NULL").count() == 1


def test_rules_must_fit_the_scores(transactions):
    txn = transactions([(1, 1, "2020-01-01", 1.0)])
    for k in (3, 10):
        with pytest.raises(ValueError, match="rules must cover"):
            rfm(txn, k=k)


def test_later_orders_do_not_count(transactions):
    txn = transactions([(1, 1, "2020-01-01", 1.0), (1, 2, "2020-03-01", 5.0), (2, 3, "2020-03-02", 1.0)])
    (row,) = rfm_metrics(txn, "2020-02-01").collect()
    assert tuple(row) == (1, 31, 1, 1.0)


def test_sketched_profile(spark):
    df = spark.createDataFrame([(1, "x"), (2, None), (2, "y")], "a int, b string")
    assert sorted(map(tuple, profile(df).collect())) == sorted(map(tuple, profile(df, exact=True).collect()))


def test_text_ids(spark):
    rows = [("u-1", "C53", "2020-01-01", 2.0), ("u-1", "536", "2020-01-02", 3.0), ("7", "9", "2020-01-03", 4.0)]
    df = spark.createDataFrame(rows, "who string, no string, at string, paid double")
    txn = prepare(df, {"customer_id": "who", "order_id": "no", "order_date": "at", "amount": "paid"})
    assert {r.customer_id for r in txn.collect()} == {"u-1", "7"}
    many = spark.range(1000).select(F.concat(F.lit("u"), "id").alias("customer_id"), (F.col("id") % 3).alias("v"))
    for limit in (10, 500_000):
        tiles = ntiles(many, "customer_id", {"tile": Tile("v", 4)}, limit).groupBy("tile").count().collect()
        assert {r["count"] for r in tiles} == {250}
    assert len(rfm(txn).collect()) == 2


def test_whole_numbers_keep_their_digits(spark):
    df = spark.createDataFrame([(i, 2**60 + i) for i in range(8)], "id long, v long")
    assert [r.tile for r in ntiles(df, "id", {"tile": Tile("v", 4)}).orderBy("id").collect()] == [1, 1, 2, 2, 3, 3, 4, 4]


def test_ranks_when_every_sample_misses(spark):
    df = spark.range(5000).select("id", (F.col("id") * 7919 % 5000).cast("double").alias("v"))
    nothing = lambda self, *args, **options: self.filter("v < 1")
    with patch.object(rank, "SKETCH_ROWS", 100), patch.object(DataFrame, "sample", nothing), patch.object(
        rank, "_wide", side_effect=rank._wide
    ) as wide:
        rows = ntiles(df, "id", {"tile": Tile("v", 5)}, limit=50).collect()
    assert all(r.tile == int(r.v) // 1000 + 1 for r in rows) and wide.call_count > 2


def test_nothing_to_fit_is_said(transactions):
    once = transactions([(i, i, f"2020-01-{i:02d}", 5.0) for i in range(1, 9)])
    df, fits = fitted_cltv(once, 26)
    rows = df.collect()
    assert len(rows) == 8 and all(r.cltv is None and r.segment is None for r in rows)
    assert {r.reason for r in rows} == {fits.reason} == {"no repeat purchases to fit"}
    assert predict_cltv(transactions([]), 26).count() == 0
    known = predict_cltv(once, 26, bg=BG, gg=GG).collect()
    assert all(r.cltv > 0 and r.reason is None for r in known)
    low = predict_cltv(once, 26, bg=BG, gg=GG._replace(q=0.9)).collect()
    assert all(r.cltv is None and "q <= 1" in r.reason for r in low)


def test_fits_are_returned_and_bounds_warned_of(spark):
    txn = load_orders(spark, DATA)
    with warnings.catch_warnings(record=True) as said:
        warnings.simplefilter("always")
        _, fits = fitted_cltv(txn, 26)
    assert fits.bg.at_bound and fits.gg is not None and any("bound" in str(w.message) for w in said)


def test_several_horizons(spark):
    txn = load_orders(spark, DATA)
    both = predict_cltv(txn, [4, 26], bg=BG, gg=GG)
    for horizon in (4, 26):
        one = predict_cltv(txn, horizon, bg=BG, gg=GG)
        columns = ["customer_id", "cltv", "segment"]
        assert set(both.filter(F.col("horizon") == horizon).select(columns).collect()) == set(one.select(columns).collect())


@pytest.mark.parametrize(
    ("analysis", "most"),
    [
        (lambda txn: clv(txn, unique_orders=True), 1),
        (lambda txn: rfm(txn, unique_orders=True), 1),
        (lambda txn: predict_cltv(txn, 26, bg=BG, gg=GG), 2),
        (lambda txn: predict_cltv(txn, 26), 2),
    ],
)
@pytest.mark.filterwarnings("ignore")
def test_what_is_pinned(spark, analysis, most):
    plans = []

    def kept(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return whole(df)

    whole = bgnbd.pin
    with patch.object(analyses, "pin", kept), patch.object(bgnbd, "pin", kept), patch("shopworth.operators.rfm.pin", kept):
        analysis(load_orders(spark, DATA)).count()
    assert len(plans) <= most
    for text in plans:
        assert "SinglePartition" not in text and "Cartesian" not in text and "NestedLoop" not in text
        assert "o_orderpriority" not in text
