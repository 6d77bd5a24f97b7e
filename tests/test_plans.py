"""The shape of the plans: what is read, what is shuffled, what is broadcast."""

import re

import pytest

import __spark_entry__ as registered
from shopworth import BgParams, GgParams
from shopworth.operators.bgnbd import bg_summary, occasions
from shopworth.operators.descriptive import customer_base
from shopworth.operators.predicted import cltv
from shopworth.operators.rank import Tile, ntiles
from shopworth.operators.rfm import rfm_metrics, rfm_scores
from shopworth.operators.summary import profile
from shopworth.sources import load_orders, pin, read_table

DATA = "/root/testdata/sf0.001"
FITS = {"bg_fit", "gg_fit", "cltv_fitted", "bg_penalties", "gg_penalties", "cltv_fitted_penalised"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(registered.queries()) - FITS))
def test_no_query_multiplies_rows_or_leaves_the_jvm(spark, name):
    text = plan(registered.queries()[name](spark, DATA))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text
    assert "Python" not in text and "InPandas" not in text


def test_filters_and_columns_reach_the_scan(spark):
    df = load_orders(spark, DATA, "1996-01-01")
    full = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    filters = re.search(r"PushedFilters: \[(.*)\]", full).group(1)
    for part in (
        "IsNotNull(o_custkey)",
        "IsNotNull(o_orderkey)",
        "LessThan(o_orderdate,1996-01-01T00:00)",
        "GreaterThan(o_totalprice,0.0)",
    ):
        assert part in filters
    schema = re.search(r"ReadSchema: struct<(.*)>", full).group(1)
    assert "o_orderstatus" not in schema and "o_orderpriority" not in schema


def test_unique_orders_are_counted_before_the_only_shuffle(spark):
    text = plan(customer_base(load_orders(spark, DATA), unique_orders=True))
    assert text.count("Exchange") == 1
    assert "partial_sum" in text and "partial_count" in text


def test_distinct_orders_need_no_expansion(spark):
    text = plan(customer_base(load_orders(spark, DATA)))
    assert "Expand" not in text


def test_profile_is_one_pass(spark):
    text = plan(profile(read_table(spark, f"{DATA}/orders.parquet")))
    assert "Expand" not in text and text.count("ReadSchema") == 1 and text.count("Exchange") == 1


def test_exact_profile_reads_once_and_shuffles_values_once(spark):
    text = plan(profile(read_table(spark, f"{DATA}/orders.parquet"), exact=True))
    assert "Expand" not in text and text.count("ReadSchema") == 1
    assert len(re.findall(r"Exchange hashpartitioning\(c#\d+, v0", text)) == 1
    assert "partial_count" in text


def test_tiles_are_assigned_where_rows_lie(spark):
    base = pin(customer_base(load_orders(spark, DATA), unique_orders=True))
    text = plan(ntiles(base, "customer_id", {"tile": Tile("total_price", 5)}))
    assert "Exchange" not in text and "Window" not in text
    text = plan(rfm_scores(rfm_metrics(load_orders(spark, DATA), unique_orders=True)))
    assert "Exchange" not in text and "Window" not in text


def test_predictions_join_distinct_histories(spark):
    summary = bg_summary(occasions(load_orders(spark, DATA)))
    bg, gg = BgParams(0.243, 4.414, 0.793, 2.426), GgParams(6.25, 3.74, 15.44)
    small = plan(cltv(summary, bg, gg, 12, discount=0.01))
    assert "BroadcastHashJoin" in small and "SortMergeJoin" not in small
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = plan(cltv(summary, bg, gg, 12, discount=0.01))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Broadcast" not in large and re.search(r"(SortMerge|ShuffledHash)Join", large)


def test_lines_are_summed_before_they_meet_orders(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(registered.queries()["txn_from_lines"](spark, DATA))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("Exchange hashpartitioning") == 2
    assert "partial_sum" in text


def test_hot_customer_is_spread_over_days(spark):
    text = plan(occasions(load_orders(spark, DATA)))
    assert re.search(r"hashpartitioning\(customer_id#\d+L, order_date#\d+", text)
