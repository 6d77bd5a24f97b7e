import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shopworth import clv
from shopworth.operators.descriptive import customer_base, population
from shopworth.operators.rank import segment
from shopworth.operators.summary import summarise


def by_customer(df):
    return {row["customer_id"]: row for row in df.collect()}


def test_two_customers(transactions):
    txn = transactions([(1, 1, "2020-01-01", 10.0), (1, 2, "2020-01-02", 30.0), (2, 3, "2020-01-03", 20.0)])
    rows = by_customer(clv(txn))
    assert (rows[1]["total_price"], rows[1]["total_transaction"]) == (40.0, 2)
    assert rows[1]["average_order_value"] == 20.0
    assert rows[1]["purchase_frequency"] == 1.0
    assert rows[1]["profit_margin"] == pytest.approx(4.0)
    assert rows[1]["clv"] == pytest.approx(160.0)
    assert rows[2]["clv"] == pytest.approx(40.0)
    pop = population(customer_base(txn)).first()
    assert (pop["repeat_rate"], pop["churn_rate"]) == (0.5, 0.5)


def test_no_churn_leaves_value_and_label_open(transactions):
    txn = transactions([(c, 10 * c + i, "2020-01-01", 5.0) for c in (1, 2) for i in (1, 2)])
    for row in clv(txn).collect():
        assert row["clv"] is None and row["segment"] is None


def test_no_transactions(transactions):
    txn = transactions([])
    assert clv(txn).count() == 0
    assert population(customer_base(txn)).first()["repeat_rate"] is None


def test_one_customer(transactions):
    row = clv(transactions([(9, 1, "2020-01-01", 50.0)])).first()
    assert row["clv"] == pytest.approx(0.1 * 50.0**2)
    assert row["segment"] == "D"


def test_lines_of_one_order_count_once(transactions):
    txn = transactions([(1, 1, "2020-01-01", 10.0), (1, 1, "2020-01-01", 5.0), (2, 2, "2020-01-01", 1.0)])
    assert by_customer(customer_base(txn))[1]["total_transaction"] == 1
    assert by_customer(customer_base(txn, unique_orders=True))[1]["total_transaction"] == 2


def test_cutoff_is_exclusive(transactions):
    txn = transactions([(1, 1, "2020-01-01", 10.0), (1, 2, "2020-02-01", 30.0)])
    assert clv(txn, cutoff="2020-02-01").first()["total_price"] == 10.0


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.tuples(st.integers(1, 6), st.integers(1, 12), st.integers(1, 500)), min_size=1, max_size=30
    )
)
def test_identities(transactions, purchases):
    rows = [(c, o, "2020-01-01", float(v)) for c, o, v in purchases]
    valued = by_customer(clv(transactions(rows)))
    scaled = by_customer(clv(transactions([(c, o, d, 3 * v) for c, o, d, v in rows[::-1]])))
    n = len(valued)
    once = sum(row["total_transaction"] == 1 for row in valued.values())
    for customer, row in valued.items():
        assert row["customer_value"] == pytest.approx(row["total_price"] / n)
        if once == 0:
            assert row["clv"] is None
        else:
            assert row["clv"] == pytest.approx(0.1 * row["total_price"] ** 2 / once)
            assert scaled[customer]["clv"] == pytest.approx(9 * row["clv"])
            assert scaled[customer]["segment"] == row["segment"]


def test_summary_per_segment(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(1, 9)], "customer_id bigint, clv double")
    rows = {r["segment"]: r for r in summarise(segment(df, "clv"), "segment", ["clv"]).collect()}
    assert rows["A"]["clv_sum"] == 15.0 and rows["A"]["clv_mean"] == 7.5
    assert (rows["D"]["clv_min"], rows["D"]["clv_max"]) == (1.0, 2.0)
    assert all(r["share"] == 0.25 and r["customers"] == 2 for r in rows.values())


def test_summary_of_missing_values(spark):
    df = spark.createDataFrame([("a", None)], "segment string, clv double")
    row = summarise(df, "segment", ["clv"]).first()
    assert row["customers"] == 1 and row["clv_sum"] is None and row["clv_mean"] is None


def test_sums_do_not_depend_on_row_order(spark):
    rows = [("s", 0.1 * i) for i in range(1, 2000)]
    sums = set()
    for parts in (1, 3, 7):
        df = spark.createDataFrame(rows, "segment string, v double").repartition(parts, F.rand(parts))
        sums.add(summarise(df, "segment", ["v"]).first()["v_sum"])
    assert len(sums) == 1


def test_one_customer_with_a_third_of_all_orders(spark):
    orders = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(2 + F.col("id") % 500).alias("customer_id"),
        F.col("id").alias("order_id"),
        F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 300).cast("int")).alias("order_date"),
        (F.col("id") % 97 + 1.0).alias("amount"),
    )
    totals = {}
    for i in range(9000):
        customer = 1 if i % 3 == 0 else 2 + i % 500
        number, money = totals.get(customer, (0, 0.0))
        totals[customer] = (number + 1, money + i % 97 + 1.0)
    for unique in (True, False):
        rows = by_customer(customer_base(orders, unique_orders=unique))
        assert {c: (r["total_transaction"], r["total_price"]) for c, r in rows.items()} == totals
