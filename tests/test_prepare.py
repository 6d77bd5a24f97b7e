import os

import pytest
from pyspark.sql import functions as F

from shopworth.operators.bgnbd import bg_stats, bg_summary, occasions
from shopworth.operators.prepare import cap, drop_returns, order_amounts, prepare
from shopworth.operators.summary import profile, top_k
from shopworth.sources import pin, read_table, save

MAPPING = {"customer_id": "who", "order_id": "no", "order_date": "at", "amount": "paid"}


@pytest.fixture(scope="module")
def raw(spark):
    rows = [
        (1, 10, "2020-01-01 08:00:00", "5.5"),
        (None, 11, "2020-01-01 08:00:00", "5.5"),
        (2, 12, None, "5.5"),
        (2, 13, "2020-01-02 09:00:00", None),
        (2, 14, "2020-01-02 23:59:59", "0"),
        (2, 15, "2020-01-02 23:59:59", "-3"),
        (2, 17, "2020-01-02 23:59:59", "NaN"),
        (3, 16, "2020-01-03 00:00:00", "7"),
    ]
    df = spark.createDataFrame(rows, "who int, no int, at string, paid string")
    return df.withColumn("at", F.col("at").cast("timestamp_ntz"))


def test_incomplete_and_nonpositive_rows_go(raw):
    kept = prepare(raw, MAPPING)
    assert kept.dtypes == [
        ("customer_id", "bigint"), ("order_id", "bigint"), ("order_date", "date"), ("amount", "double")
    ]
    assert sorted(r["order_id"] for r in kept.collect()) == [10, 16]


def test_prepare_cutoff_is_exclusive(raw):
    assert [r["order_id"] for r in prepare(raw, MAPPING, "2020-01-03").collect()] == [10]


def test_missing_column_fails_early(raw):
    with pytest.raises(ValueError, match="nowhere"):
        prepare(raw, {**MAPPING, "amount": "nowhere"})
    with pytest.raises(ValueError, match="amount"):
        prepare(raw, {k: v for k, v in MAPPING.items() if k != "amount"})


def test_decimal_amounts_are_accepted(spark):
    df = spark.sql("SELECT 1 AS who, 2 AS no, DATE '2020-01-01' AS at, CAST(3.25 AS DECIMAL(10,2)) AS paid")
    assert prepare(df, MAPPING).first()["amount"] == 3.25


@pytest.fixture(scope="module")
def lines(spark):
    rows = [(1, 7, 10.0, 0.1, "N"), (1, 8, 5.0, 0.0, "R"), (2, 7, 4.0, 0.5, "R"), (9, 7, 1.0, 0.0, None)]
    return spark.createDataFrame(
        rows, "order_id bigint, part_id bigint, price double, discount double, return_flag string"
    )


def test_order_amounts_and_returns(transactions, lines):
    orders = transactions([(1, 1, "2020-01-01", 0.0), (2, 2, "2020-01-02", 0.0), (3, 3, "2020-01-03", 0.0)])
    amounts = {r["order_id"]: r["amount"] for r in order_amounts(orders, lines).collect()}
    assert amounts == {1: 14.0, 2: 2.0}
    kept = {r["order_id"]: r["amount"] for r in order_amounts(orders, drop_returns(lines)).collect()}
    assert kept == {1: 9.0}
    assert sorted(r["order_id"] for r in drop_returns(lines).collect()) == [1, 9]
    returns = lines.filter("return_flag = 'R'")
    assert [r["order_id"] for r in drop_returns(orders, returns).collect()] == [3]


def test_cap_pulls_in_both_ends(spark):
    df = spark.createDataFrame([(float(v),) for v in range(101)], "amount double")
    values = sorted(r["amount"] for r in cap(df, "amount", 0.05, 0.95).collect())
    assert len(values) == 101 and values[0] == 5.0 and values[-1] == 95.0
    empty = df.filter("amount < 0")
    assert cap(empty, "amount", 0.05, 0.95).count() == 0


def test_profile(spark):
    df = spark.createDataFrame([(1, 2.5, "a"), (1, None, "b"), (2, 7.5, "b")], "k bigint, v double, s string")
    rows = {r["column"]: r for r in profile(df).collect()}
    assert tuple(rows["v"])[1:] == (3, 1, 2, "2.5000", "7.5000", 5.0)
    assert tuple(rows["s"])[1:] == (3, 0, 2, "a", "b", None)
    assert rows["k"]["distinct_values"] == 2
    rough = {r["column"]: r["distinct_values"] for r in profile(df, exact=False).collect()}
    assert rough == {"k": 2, "v": 2, "s": 2}


def test_top_k_breaks_ties_by_key(spark):
    df = spark.createDataFrame([(3, 5.0), (1, 2.0), (1, 3.0), (2, 5.0), (4, 9.0)], "k bigint, amount double")
    assert [tuple(r) for r in top_k(df, "k", 3).collect()] == [(4, 9.0), (1, 5.0), (2, 5.0)]


def test_same_day_orders_are_one_occasion(transactions):
    txn = transactions(
        [
            (1, 1, "2020-01-01", 5.0),
            (1, 2, "2020-01-01", 3.0),
            (1, 3, "2020-01-15", 10.0),
            (1, 4, "2020-01-29", 20.0),
            (2, 5, "2020-01-08", 1.0),
        ]
    )
    occ = occasions(txn)
    assert occ.count() == 4
    rows = {r["customer_id"]: r for r in bg_summary(occ, "2020-02-05").collect()}
    assert (rows[1]["x"], rows[1]["tx"], rows[1]["age"], rows[1]["m"]) == (2, 4.0, 5.0, 15.0)
    assert (rows[2]["x"], rows[2]["tx"], rows[2]["age"], rows[2]["m"]) == (0, 0.0, 4.0, None)
    daily = {r["customer_id"]: r for r in bg_summary(occ, "2020-02-05", unit=1).collect()}
    assert (daily[1]["tx"], daily[1]["age"]) == (28.0, 35.0)
    first = {r["customer_id"]: r for r in bg_summary(occ, include_first=True).collect()}
    assert (first[1]["m"], first[1]["m_count"]) == (38.0 / 3, 3)
    assert (first[2]["m"], first[2]["m_count"]) == (1.0, 1)
    assert bg_stats(bg_summary(occ, "2020-02-05")).count() == 2


def test_tables_and_sink(spark, tmp_path, transactions):
    txn = transactions([(1, 1, "2020-01-01", 5.0), (2, 2, "2020-01-02", 6.0)])
    for fmt in ("parquet", "orc", "json", "csv"):
        path = str(tmp_path / fmt)
        save(txn, path, fmt)
        schema = "customer_id bigint, order_id bigint, order_date date, amount double"
        back = read_table(spark, path, fmt, schema)
        assert sorted(map(tuple, back.collect())) == sorted(map(tuple, txn.collect()))
    save(txn, str(tmp_path / "parts"), partition_by=["order_date"])
    assert "order_date=2020-01-01" in os.listdir(tmp_path / "parts")
    with pytest.raises(Exception, match="already exists"):
        save(txn, str(tmp_path / "parquet"))


def test_pin_writes_to_the_named_folder(spark, transactions):
    folder = spark.conf.get("spark.checkpoint.dir")
    pinned = pin(transactions([(1, 1, "2020-01-01", 5.0)]).withColumn("twice", F.col("amount") * 2))
    assert pinned.first()["twice"] == 10.0
    assert all(path.startswith(f"file://{folder}") for path in pinned.inputFiles())
    empty = pin(transactions([]))
    assert empty.count() == 0 and empty.columns[0] == "customer_id"
