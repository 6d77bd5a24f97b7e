import datetime

import pytest

from shopworth import rfm
from shopworth.operators.rfm import (
    DEFAULT_RULES,
    customers_in,
    rfm_metrics,
    rfm_scores,
    rfm_scores_edges,
    rfm_segments,
)


def test_metrics(transactions):
    txn = transactions(
        [
            (1, 1, "2020-01-01", 10.0),
            (1, 1, "2020-01-01", 5.0),
            (1, 2, "2020-01-11", 1.0),
            (2, 3, "2020-01-20", 7.0),
        ]
    )
    rows = {r["customer_id"]: r for r in rfm_metrics(txn, "2020-02-01").collect()}
    assert (rows[1]["recency_days"], rows[1]["frequency"], rows[1]["monetary"]) == (21, 2, 16.0)
    assert (rows[2]["recency_days"], rows[2]["frequency"], rows[2]["monetary"]) == (12, 1, 7.0)
    default = {r["customer_id"]: r["recency_days"] for r in rfm_metrics(txn).collect()}
    assert default == {1: 10, 2: 1}
    same = rfm_metrics(txn, datetime.date(2020, 1, 21)).collect()
    assert {r["customer_id"]: r["recency_days"] for r in same} == default


def test_nonpositive_total_is_left_out(transactions):
    txn = transactions([(1, 1, "2020-01-01", 10.0), (1, 2, "2020-01-02", -10.0), (2, 3, "2020-01-02", 1.0)])
    assert [r["customer_id"] for r in rfm_metrics(txn).collect()] == [2]


@pytest.fixture(scope="module")
def metrics(spark):
    rows = [(i, i, (i * 7) % 25 + 1, float((i * 11) % 25)) for i in range(25)]
    return spark.createDataFrame(
        rows, "customer_id bigint, recency_days int, frequency bigint, monetary double"
    )


def test_recent_frequent_and_valuable_score_high(metrics):
    for scores in (rfm_scores(metrics), rfm_scores_edges(metrics)):
        rows = scores.collect()
        for score, name, sign in (("r_score", "recency_days", -1), ("f_score", "frequency", 1), ("m_score", "monetary", 1)):
            ordered = [r[score] for r in sorted(rows, key=lambda r: sign * r[name])]
            assert ordered == sorted(ordered)
            assert [ordered.count(k) for k in range(1, 6)] == [5] * 5
        row = rows[0]
        assert row["rf_score"] == f"{row['r_score']}{row['f_score']}"
        assert row["rfm_score"] == f"{row['r_score']}{row['f_score']}{row['m_score']}"


def test_edges_give_ties_one_score(spark):
    rows = [(i, 5, 1 if i < 7 else i, float(i)) for i in range(10)]
    df = spark.createDataFrame(rows, "customer_id bigint, recency_days int, frequency bigint, monetary double")
    scored = rfm_scores_edges(df).collect()
    assert {r["f_score"] for r in scored if r["frequency"] == 1} == {1}
    assert {r["r_score"] for r in scored} == {1}
    assert {r["f_score"] for r in rfm_scores(df).collect()} == {1, 2, 3, 4, 5}


def test_rules_cover_every_pair_once(spark):
    assert sorted((r, f) for r, f, _ in DEFAULT_RULES) == [(r, f) for r in range(1, 6) for f in range(1, 6)]
    scores = spark.createDataFrame([(1, 5, 5), (2, 1, 1)], "customer_id bigint, r_score int, f_score int")
    found = {r["customer_id"]: r["segment"] for r in rfm_segments(scores).collect()}
    assert found == {1: "champions", 2: "hibernating"}
    with pytest.raises(ValueError):
        rfm_segments(scores, DEFAULT_RULES[:-1])
    with pytest.raises(ValueError):
        rfm_segments(scores, DEFAULT_RULES[:-1] + DEFAULT_RULES[:1])


def test_own_rules(spark):
    rules = [(r, f, "good" if r + f > 2 else "poor") for r in (1, 2) for f in (1, 2)]
    scores = spark.createDataFrame([(1, 2, 1), (2, 1, 1)], "customer_id bigint, r_score int, f_score int")
    found = {r["customer_id"]: r["segment"] for r in rfm_segments(scores, rules).collect()}
    assert found == {1: "good", 2: "poor"}


def test_customers_of_one_segment(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a")], "customer_id bigint, segment string")
    names = spark.createDataFrame([(1, "x"), (2, "y"), (4, "z")], "customer_id bigint, name string")
    assert [tuple(r) for r in customers_in(df, "a", names).collect()] == [(1, "a", "x")]


def test_whole_analysis(transactions):
    txn = transactions([(c, 10 * c + i, f"2020-01-{c + i:02d}", 1.0 * c) for c in range(1, 11) for i in range(c)])
    rows = rfm(txn, "2020-02-01").collect()
    assert len(rows) == 10 and all(r["segment"] for r in rows)
    assert {r["customer_id"] for r in rows if r["segment"] == "champions"} == {9, 10}
    assert len(rfm(txn).collect()) == 10
    assert rfm(transactions([])).count() == 0
