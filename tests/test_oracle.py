"""Every registered query against the same question in SQL on the same tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as registered

DATA = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = registered.queries(), registered.oracle_sql()
if registered.llm:  # these have tests of their own
    QUERIES = {k: v for k, v in QUERIES.items() if k not in {"pipeline", *registered.llm.queries()}}
    SQL = {k: v for k, v in SQL.items() if k in QUERIES}


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for path in glob.glob(f"{DATA}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _sorted(rows):
    return sorted(rows, key=lambda row: tuple((v is None, str(v)) for v in row))


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, con, name):
    df = QUERIES[name](spark, DATA)
    result = con.execute(SQL[name])
    columns = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(columns)
    expected = _sorted(result.fetchall())
    actual = _sorted(tuple(row) for row in df.select(*columns).collect())
    assert actual == expected


def test_only_fits_lack_sql():
    assert set(SQL) <= set(QUERIES)
    assert set(QUERIES) - set(SQL) == {"bg_fit", "gg_fit", "cltv_fitted", "bg_penalties", "gg_penalties", "cltv_fitted_penalised",
        "bg_certificate", "gg_certificate"}


def test_fits_report_the_bound(spark):
    for name in ("bg_fit", "gg_fit"):
        row = QUERIES[name](spark, DATA).first()
        assert row["at_bound"] and row["converged"]


def test_fitted_prediction_labels_every_customer(spark):
    df = QUERIES["cltv_fitted"](spark, DATA)
    assert df.filter("segment IS NULL OR cltv <= 0").count() == 0
    sizes = [row["count"] for row in df.groupBy("segment").count().collect()]
    assert len(sizes) == 4 and max(sizes) - min(sizes) <= 1


def test_entry(spark):
    df = registered.entry(spark)
    assert df.count() == 116
    assert df.filter("clv IS NULL").count() == 0


@pytest.mark.parametrize("name", ["bg_penalties", "gg_penalties"])
def test_penalised_fits_have_an_inner_maximum(spark, name):
    """Where the plain fit lies on a bound; and customers left out are no less likely."""
    rows = {row["penalty"]: row for row in QUERIES[name](spark, DATA).collect()}
    (chosen,) = [row for row in rows.values() if row["chosen"]]
    assert rows[0.0]["at_bound"] and chosen["penalty"] > 0
    assert all(row["converged"] for row in rows.values())
    assert not any(row["at_bound"] for weight, row in rows.items() if weight >= 0.03 or weight == chosen["penalty"])
    assert chosen["holdout"] >= rows[0.0]["holdout"] - 0.5
    assert max(row["loglik"] for row in rows.values()) == rows[0.0]["loglik"]
