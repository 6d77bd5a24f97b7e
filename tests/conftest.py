import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("shopworth-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def transactions(spark):
    """A builder of transactions from (customer, order, day, amount) tuples."""

    def build(rows):
        schema = "customer_id bigint, order_id bigint, day string, amount double"
        df = spark.createDataFrame(rows, schema)
        return df.selectExpr("customer_id", "order_id", "date(day) AS order_date", "amount")

    return build
