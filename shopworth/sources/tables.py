"""Table scans with the column mappings of the supplied data, and the result sink."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shopworth.operators.prepare import prepare

ORDERS = {
    "customer_id": "o_custkey",
    "order_id": "o_orderkey",
    "order_date": "o_orderdate",
    "amount": "o_totalprice",
}
EVENTS = {
    "customer_id": "user_id",
    "order_id": "event_id",
    "order_date": "ts",
    "amount": "value",
}
LINES = {
    "order_id": "l_orderkey",
    "part_id": "l_partkey",
    "price": "l_extendedprice",
    "discount": "l_discount",
    "return_flag": "l_returnflag",
}
CUSTOMERS = {
    "customer_id": "c_custkey",
    "name": "c_name",
    "nation_id": "c_nationkey",
    "market_segment": "c_mktsegment",
}


def read_table(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    schema: StructType | str | None = None,
    **options: str,
) -> DataFrame:
    """Any batch source Spark reads; give a schema for text formats."""
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def _renamed(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.select(*[F.col(source).alias(name) for name, source in mapping.items()])


def load_orders(spark: SparkSession, directory: str, cutoff=None) -> DataFrame:
    """Orders as transactions, one row per order."""
    return prepare(read_table(spark, f"{directory}/orders.parquet"), ORDERS, cutoff)


def load_lines(spark: SparkSession, directory: str) -> DataFrame:
    """Order lines with the price, discount and return flag of each."""
    return _renamed(read_table(spark, f"{directory}/lineitem.parquet"), LINES)


def load_purchase_events(spark: SparkSession, directory: str, cutoff=None) -> DataFrame:
    """Purchase events as transactions, one row per event."""
    events = read_table(spark, f"{directory}/events.parquet")
    return prepare(events.filter(F.col("event_type") == "purchase"), EVENTS, cutoff)


def load_customers(spark: SparkSession, directory: str) -> DataFrame:
    """Customer attributes for segment extracts."""
    return _renamed(read_table(spark, f"{directory}/customer.parquet"), CUSTOMERS)


def save(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "errorifexists",
    partition_by: Sequence[str] = (),
) -> None:
    """Write customers with their scores and segments."""
    df.write.format(fmt).mode(mode).partitionBy(*partition_by).save(path)
