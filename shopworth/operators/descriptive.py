"""Descriptive lifetime value from order value, frequency, churn and margin."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from shopworth.operators.prepare import money_sum


def customer_base(txn: DataFrame, unique_orders: bool = False) -> DataFrame:
    """Orders and money per customer.

    Set ``unique_orders`` when every row is its own order: rows are then counted
    where they lie, and the shuffle that removes repeated order ids falls away.
    """
    orders = F.count("*") if unique_orders else F.count_distinct("order_id")
    return txn.groupBy("customer_id").agg(
        orders.alias("total_transaction"), money_sum(F.col("amount")).alias("total_price")
    )


def population(base: DataFrame) -> DataFrame:
    """One row: customers, those who bought more than once, repeat and churn rate."""
    counted = base.agg(
        F.count("*").alias("total_number_of_customers"),
        F.count_if(F.col("total_transaction") > 1).alias("repeat_customers"),
    )
    repeat_rate = F.try_divide("repeat_customers", "total_number_of_customers")
    return counted.withColumn("repeat_rate", repeat_rate).withColumn(
        "churn_rate", 1 - F.col("repeat_rate")
    )


def _figure(pop: DataFrame | Row, name: str) -> Column:
    """A figure of the population, as a subquery or, where it is known, a constant."""
    if isinstance(pop, DataFrame):
        return pop.select(name).scalar()
    return F.lit(pop[name]).cast("double" if name.endswith("rate") else "bigint")


def with_aov(base: DataFrame) -> DataFrame:
    return base.withColumn(
        "average_order_value", F.col("total_price") / F.col("total_transaction")
    )


def with_frequency(base: DataFrame, pop: DataFrame | Row) -> DataFrame:
    """Purchase frequency: the customer's orders over the number of all customers."""
    customers = _figure(pop, "total_number_of_customers")
    return base.withColumn("purchase_frequency", F.col("total_transaction") / customers)


def with_margin(base: DataFrame, rate: float = 0.10) -> DataFrame:
    """Profit margin as an amount of money per customer."""
    return base.withColumn("profit_margin", F.col("total_price") * rate)


def with_value(base: DataFrame) -> DataFrame:
    return base.withColumn(
        "customer_value", F.col("average_order_value") * F.col("purchase_frequency")
    )


def with_clv(base: DataFrame, pop: DataFrame | Row) -> DataFrame:
    """Lifetime value; NULL for everyone when no customer has churned."""
    churn = F.nullif(_figure(pop, "churn_rate"), F.lit(0.0))
    return base.withColumn(
        "clv", F.col("customer_value") / churn * F.col("profit_margin")
    )
