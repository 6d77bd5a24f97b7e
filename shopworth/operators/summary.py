"""Profiles, top lists and per-segment summaries."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from shopworth.operators.prepare import exact_sum, money_sum, significant



def _as_text(column: Column, kind: str) -> Column:
    if kind in ("double", "float"):
        column = column.cast("decimal(28,4)")
    return column.cast("string")


def profile(df: DataFrame, exact: bool = False) -> DataFrame:
    """Rows, nulls, distinct values, least, greatest and mean value of every column.

    One pass gives all figures, with distinct values from a sketch. ``exact=True``
    counts by value instead: each row becomes one row per column, equal values are
    combined before the one shuffle that carries every distinct value, and the
    table is still read once.
    """
    if exact:
        return _exact_profile(df)
    shown = ("column", "rows", "nulls", "distinct_values", "least", "greatest", "mean")

    def row(name: str, rows: Column, nulls: Column, distinct: Column, ends: list[Column], total: Column) -> Column:
        values = [F.lit(name), rows, nulls, distinct, *ends, F.try_divide(total, rows - nulls)]
        return F.struct(*[value.alias(title) for value, title in zip(values, shown)])

    columns = []
    for field in df.schema.fields:
        column, kind = F.col(field.name), field.dataType.simpleString()
        number = (column if isinstance(field.dataType, NumericType) else F.lit(None)).cast("double")
        ends = [_as_text(F.min(column), kind), _as_text(F.max(column), kind)]
        nulls = F.count_if(column.isNull())
        distinct = F.approx_count_distinct(column)
        columns.append(row(field.name, F.count("*"), nulls, distinct, ends, F.sum(number)))
    return df.agg(F.array(*columns).alias("all")).select(F.inline("all"))


def _exact_profile(df: DataFrame) -> DataFrame:
    fields = df.schema.fields
    types = list(dict.fromkeys(f.dataType.simpleString() for f in fields))  # a slot for each type

    def slots(i: int) -> Column:
        kind = fields[i].dataType.simpleString()
        values = [
            (F.col(f"`{fields[i].name}`") if t == kind else F.lit(None).cast(t)).alias(f"v{j}")
            for j, t in enumerate(types)
        ]
        return F.struct(F.lit(i).alias("c"), *values)

    values = [f"v{j}" for j in range(len(types))]
    unpivoted = df.select(F.inline(F.array(*[slots(i) for i in range(len(fields))])))
    counted = unpivoted.groupBy("c", *values).agg(F.count("*").alias("n"))
    n = F.col("n")
    held = reduce(or_, [F.col(v).isNotNull() for v in values])
    numeric = {f.dataType.simpleString() for f in fields if isinstance(f.dataType, NumericType)}
    totals = [F.sum(F.col(v).cast("double") * n) for v, t in zip(values, types) if t in numeric]
    shown = {
        end: F.coalesce(*[_as_text(f(v), t) for v, t in zip(values, types)])
        for end, f in (("least", F.min), ("greatest", F.max))
    }
    per_column = counted.groupBy("c").agg(
        F.sum("n").alias("rows"),
        F.coalesce(F.sum(F.when(~held, n)), F.lit(0)).alias("nulls"),
        F.count_if(held).alias("distinct_values"),
        *[column.alias(end) for end, column in shown.items()],
        F.coalesce(*totals, F.lit(None).cast("double")).alias("total"),
    )
    names = df.sparkSession.createDataFrame([(i, f.name) for i, f in enumerate(fields)], "c int, column string")
    every = names.join(per_column, "c", "left")  # an empty table still has columns
    counts = [F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in ("rows", "nulls", "distinct_values")]
    mean = F.try_divide("total", F.col("rows") - F.col("nulls"))
    return every.select("column", *counts, "least", "greatest", mean.alias("mean"))


def top_k(df: DataFrame, key: str, k: int, amount: Column | str = "amount") -> DataFrame:
    """The ``k`` keys with the largest total amount, ties by key."""
    amount = F.col(amount) if isinstance(amount, str) else amount
    totals = df.groupBy(key).agg(money_sum(amount).alias("total"))
    return totals.orderBy(F.desc("total"), key).limit(k)


def summarise(df: DataFrame, by: str, columns: Sequence[str]) -> DataFrame:
    """Per group: customers, share of all, and sum, mean, least and greatest of ``columns``.

    Values are added exactly and sums then rounded to significant digits, so
    that sums and means do not depend on the order of partial sums. NaN makes a sum
    NaN. The share divides by the sum of the few group counts.
    """
    measures = [F.count("*").alias("customers")]
    for name in columns:
        measures.append(exact_sum(F.col(name)).alias(f"_{name}_sum"))
        measures.append(F.count(name).alias(f"_{name}_n"))
        measures.append(F.min(name).alias(f"{name}_min"))
        measures.append(F.max(name).alias(f"{name}_max"))
    groups = df.groupBy(by).agg(*measures)
    total = F.sum("customers").over(Window.partitionBy())
    shown = [F.col(by), F.col("customers"), (F.col("customers") / total).alias("share")]
    for name in columns:
        added = significant(F.col(f"_{name}_sum"))
        shown.append(added.alias(f"{name}_sum"))
        shown.append(F.try_divide(added, F.col(f"_{name}_n")).alias(f"{name}_mean"))
        shown += [F.col(f"{name}_min"), F.col(f"{name}_max")]
    return groups.select(*shown)
