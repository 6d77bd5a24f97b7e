"""From raw purchase tables to transactions: one row per purchase.

Transactions have the columns ``customer_id, order_id, order_date, amount``.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopworth.operators.rank import quantiles

# Sums are rounded to this many significant digits. The digits count from the sum's own
# magnitude: no amount is too small for them.
MONEY_DIGITS = 12

# An exact sum adds whole numbers: each value is cut into limbs of so many bits, the first of
# which counts units of 2^24 and the last units of 2^-72.
LIMB_BITS = 24
LIMBS = 5
# Magnitudes from which on all 53 bits of a double lie at or above 2^-72, and up to which the
# first limb is a long; zero is cut exactly too.
LEAST_EXACT = 2.0**-20
MOST_EXACT = 2.0**86

# Ids stored as text stay text.
TRANSACTION_TYPES = {
    "customer_id": "bigint",
    "order_id": "bigint",
    "order_date": "date",
    "amount": "double",
}


def significant(value: Column, digits: int = MONEY_DIGITS, of: Column | None = None) -> Column:
    """``value`` rounded to the place of the last of ``digits`` digits of ``of``, itself by default.

    Zero, NaN, infinities and NULL stay as they are.
    """
    size = F.abs(value if of is None else of)
    places = F.least(F.lit(digits - 1.0) - F.floor(F.log10(size)), F.lit(300.0))
    # Powers of ten are exact only upwards, so large values are divided first.
    power = F.pow(F.lit(10.0), F.abs(places))
    rounded = F.when(places < 0, F.rint(value / power) * power).otherwise(F.rint(value * power) / power)
    plain = (size == 0) | F.isnan(size) | (size == float("inf"))
    return F.when(plain, value).otherwise(rounded)


def exact_sum(value: Column) -> Column:
    """The sum of doubles, the same whatever the order in which they and partial sums are added.

    Sums of limbs are whole numbers, so no addition rounds; only putting the five sums together
    does, and it always gets the same numbers. About 10^11 rows fit. If any value
    is not finite, of a magnitude of 2^86 or more, or nonzero and under 2^-20 (a millionth), or a limb overflows,
    the result is Spark's own sum. NULLs do not count; without values the sum is NULL.
    """
    value = value.cast("double")
    size = F.abs(value)
    exact = (size == 0) | ((size >= LEAST_EXACT) & (size < MOST_EXACT))  # NaN is greater than any number
    cut, total = F.when(exact, value).otherwise(0.0), F.lit(0.0)
    for place in range(LIMBS):
        unit = 2.0 ** (LIMB_BITS * (1 - place))
        part = cut if place == 0 else cut % (unit * 2.0**LIMB_BITS)  # a remainder is exact
        # The greatest first: limbs of mixed signs cancel before anything can be rounded.
        total = total + F.try_sum((part / unit).cast("bigint")).cast("double") * unit
    return F.when(F.bool_and(exact), F.coalesce(total, F.sum(value))).otherwise(F.sum(value))


def money_sum(amount: Column) -> Column:
    return significant(exact_sum(amount))


def prepare(df: DataFrame, mapping: Mapping[str, str], cutoff=None) -> DataFrame:
    """Rename and cast to transactions; keep complete rows with a positive amount.

    Ids that are text stay text, all others become whole numbers. ``cutoff`` is
    exclusive. The filters fold into the scan.
    """
    missing = [name for name in TRANSACTION_TYPES if name not in mapping]
    missing += [source for source in mapping.values() if source not in df.columns]
    if missing:
        raise ValueError(f"no column for: {', '.join(missing)}")
    # Filters on the columns as stored reach the scan; casts may add further nulls.
    for source in mapping.values():
        df = df.filter(F.col(source).isNotNull())
    stored = dict(df.dtypes)
    kinds = {
        name: "string" if kind == "bigint" and stored[mapping[name]] == "string" else kind
        for name, kind in TRANSACTION_TYPES.items()
    }
    txn = df.select(*[F.col(mapping[name]).cast(kind).alias(name) for name, kind in kinds.items()])
    for name, kind in kinds.items():
        if stored[mapping[name]] != kind:
            txn = txn.filter(F.col(name).isNotNull())
    txn = txn.filter((F.col("amount") > 0) & ~F.isnan("amount"))
    if cutoff is not None:
        txn = txn.filter(F.col("order_date") < F.lit(cutoff).cast("date"))
    return txn


def order_amounts(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """Transactions whose amount is the discounted sum of the order's lines.

    Lines are summed per order before the join, so only one row per order meets
    the orders and the join reuses the partitioning of the sum. Orders without
    lines have no amount and drop out.
    """
    per_order = lines.groupBy("order_id").agg(
        money_sum(F.col("price") * (1 - F.col("discount"))).alias("amount")
    )
    return (
        orders.select("customer_id", "order_id", "order_date")
        .join(per_order, "order_id")
        .select(*TRANSACTION_TYPES)
    )


def drop_returns(
    df: DataFrame, returns: DataFrame | None = None, key: str = "order_id", flag: str = "R"
) -> DataFrame:
    """Leave out returned purchases: flagged rows, or rows whose key is in ``returns``.

    Keys of ``returns`` are made distinct first, so a key returned very often
    meets the join once.
    """
    if returns is not None:
        return df.join(returns.select(key).distinct(), key, "left_anti")
    return df.filter(~F.col("return_flag").eqNullSafe(flag))


def cap(df: DataFrame, col: str, lo: float, hi: float) -> DataFrame:
    """Pull values beyond the ``lo`` and ``hi`` quantiles in to those quantiles; NULL stays."""
    low, high = quantiles(df, {col: [lo, hi]})[col]
    if low is None:
        return df
    capped = F.least(F.greatest(F.col(col), F.lit(low)), F.lit(high))
    return df.withColumn(col, F.when(F.col(col).isNotNull(), capped))
