"""Recency, frequency and monetary metrics, scores and segments."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopworth.operators.prepare import money_sum
from shopworth.operators.rank import BRACKET_ROWS, Tile, ntiles, quantiles
from shopworth.sources.pinned import pin

# The segment of every (recency score, frequency score).
_FREQUENCY_LABELS = {
    1: ("hibernating", "hibernating", "at_risk", "at_risk", "cant_lose"),
    2: ("hibernating", "hibernating", "at_risk", "at_risk", "cant_lose"),
    3: ("about_to_sleep", "about_to_sleep", "need_attention", "loyal", "loyal"),
    4: ("promising", "potential_loyalist", "potential_loyalist", "loyal", "loyal"),
    5: ("new", "potential_loyalist", "potential_loyalist", "champions", "champions"),
}
DEFAULT_RULES = tuple(
    (r, f, label) for r, labels in _FREQUENCY_LABELS.items() for f, label in enumerate(labels, 1)
)


def rfm_metrics(txn: DataFrame, analysis_date=None, unique_orders: bool = False) -> DataFrame:
    """Days since the last order, distinct orders and total amount per customer.

    The analysis date defaults to the day after the last order of all; orders of a
    given date or later do not count. The customer table is pinned: scoring reads
    it several times.
    """
    if analysis_date is not None:
        txn = txn.filter(F.col("order_date") < F.lit(analysis_date).cast("date"))
    orders = F.count("*") if unique_orders else F.count_distinct("order_id")
    totals = pin(
        txn.groupBy("customer_id").agg(
            F.max("order_date").alias("last_order"),
            orders.alias("frequency"),
            money_sum(F.col("amount")).alias("monetary"),
        )
    )
    if analysis_date is None:
        analysis_date = totals.agg(F.date_add(F.max("last_order"), 1)).first()[0]
    day = F.lit(analysis_date).cast("date")
    return totals.filter(F.col("monetary") > 0).select(
        "customer_id", F.date_diff(day, "last_order").alias("recency_days"), "frequency", "monetary"
    )


def _with_codes(scores: DataFrame) -> DataFrame:
    parts = [F.col(name).cast("string") for name in ("r_score", "f_score", "m_score")]
    return scores.withColumns({"rf_score": F.concat(*parts[:2]), "rfm_score": F.concat(*parts)})


def rfm_scores(metrics: DataFrame, k: int = 5, limit: int = BRACKET_ROWS) -> DataFrame:
    """Scores 1 to ``k`` by n-tile; the most recent, frequent and valuable get ``k``."""
    tiles = {
        "r_score": Tile("recency_days", k, desc=True),
        "f_score": Tile("frequency", k),
        "m_score": Tile("monetary", k),
    }
    return _with_codes(ntiles(metrics, "customer_id", tiles, limit))


def _edge_score(value: Column, edges: Sequence[float], reverse: bool) -> Column:
    score = F.lit(1)
    for edge in edges:
        score = score + ((value < edge) if reverse else (value > edge)).cast("int")
    return score


def rfm_scores_edges(metrics: DataFrame, k: int = 5, limit: int = BRACKET_ROWS) -> DataFrame:
    """Scores by value: cut at the exact quantiles, so equal values share a score."""
    columns = {"r_score": "recency_days", "f_score": "frequency", "m_score": "monetary"}
    cuts = [i / k for i in range(1, k)]
    edges = quantiles(metrics, {name: cuts for name in columns.values()}, limit)
    scores = {}
    for score, name in columns.items():
        known = [edge for edge in edges[name] if edge is not None]
        scores[score] = _edge_score(F.col(name), known, reverse=name == "recency_days")
    return _with_codes(metrics.withColumns(scores))


def rfm_segments(
    scores: DataFrame, rules: Sequence[tuple[int, int, str]] = DEFAULT_RULES
) -> DataFrame:
    """Label customers by recency and frequency score.

    ``rules`` holds one row per pair of scores, so the broadcast side has a
    handful of rows however many customers there are.
    """
    cells = {(r, f) for r, f, _ in rules}
    k = max(max(cell) for cell in cells)
    if len(cells) != len(rules) or len(cells) != k * k:
        raise ValueError("rules need exactly one segment per pair of scores")
    table = scores.sparkSession.createDataFrame(
        list(rules), "r_score int, f_score int, segment string"
    )
    return scores.join(F.broadcast(table), ["r_score", "f_score"], "left").select(
        *scores.columns, "segment"
    )


def customers_in(df: DataFrame, label: str, customers: DataFrame) -> DataFrame:
    """Customers of one segment with their attributes; those without any drop out."""
    return df.filter(F.col("segment") == label).join(customers, "customer_id")
