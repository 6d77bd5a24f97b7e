"""Registered queries, the SQL each must agree with, and the flagship query.

All queries read the whole tables. Where a cutoff appears it is the question
asked (value as of a date, or a holdout period), not a way to read less.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopworth.functions.models import BgParams, GgParams
from shopworth.operators import bgnbd, descriptive, gammagamma, predicted, rfm, summary
from shopworth.operators.maximum import best_penalty
from shopworth.operators.prepare import cap, drop_returns, order_amounts, prepare, significant
from shopworth.operators.rank import Tile, ntiles, segment
from shopworth.plans import clv, predict_cltv
from shopworth.plans import rfm as rfm_analysis
from shopworth.sources import (
    load_customers,
    load_lines,
    load_orders,
    load_purchase_events,
    pin,
    read_table,
    save,
    scratch_folder,
)

try:
    import corpus_pipeline
    from shopworth.llm import queries as llm
except ImportError as missing:  # both can be left out, what they need can't
    if missing.name not in ("corpus_pipeline", "shopworth.llm", "shopworth.llm.queries"):
        raise
    corpus_pipeline = llm = None

# Published example parameters, and a date that leaves a period
# before it to fit and one after it to check.
BG = BgParams(r=0.243, alpha=4.414, a=0.793, b=2.426)
GG = GgParams(p=6.25, q=3.74, v=154_400.0)
CUTOFF = "1996-01-01"
HOLDOUT_FROM = "2000-01-01"
HORIZON = 26
# Penalties of the fits that are certified: none, and one with an inner maximum.
CERTIFIED = (0.0, 0.03)
HORIZONS = (4, 13, 26, 52)
DISCOUNT = 0.002


def entry(spark: SparkSession) -> DataFrame:
    """Descriptive lifetime value and segment per customer at sf0.001."""
    return clv(load_orders(spark, "/root/testdata/sf0.001", CUTOFF), unique_orders=True)


# --- Preparation -----------------------------------------------------------


def _line_transactions(spark, d):
    return order_amounts(load_orders(spark, d), load_lines(spark, d))


def txn_prepare(spark, d):
    return load_orders(spark, d)


def txn_prepare_cutoff(spark, d):
    return load_orders(spark, d, CUTOFF)


def txn_purchase_events(spark, d):
    return load_purchase_events(spark, d)


def txn_from_lines(spark, d):
    return _line_transactions(spark, d)


def txn_no_returns(spark, d):
    return order_amounts(load_orders(spark, d), drop_returns(load_lines(spark, d)))


def txn_orders_without_returns(spark, d):
    returned = load_lines(spark, d).filter(F.col("return_flag") == "R")
    return drop_returns(load_orders(spark, d), returned)


def txn_capped(spark, d):
    capped = cap(load_orders(spark, d), "amount", 0.01, 0.99)
    return capped.withColumn("amount", F.round("amount", 3))


def data_profile(spark, d):
    orders = read_table(spark, f"{d}/orders.parquet")
    return summary.profile(orders, exact=True).withColumn("mean", F.round("mean", 3))


def top_customers(spark, d):
    return summary.top_k(load_orders(spark, d), "customer_id", 20)


def top_products(spark, d):
    price = F.col("price") * (1 - F.col("discount"))
    return summary.top_k(load_lines(spark, d), "part_id", 20, price)


# --- Descriptive lifetime value --------------------------------------------


def _base(spark, d, cutoff=None):
    return descriptive.customer_base(load_orders(spark, d, cutoff), unique_orders=True)


def _valued(spark, d, cutoff=None):
    base = pin(_base(spark, d, cutoff))
    pop = descriptive.population(base)
    return (
        base.transform(descriptive.with_aov)
        .transform(descriptive.with_frequency, pop)
        .transform(descriptive.with_margin)
        .transform(descriptive.with_value)
        .transform(descriptive.with_clv, pop)
    )


def clv_customer_base(spark, d):
    return _base(spark, d)


def clv_customer_base_lines(spark, d):
    return descriptive.customer_base(_line_transactions(spark, d))


def clv_population(spark, d):
    return descriptive.population(_base(spark, d)).select("total_number_of_customers")


def clv_repeat_churn(spark, d):
    return descriptive.population(_base(spark, d))


def clv_repeat_churn_cutoff(spark, d):
    return descriptive.population(_base(spark, d, CUTOFF))


def clv_aov(spark, d):
    return descriptive.with_aov(_base(spark, d)).select("customer_id", "average_order_value")


def clv_purchase_frequency(spark, d):
    base = pin(_base(spark, d))
    framed = descriptive.with_frequency(base, descriptive.population(base))
    return framed.select("customer_id", "purchase_frequency")


def clv_profit_margin(spark, d):
    return descriptive.with_margin(_base(spark, d)).select("customer_id", "profit_margin")


def clv_customer_value(spark, d):
    return _valued(spark, d).select("customer_id", "customer_value")


def clv_all(spark, d):
    return _valued(spark, d)


def clv_cutoff(spark, d):
    return _valued(spark, d, CUTOFF)


def clv_segments(spark, d):
    return segment(pin(_valued(spark, d)), "clv").select("customer_id", "clv", "segment")


def clv_segment_summary(spark, d):
    return summary.summarise(segment(pin(_valued(spark, d)), "clv"), "segment", ["clv"])


def clv_whole(spark, d):
    return clv(load_orders(spark, d), unique_orders=True)


def clv_whole_cutoff(spark, d):
    return clv(load_orders(spark, d), cutoff=CUTOFF, unique_orders=True)


def clv_text_ids(spark, d):
    orders = read_table(spark, f"{d}/orders.parquet").select(
        F.concat(F.lit("u-"), F.col("o_custkey").cast("string")).alias("who"),
        F.concat(F.lit("C"), F.col("o_orderkey").cast("string")).alias("no"),
        "o_orderdate",
        "o_totalprice",
    )
    mapping = {"customer_id": "who", "order_id": "no", "order_date": "o_orderdate", "amount": "o_totalprice"}
    return descriptive.customer_base(prepare(orders, mapping))


def clv_segments_text(spark, d):
    """Text ids, in whose order ties are cut; values are rounded so that there are many ties."""
    name = F.concat(F.lit("customer no. "), F.col("customer_id").cast("string"))
    named = pin(_valued(spark, d).select(name.alias("customer_id"), F.col("total_transaction").alias("clv")))
    return segment(named, "clv")


def clv_customer_base_repeated(spark, d):
    """Order lines as rows: order ids repeat and are counted once."""
    lines = load_lines(spark, d).withColumn("amount", F.col("price") * (1 - F.col("discount")))
    rows = load_orders(spark, d).drop("amount").join(lines, "order_id")
    return descriptive.customer_base(rows)


# --- RFM -------------------------------------------------------------------


def _metrics(spark, d):
    return rfm.rfm_metrics(load_orders(spark, d), unique_orders=True)


def rfm_metrics(spark, d):
    return _metrics(spark, d)


def rfm_metrics_events(spark, d):
    return rfm.rfm_metrics(load_purchase_events(spark, d), unique_orders=True)


def ntile_frequency(spark, d):
    tiled = ntiles(pin(_base(spark, d)), "customer_id", {"tile": Tile("total_transaction", 5)})
    return tiled.select("customer_id", "total_transaction", "tile")


def ntile_monetary(spark, d):
    tile = Tile("total_price", 10, desc=True)
    tiled = ntiles(pin(_base(spark, d)), "customer_id", {"tile": tile})
    return tiled.select("customer_id", "total_price", "tile")


def rfm_scores(spark, d):
    return rfm.rfm_scores(_metrics(spark, d))


def rfm_scores_edges(spark, d):
    return rfm.rfm_scores_edges(_metrics(spark, d))


def rfm_segments(spark, d):
    return rfm.rfm_segments(rfm.rfm_scores(_metrics(spark, d)))


def rfm_segment_analysis(spark, d):
    return summary.summarise(
        rfm_segments(spark, d), "segment", ["recency_days", "frequency", "monetary"]
    )


def rfm_segment_customers(spark, d):
    return rfm.customers_in(rfm_segments(spark, d), "champions", load_customers(spark, d))


def rfm_whole(spark, d):
    return rfm_analysis(load_orders(spark, d), unique_orders=True)


def rfm_whole_cutoff(spark, d):
    return rfm_analysis(load_orders(spark, d), HOLDOUT_FROM, unique_orders=True)


def rfm_saved(spark, d):
    """Segments as the sink wrote them, read back."""
    path = f"{scratch_folder(spark)}/saved-{uuid.uuid4().hex}"
    save(rfm_segments(spark, d), path)
    return read_table(spark, path)


def rfm_whole_events(spark, d):
    return rfm_analysis(load_purchase_events(spark, d), unique_orders=True)


# --- Predicted lifetime value ----------------------------------------------


def _occasions(spark, d):
    return bgnbd.occasions(load_orders(spark, d))


def _summary(spark, d, **options):
    return bgnbd.bg_summary(_occasions(spark, d), **options)


def bg_occasions(spark, d):
    return _occasions(spark, d)


def bg_summary(spark, d):
    return _summary(spark, d)


def bg_summary_first(spark, d):
    return _summary(spark, d, include_first=True)


def bg_stats(spark, d):
    return bgnbd.bg_stats(_summary(spark, d))


def bg_loglik(spark, d):
    stats = pin(bgnbd.bg_stats(_summary(spark, d)))
    return bgnbd.bg_loglik(stats, BG).withColumn("loglik", F.round("loglik", 4))


def _fit_frame(spark, names, found):
    columns = ", ".join(f"{name} double" for name in names)
    row = [*found.theta, -found.value, found.n_iter, found.converged, found.at_bound]
    schema = f"{columns}, nll double, n_iter int, converged boolean, at_bound boolean"
    return spark.createDataFrame([tuple(row)], schema)


def _slopes_frame(spark, names, found):
    """The log-likelihood and its slopes, per relative change of each parameter."""
    values = BG if names == BgParams._fields else GG
    slopes = [round(float(g * v), 1) for g, v in zip(found.gradient, values)]
    schema = ", ".join(f"{name} double" for name in ("loglik", *(f"by_{name}" for name in names)))
    return spark.createDataFrame([(round(found.value, 3), *slopes)], schema)


def bg_slopes(spark, d):
    stats = pin(bgnbd.bg_stats(_summary(spark, d)))
    return _slopes_frame(spark, BgParams._fields, bgnbd.bg_slopes(stats, BG))


def gg_slopes(spark, d):
    return _slopes_frame(spark, GgParams._fields, gammagamma.gg_slopes(_summary(spark, d), GG))


def bg_fit(spark, d):
    return _fit_frame(spark, BgParams._fields, bgnbd.bg_fit(bgnbd.bg_stats(_summary(spark, d))))


def _certificate_frame(spark, fitted):
    """One row per fit and parameter: what speaks for the fit being a maximum."""
    rows = [
        (fit.penalty, *check, found.loglik, found.gain, found.steepest, found.certified)
        for fit, found in fitted
        for check in found.checks
    ]
    schema = (
        "penalty double, parameter string, value double, bound string, slope double, curvature double, "
        "below double, above double, pushed boolean, loglik double, gain double, steepest double, certified boolean"
    )
    return spark.createDataFrame(rows, schema)


def bg_certificate(spark, d):
    stats = pin(bgnbd.bg_stats(_summary(spark, d)))
    fits = [bgnbd.bg_fit(stats, penalty=weight) for weight in CERTIFIED]
    return _certificate_frame(spark, [(fit, bgnbd.bg_certificate(stats, fit)) for fit in fits])


def gg_certificate(spark, d):
    rows = pin(_summary(spark, d))
    fits = [gammagamma.gg_fit(rows, penalty=weight) for weight in CERTIFIED]
    return _certificate_frame(spark, [(fit, gammagamma.gg_certificate(rows, fit)) for fit in fits])


def _penalty_frame(spark, names, trials):
    best = best_penalty(trials)
    rows = [
        (t.penalty, *t.fit.theta, t.fit.at_bound, t.fit.converged, t.fit.value, t.holdout, t.penalty == best)
        for t in trials
    ]
    columns = ", ".join(f"{name} double" for name in names)
    schema = f"penalty double, {columns}, at_bound boolean, converged boolean, loglik double, holdout double, chosen boolean"
    return spark.createDataFrame(rows, schema)


def bg_penalties(spark, d):
    return _penalty_frame(spark, BgParams._fields, bgnbd.bg_penalties(_summary(spark, d)))


def gg_penalties(spark, d):
    return _penalty_frame(spark, GgParams._fields, gammagamma.gg_penalties(_summary(spark, d)))


def bg_expected(spark, d):
    expected = bgnbd.bg_expected(_summary(spark, d), BG, HORIZONS)
    return expected.select(
        "customer_id", "horizon", F.round("expected_purchases", 6).alias("expected_purchases")
    )


def bg_alive(spark, d):
    alive = bgnbd.bg_alive(_summary(spark, d), BG)
    return alive.select("customer_id", F.round("p_alive", 8).alias("p_alive"))


def bg_total(spark, d):
    total = bgnbd.bg_total(bgnbd.bg_expected(_summary(spark, d), BG, HORIZONS))
    return total.withColumn("expected_purchases", F.round("expected_purchases", 4))


def bg_holdout(spark, d):
    held = bgnbd.bg_holdout(_occasions(spark, d), HOLDOUT_FROM, HORIZON, BG)
    return held.withColumn("predicted", F.round("predicted", 5))


def gg_check(spark, d):
    return gammagamma.gg_check(_summary(spark, d)).withColumn(
        "correlation", F.round("correlation", 8)
    )


def gg_loglik(spark, d):
    return gammagamma.gg_loglik(_summary(spark, d), GG).withColumn(
        "loglik", F.round("loglik", 3)
    )


def gg_fit(spark, d):
    return _fit_frame(spark, GgParams._fields, gammagamma.gg_fit(_summary(spark, d)))


def gg_expected(spark, d):
    return gammagamma.gg_expected(_summary(spark, d), GG).select(
        "customer_id", F.round("expected_average_profit", 3).alias("expected_average_profit")
    )


def gg_expected_first(spark, d):
    first = _summary(spark, d, include_first=True)
    return gammagamma.gg_expected(first, GG, count="m_count").select(
        "customer_id", F.round("expected_average_profit", 3).alias("expected_average_profit")
    )


def _rounded_cltv(df, *more):
    return df.select(
        "customer_id",
        F.round("expected_purchases", 6).alias("expected_purchases"),
        F.round("expected_average_profit", 3).alias("expected_average_profit"),
        F.round("cltv", 2).alias("cltv"),
        *more,
    )


def cltv(spark, d):
    return _rounded_cltv(predicted.cltv(_summary(spark, d), BG, GG, HORIZON))


def cltv_discounted(spark, d):
    return _rounded_cltv(predicted.cltv(_summary(spark, d), BG, GG, HORIZON, DISCOUNT))


def _labelled(spark, d):
    return segment(pin(predicted.cltv(_summary(spark, d), BG, GG, HORIZON)), "cltv")


def cltv_segments(spark, d):
    return _rounded_cltv(_labelled(spark, d), "segment")


def cltv_segment_summary(spark, d):
    summed = summary.summarise(_labelled(spark, d), "segment", ["cltv"])
    ends = {name: significant(F.col(name), 9) for name in ("cltv_min", "cltv_max")}
    return summed.withColumns(ends)


def cltv_whole(spark, d):
    valued = predict_cltv(load_orders(spark, d), HORIZON, None, DISCOUNT, bg=BG, gg=GG)
    return _rounded_cltv(valued, "segment")


def cltv_whole_cutoff(spark, d):
    valued = predict_cltv(load_orders(spark, d), HORIZON, HOLDOUT_FROM, DISCOUNT, bg=BG, gg=GG)
    return _rounded_cltv(valued, "segment")


def cltv_horizons(spark, d):
    valued = predict_cltv(load_orders(spark, d), HORIZONS, bg=BG, gg=GG)
    return _rounded_cltv(valued, "horizon", "segment")


def cltv_fitted(spark, d):
    return predict_cltv(load_orders(spark, d), HORIZON)


def cltv_fitted_penalised(spark, d):
    return predict_cltv(load_orders(spark, d), HORIZON, penalty="holdout")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Every registered query by name."""
    registered = {
        "txn_prepare": txn_prepare,
        "txn_prepare_cutoff": txn_prepare_cutoff,
        "txn_purchase_events": txn_purchase_events,
        "txn_from_lines": txn_from_lines,
        "txn_no_returns": txn_no_returns,
        "txn_orders_without_returns": txn_orders_without_returns,
        "txn_capped": txn_capped,
        "data_profile": data_profile,
        "top_customers": top_customers,
        "top_products": top_products,
        "clv_customer_base": clv_customer_base,
        "clv_customer_base_lines": clv_customer_base_lines,
        "clv_population": clv_population,
        "clv_repeat_churn": clv_repeat_churn,
        "clv_repeat_churn_cutoff": clv_repeat_churn_cutoff,
        "clv_aov": clv_aov,
        "clv_purchase_frequency": clv_purchase_frequency,
        "clv_profit_margin": clv_profit_margin,
        "clv_customer_value": clv_customer_value,
        "clv": clv_all,
        "clv_cutoff": clv_cutoff,
        "clv_segments": clv_segments,
        "clv_segment_summary": clv_segment_summary,
        "clv_whole": clv_whole,
        "clv_whole_cutoff": clv_whole_cutoff,
        "clv_text_ids": clv_text_ids,
        "clv_segments_text": clv_segments_text,
        "clv_customer_base_repeated": clv_customer_base_repeated,
        "rfm_metrics": rfm_metrics,
        "rfm_metrics_events": rfm_metrics_events,
        "ntile_frequency": ntile_frequency,
        "ntile_monetary": ntile_monetary,
        "rfm_scores": rfm_scores,
        "rfm_scores_edges": rfm_scores_edges,
        "rfm_segments": rfm_segments,
        "rfm_segment_analysis": rfm_segment_analysis,
        "rfm_segment_customers": rfm_segment_customers,
        "rfm_whole": rfm_whole,
        "rfm_whole_cutoff": rfm_whole_cutoff,
        "rfm_saved": rfm_saved,
        "rfm_whole_events": rfm_whole_events,
        "bg_occasions": bg_occasions,
        "bg_summary": bg_summary,
        "bg_summary_first": bg_summary_first,
        "bg_stats": bg_stats,
        "bg_loglik": bg_loglik,
        "bg_slopes": bg_slopes,
        "gg_slopes": gg_slopes,
        "bg_fit": bg_fit,
        "bg_certificate": bg_certificate,
        "bg_penalties": bg_penalties,
        "bg_expected": bg_expected,
        "bg_alive": bg_alive,
        "bg_total": bg_total,
        "bg_holdout": bg_holdout,
        "gg_check": gg_check,
        "gg_loglik": gg_loglik,
        "gg_fit": gg_fit,
        "gg_certificate": gg_certificate,
        "gg_penalties": gg_penalties,
        "gg_expected": gg_expected,
        "gg_expected_first": gg_expected_first,
        "cltv": cltv,
        "cltv_discounted": cltv_discounted,
        "cltv_segments": cltv_segments,
        "cltv_segment_summary": cltv_segment_summary,
        "cltv_whole": cltv_whole,
        "cltv_whole_cutoff": cltv_whole_cutoff,
        "cltv_horizons": cltv_horizons,
        "cltv_fitted": cltv_fitted,
        "cltv_fitted_penalised": cltv_fitted_penalised,
    }
    return registered | (llm.queries() | {"pipeline": corpus_pipeline.run} if llm else {})


# --- The same questions in SQL ---------------------------------------------

_TXN = """txn AS (
  SELECT o_custkey AS customer_id, o_orderkey AS order_id,
         CAST(o_orderdate AS DATE) AS order_date, o_totalprice AS amount
  FROM orders
  WHERE o_custkey IS NOT NULL AND o_orderkey IS NOT NULL
    AND o_orderdate IS NOT NULL AND o_totalprice > 0 AND NOT isnan(o_totalprice) {where})"""
_ALL = _TXN.format(where="")
_CUT = _TXN.format(where=f"AND CAST(o_orderdate AS DATE) < DATE '{CUTOFF}'")
_HELD = _TXN.format(where=f"AND CAST(o_orderdate AS DATE) < DATE '{HOLDOUT_FROM}'")
_PURCHASES = """txn AS (
  SELECT user_id AS customer_id, event_id AS order_id,
         CAST(ts AS DATE) AS order_date, value AS amount
  FROM events
  WHERE event_type = 'purchase' AND user_id IS NOT NULL AND event_id IS NOT NULL
    AND ts IS NOT NULL AND value > 0 AND NOT isnan(value))"""

_BASE = """base AS (
  SELECT customer_id, count(DISTINCT order_id) AS total_transaction,
         round(sum(amount), 4) AS total_price
  FROM txn GROUP BY customer_id)"""
_POP = """pop AS (
  SELECT total_number_of_customers, repeat_customers, repeat_rate,
         1 - repeat_rate AS churn_rate
  FROM (SELECT count(*) AS total_number_of_customers,
               count(*) FILTER (total_transaction > 1) AS repeat_customers,
               count(*) FILTER (total_transaction > 1) / nullif(count(*), 0)::DOUBLE AS repeat_rate
        FROM base))"""
_VALUED = f"""{_BASE}, {_POP}, rates AS (
  SELECT base.*, total_price / total_transaction AS average_order_value,
         total_transaction / (SELECT total_number_of_customers FROM pop)::DOUBLE
           AS purchase_frequency,
         total_price * 0.10::DOUBLE AS profit_margin
  FROM base), worth AS (
  SELECT *, average_order_value * purchase_frequency AS customer_value FROM rates), valued AS (
  SELECT *, customer_value / nullif((SELECT churn_rate FROM pop), 0) * profit_margin AS clv
  FROM worth)"""
_LABEL = """CASE WHEN {0} IS NOT NULL THEN ['D', 'C', 'B', 'A'][ntile(4) OVER (
    PARTITION BY {0} IS NULL ORDER BY {0}, customer_id)] END AS segment"""
_CLV_SEGMENTS = f"labelled AS (SELECT *, {_LABEL.format('clv')} FROM valued)"


def _significant_sql(value: str, digits: int) -> str:
    places = f"({digits - 1} - floor(log10(abs({value}))))"
    power = f"pow(10::DOUBLE, abs({places}))"
    return f"""(CASE WHEN {value} = 0 THEN {value}
      WHEN {places} < 0 THEN round_even(({value}) / {power}, 0) * {power}
      ELSE round_even(({value}) * {power}, 0) / {power} END)"""


def _summary_sql(table: str, columns: list[str], ends: int = 0) -> str:
    parts = []
    for name in columns:
        total = f"sum({name}::DOUBLE)"
        least, most = f"min({name})", f"max({name})"
        if ends:
            least, most = _significant_sql(least, ends), _significant_sql(most, ends)
        parts.append(
            f"{_significant_sql(total, 12)} AS {name}_sum, "
            f"{_significant_sql(total, 12)} / count({name}) AS {name}_mean, "
            f"{least} AS {name}_min, {most} AS {name}_max"
        )
    return f"""SELECT segment, count(*) AS customers,
      count(*) / (SELECT count(*) FROM {table})::DOUBLE AS share, {', '.join(parts)}
      FROM {table} GROUP BY segment"""


_LINE_AMOUNTS = """per_order AS (
  SELECT l_orderkey AS order_id, round(sum(l_extendedprice * (1 - l_discount)), 4) AS amount
  FROM lineitem {where} GROUP BY l_orderkey)"""
_LINE_TXN = """SELECT customer_id, txn.order_id, order_date, per_order.amount
  FROM txn JOIN per_order ON txn.order_id = per_order.order_id"""


def _profile_sql() -> str:
    texts = ("o_orderdate", "o_orderstatus", "o_orderpriority")
    parts = []
    for name in ("o_orderkey", "o_custkey", "o_totalprice", *texts):
        text = f"CAST({name} AS DECIMAL(28, 4))" if name == "o_totalprice" else name
        mean = "CAST(NULL AS DOUBLE)" if name in texts else f"round(avg({name}), 3)"
        parts.append(
            f"""SELECT '{name}' AS "column", count(*) AS rows,
              count(*) FILTER ({name} IS NULL) AS nulls, count(DISTINCT {name}) AS distinct_values,
              CAST(min({text}) AS VARCHAR) AS least, CAST(max({text}) AS VARCHAR) AS greatest,
              {mean} AS mean FROM orders"""
        )
    return " UNION ALL ".join(parts)


_METRICS = """metrics AS (
  SELECT customer_id,
         CAST(date_diff('day', max(order_date), {day}) AS INTEGER) AS recency_days,
         count(DISTINCT order_id) AS frequency, round(sum(amount), 4) AS monetary
  FROM txn GROUP BY customer_id)"""
_LAST_METRICS = _METRICS.format(day="(SELECT max(order_date) + 1 FROM txn)")
_SCORES = """scores AS (
  SELECT *, CAST(r_score AS VARCHAR) || CAST(f_score AS VARCHAR) AS rf_score,
         CAST(r_score AS VARCHAR) || CAST(f_score AS VARCHAR) || CAST(m_score AS VARCHAR)
           AS rfm_score
  FROM (SELECT *,
      CAST(ntile(5) OVER (ORDER BY recency_days DESC, customer_id) AS INTEGER) AS r_score,
      CAST(ntile(5) OVER (ORDER BY frequency, customer_id) AS INTEGER) AS f_score,
      CAST(ntile(5) OVER (ORDER BY monetary, customer_id) AS INTEGER) AS m_score
    FROM metrics))"""
_SEGMENTS = """segments AS (
  SELECT *, CASE
      WHEN r_score <= 2 AND f_score <= 2 THEN 'hibernating'
      WHEN r_score <= 2 AND f_score <= 4 THEN 'at_risk'
      WHEN r_score <= 2 THEN 'cant_lose'
      WHEN r_score = 3 AND f_score <= 2 THEN 'about_to_sleep'
      WHEN r_score = 3 AND f_score = 3 THEN 'need_attention'
      WHEN f_score >= 4 AND r_score = 5 THEN 'champions'
      WHEN f_score >= 4 THEN 'loyal'
      WHEN f_score >= 2 THEN 'potential_loyalist'
      WHEN r_score = 4 THEN 'promising'
      ELSE 'new' END AS segment
  FROM scores)"""


def _edge_scores_sql() -> str:
    edges, scores = [], []
    for name, score, sign in (
        ("recency_days", "r_score", "<"),
        ("frequency", "f_score", ">"),
        ("monetary", "m_score", ">"),
    ):
        cuts = [f"quantile_cont(CAST({name} AS DOUBLE), {i / 5}) AS {score}{i}" for i in range(1, 5)]
        edges += cuts
        steps = " + ".join(f"CAST({name} {sign} {score}{i} AS INTEGER)" for i in range(1, 5))
        scores.append(f"CAST(1 + {steps} AS INTEGER) AS {score}")
    return f"""WITH {_ALL}, {_LAST_METRICS}, edges AS (SELECT {', '.join(edges)} FROM metrics),
      scored AS (SELECT metrics.*, {', '.join(scores)} FROM metrics, edges)
      SELECT *, CAST(r_score AS VARCHAR) || CAST(f_score AS VARCHAR) AS rf_score,
             CAST(r_score AS VARCHAR) || CAST(f_score AS VARCHAR) || CAST(m_score AS VARCHAR)
               AS rfm_score FROM scored"""


_OCC = """occ AS (
  SELECT customer_id, order_date, round(sum(amount), 4) AS amount
  FROM txn GROUP BY customer_id, order_date)"""
_SUMMARY = """history AS (
  SELECT customer_id, count(*) AS purchases, min(order_date) AS first_day,
         max(order_date) AS last_day, sum(amount) AS total,
         arg_min(amount, order_date) AS first_amount
  FROM occ GROUP BY customer_id), summary AS (
  SELECT customer_id, purchases - 1 AS x,
         CAST(date_diff('day', first_day, last_day) AS INTEGER) AS tx_days,
         CAST(date_diff('day', first_day, {day}) AS INTEGER) AS age_days,
         date_diff('day', first_day, last_day) / 7::DOUBLE AS tx,
         date_diff('day', first_day, {day}) / 7::DOUBLE AS age,
         round(total - first_amount, 4) / nullif(purchases - 1, 0) AS m
  FROM history)"""
_LAST_SUMMARY = f"""{_OCC}, {_SUMMARY.format(day="(SELECT max(order_date) + 1 FROM occ)")}"""
_R, _ALPHA, _A, _B = (f"{value}::DOUBLE" for value in BG)
_P, _Q, _V = (f"{value}::DOUBLE" for value in GG)
_LOGIT = (
    f"(ln({_A}) - ln({_B} + x - 1) + ({_R} + x) * (ln({_ALPHA} + age) - ln({_ALPHA} + tx)))"
)
_ALIVE = f"(CASE WHEN x > 0 THEN 1 / (1 + exp({_LOGIT})) ELSE 1 END)"


def _series_sql(source: str, horizon: str) -> str:
    """Expected purchases if alive as ``if_alive``, by the series as published.

    Its terms are all positive but rise before they fall, so it takes many more
    of them than the transformed series on the Spark side.
    """
    z = f"({horizon} / ({_ALPHA} + age + {horizon}))"
    return f"""(SELECT *, ({_A} + {_B} + x - 1) / ({_A} - 1) * (1 - pow(1 - z, {_R} + x) *
        list_reduce(list_prepend(1::DOUBLE, range(1500, -1, -1)::DOUBLE[]),
          lambda tail, k: 1 + ({_R} + x + k) * ({_B} + x + k)
            / (({_A} + {_B} + x - 1 + k) * (k + 1)) * z * tail)) AS if_alive
      FROM (SELECT *, {z} AS z FROM {source}))"""


_HORIZON_ROWS = (
    "(SELECT *, unnest([" + ", ".join(f"{h}::DOUBLE" for h in HORIZONS) + "]) AS horizon FROM summary)"
)
_EXPECTED = f"""expected AS (
  SELECT *, if_alive * {_ALIVE} AS expected_purchases FROM {_series_sql(_HORIZON_ROWS, 'horizon')})"""


def _mean_value_sql(count: str) -> str:
    return (
        f"(CASE WHEN {count} > 0 THEN {_P} * ({_V} + {count} * m) / ({_P} * {count} + {_Q} - 1) "
        f"ELSE {_P} * {_V} / ({_Q} - 1) END)"
    )


_CLTV_COLUMNS = """customer_id, round(expected_purchases, 6) AS expected_purchases,
  round(expected_average_profit, 3) AS expected_average_profit, round(cltv, 2) AS cltv"""
_CLTV = f"""predicted AS (
  SELECT *, expected_purchases * expected_average_profit AS cltv
  FROM (SELECT *, if_alive * {_ALIVE} AS expected_purchases,
               {_mean_value_sql('x')} AS expected_average_profit
        FROM {_series_sql('summary', f'{HORIZON}::DOUBLE')}))"""
_PERIOD_ROWS = f"(SELECT *, unnest(range(1, {HORIZON} + 1)) AS period FROM summary)"
_CLTV_DISCOUNTED = f"""periods AS (
  SELECT *, if_alive * {_ALIVE} AS upto, {_mean_value_sql('x')} AS expected_average_profit
  FROM {_series_sql(_PERIOD_ROWS, 'period::DOUBLE')}), gains AS (
  SELECT *, upto - coalesce(lag(upto) OVER (PARTITION BY customer_id ORDER BY period), 0) AS gain
  FROM periods), predicted AS (
  SELECT customer_id, max(upto) AS expected_purchases,
         any_value(expected_average_profit) AS expected_average_profit,
         any_value(expected_average_profit)
           * sum(gain / pow(1 + {DISCOUNT}::DOUBLE, period)) AS cltv
  FROM gains GROUP BY customer_id)"""


def _slopes_sql(params, term: str) -> str:
    """Slopes by central differences: the likelihood with each parameter a little up and down."""
    step = 1e-4
    rows = [("loglik", *params)]
    for i, name in enumerate(params._fields):
        for sign in (1, -1):
            moved = [v * (1 + sign * step) if j == i else v for j, v in enumerate(params)]
            rows.append((f"{name}{sign}", *moved))
    values = ", ".join(f"('{r[0]}', {', '.join(f'{v!r}::DOUBLE' for v in r[1:])})" for r in rows)
    names = ", ".join(f"p_{name}" for name in params._fields)
    slopes = ", ".join(
        f"round((max(ll) FILTER (name = '{n}1') - max(ll) FILTER (name = '{n}-1')) / {2 * step}, 1) AS by_{n}"
        for n in params._fields
    )
    return f"""shifts AS (SELECT * FROM (VALUES {values}) AS v(name, {names})),
      lls AS (SELECT name, sum({term}) AS ll FROM shifts, summary GROUP BY name)
      SELECT round(max(ll) FILTER (name = 'loglik'), 3) AS loglik, {slopes} FROM lls"""


_BG_TERM = """lgamma(p_r + x) - lgamma(p_r) + p_r * ln(p_alpha)
  + lgamma(p_a + p_b) + lgamma(p_b + x) - lgamma(p_b) - lgamma(p_a + p_b + x)
  - (p_r + x) * ln(p_alpha + age) + CASE WHEN x > 0 THEN ln(1 + exp(
    ln(p_a) - ln(p_b + x - 1) + (p_r + x) * (ln(p_alpha + age) - ln(p_alpha + tx)))) ELSE 0 END"""
_GG_TERM = """CASE WHEN x > 0 AND m > 0 THEN lgamma(p_p * x + p_q) - lgamma(p_p * x) - lgamma(p_q)
  + p_q * ln(p_v) + (p_p * x - 1) * ln(m) + p_p * x * ln(x)
  - (p_p * x + p_q) * ln(x * m + p_v) ELSE 0 END"""


def oracle_sql() -> dict[str, str]:
    """The SQL of every registered query but the fits, which SQL cannot express."""
    valued = f"WITH {_ALL}, {_VALUED}"
    scores = f"WITH {_ALL}, {_LAST_METRICS}, {_SCORES}"
    segments = f"{scores}, {_SEGMENTS}"
    model = f"WITH {_ALL}, {_LAST_SUMMARY}"
    labelled = f"""rounded AS (SELECT {_CLTV_COLUMNS}, segment
      FROM (SELECT *, {_LABEL.format('cltv')} FROM predicted))"""
    registered = {
        "txn_prepare": f"WITH {_ALL} SELECT * FROM txn",
        "txn_prepare_cutoff": f"WITH {_CUT} SELECT * FROM txn",
        "txn_purchase_events": f"WITH {_PURCHASES} SELECT * FROM txn",
        "txn_from_lines": f"WITH {_ALL}, {_LINE_AMOUNTS.format(where='')} {_LINE_TXN}",
        "txn_no_returns": f"""WITH {_ALL},
          {_LINE_AMOUNTS.format(where="WHERE l_returnflag IS DISTINCT FROM 'R'")} {_LINE_TXN}""",
        "txn_orders_without_returns": f"""WITH {_ALL} SELECT * FROM txn WHERE NOT EXISTS (
          SELECT 1 FROM lineitem WHERE l_orderkey = order_id AND l_returnflag = 'R')""",
        "txn_capped": f"""WITH {_ALL}, edges AS (
          SELECT quantile_cont(amount, 0.01) AS lo, quantile_cont(amount, 0.99) AS hi FROM txn)
          SELECT customer_id, order_id, order_date,
                 round(least(greatest(amount, lo), hi), 3) AS amount FROM txn, edges""",
        "data_profile": _profile_sql(),
        "top_customers": f"""WITH {_ALL} SELECT customer_id, round(sum(amount), 4) AS total
          FROM txn GROUP BY customer_id ORDER BY total DESC, customer_id LIMIT 20""",
        "top_products": """SELECT l_partkey AS part_id,
          round(sum(l_extendedprice * (1 - l_discount)), 4) AS total
          FROM lineitem GROUP BY l_partkey ORDER BY total DESC, part_id LIMIT 20""",
        "clv_customer_base": f"WITH {_ALL}, {_BASE} SELECT * FROM base",
        "clv_customer_base_lines": f"""WITH {_ALL}
          SELECT customer_id, count(DISTINCT order_id) AS total_transaction,
                 round(sum(l_extendedprice * (1 - l_discount)), 4) AS total_price
          FROM txn JOIN lineitem ON l_orderkey = order_id GROUP BY customer_id""",
        "clv_population": f"""WITH {_ALL}, {_BASE}, {_POP}
          SELECT total_number_of_customers FROM pop""",
        "clv_repeat_churn": f"WITH {_ALL}, {_BASE}, {_POP} SELECT * FROM pop",
        "clv_repeat_churn_cutoff": f"WITH {_CUT}, {_BASE}, {_POP} SELECT * FROM pop",
        "clv_aov": f"{valued} SELECT customer_id, average_order_value FROM rates",
        "clv_purchase_frequency": f"{valued} SELECT customer_id, purchase_frequency FROM rates",
        "clv_profit_margin": f"{valued} SELECT customer_id, profit_margin FROM rates",
        "clv_customer_value": f"{valued} SELECT customer_id, customer_value FROM worth",
        "clv": f"{valued} SELECT * FROM valued",
        "clv_cutoff": f"WITH {_CUT}, {_VALUED} SELECT * FROM valued",
        "clv_segments": f"{valued}, {_CLV_SEGMENTS} SELECT customer_id, clv, segment FROM labelled",
        "clv_segment_summary": f"{valued}, {_CLV_SEGMENTS} {_summary_sql('labelled', ['clv'])}",
        "clv_whole": f"{valued}, {_CLV_SEGMENTS} SELECT * FROM labelled",
        "clv_whole_cutoff": f"WITH {_CUT}, {_VALUED}, {_CLV_SEGMENTS} SELECT * FROM labelled",
        "clv_segments_text": f"""{valued}, named AS (
          SELECT 'customer no. ' || customer_id AS customer_id, total_transaction AS clv FROM valued)
          SELECT *, {_LABEL.format('clv')} FROM named""",
        "clv_text_ids": f"""WITH {_ALL} SELECT 'u-' || customer_id AS customer_id,
          count(DISTINCT 'C' || order_id) AS total_transaction, round(sum(amount), 4) AS total_price
          FROM txn GROUP BY customer_id""",
        "clv_customer_base_repeated": f"""WITH {_ALL} SELECT customer_id,
          count(DISTINCT order_id) AS total_transaction,
          round(sum(l_extendedprice * (1 - l_discount)), 4) AS total_price
          FROM txn JOIN lineitem ON order_id = l_orderkey GROUP BY customer_id""",
        "rfm_metrics": f"WITH {_ALL}, {_LAST_METRICS} SELECT * FROM metrics",
        "rfm_metrics_events": f"WITH {_PURCHASES}, {_LAST_METRICS} SELECT * FROM metrics",
        "ntile_frequency": f"""WITH {_ALL}, {_BASE} SELECT customer_id, total_transaction,
          CAST(ntile(5) OVER (ORDER BY total_transaction, customer_id) AS INTEGER) AS tile
          FROM base""",
        "ntile_monetary": f"""WITH {_ALL}, {_BASE} SELECT customer_id, total_price,
          CAST(ntile(10) OVER (ORDER BY total_price DESC, customer_id) AS INTEGER) AS tile
          FROM base""",
        "rfm_scores": f"{scores} SELECT * FROM scores",
        "rfm_scores_edges": _edge_scores_sql(),
        "rfm_segments": f"{segments} SELECT * FROM segments",
        "rfm_segment_analysis": segments
        + " "
        + _summary_sql("segments", ["recency_days", "frequency", "monetary"]),
        "rfm_segment_customers": f"""{segments} SELECT segments.*, c_name AS name,
          c_nationkey AS nation_id, c_mktsegment AS market_segment
          FROM segments JOIN customer ON c_custkey = customer_id WHERE segment = 'champions'""",
        "rfm_whole": f"{segments} SELECT * FROM segments",
        "rfm_saved": f"{segments} SELECT * FROM segments",
        "rfm_whole_cutoff": f"""WITH {_HELD}, {_METRICS.format(day=f"DATE '{HOLDOUT_FROM}'")},
          {_SCORES}, {_SEGMENTS} SELECT * FROM segments""",
        "rfm_whole_events": f"""WITH {_PURCHASES}, {_LAST_METRICS}, {_SCORES}, {_SEGMENTS}
          SELECT * FROM segments""",
        "bg_occasions": f"WITH {_ALL}, {_OCC} SELECT * FROM occ",
        "bg_summary": f"{model} SELECT * FROM summary",
        "bg_summary_first": f"""{model} SELECT summary.* EXCLUDE (m),
          round(total, 4) / purchases AS m, purchases AS m_count
          FROM summary JOIN history USING (customer_id)""",
        "bg_stats": f"""{model} SELECT x, tx_days, age_days, count(*) AS customers
          FROM summary GROUP BY x, tx_days, age_days""",
        "bg_loglik": f"""{model} SELECT count(*) AS customers, round(sum(
            lgamma({_R} + x) - lgamma({_R}) + {_R} * ln({_ALPHA})
            + lgamma({_B} + x) - lgamma({_A} + {_B} + x) - lgamma({_B}) + lgamma({_A} + {_B})
            - ({_R} + x) * ln({_ALPHA} + age)
            + CASE WHEN x > 0 THEN ln(1 + exp({_LOGIT})) ELSE 0 END), 4) AS loglik
          FROM summary""",
        "bg_expected": f"""{model}, {_EXPECTED} SELECT customer_id, horizon,
          round(expected_purchases, 6) AS expected_purchases FROM expected""",
        "bg_alive": f"{model} SELECT customer_id, round({_ALIVE}, 8) AS p_alive FROM summary",
        "bg_total": f"""{model}, {_EXPECTED} SELECT horizon, count(*) AS customers,
          round(sum(expected_purchases), 4) AS expected_purchases
          FROM expected GROUP BY horizon""",
        "bg_holdout": f"""WITH {_ALL}, all_occ AS (
            SELECT DISTINCT customer_id, order_date FROM txn), calibration AS (
            SELECT customer_id, count(*) - 1 AS x,
                   date_diff('day', min(order_date), max(order_date)) / 7::DOUBLE AS tx,
                   date_diff('day', min(order_date), DATE '{HOLDOUT_FROM}') / 7::DOUBLE AS age
            FROM all_occ WHERE order_date < DATE '{HOLDOUT_FROM}' GROUP BY customer_id), later AS (
            SELECT customer_id, count(*) AS purchases FROM all_occ
            WHERE order_date >= DATE '{HOLDOUT_FROM}'
              AND order_date < DATE '{HOLDOUT_FROM}' + {HORIZON * 7} GROUP BY customer_id)
          SELECT x, count(*) AS customers, round(sum(if_alive * {_ALIVE}), 5) AS predicted,
                 CAST(sum(coalesce(purchases, 0)) AS BIGINT) AS actual
          FROM {_series_sql('calibration', f'{HORIZON}::DOUBLE')} AS c
          LEFT JOIN later USING (customer_id) GROUP BY x""",
        "bg_slopes": f"{model}, {_slopes_sql(BG, _BG_TERM)}",
        "gg_slopes": f"{model}, {_slopes_sql(GG, _GG_TERM)}",
        "gg_check": f"""{model} SELECT count(*) AS customers, round(corr(x, m), 8) AS correlation
          FROM summary WHERE x > 0""",
        "gg_loglik": f"""{model} SELECT count(*) AS customers, round(sum(
            lgamma({_P} * x + {_Q}) - lgamma({_P} * x) - lgamma({_Q}) + {_Q} * ln({_V})
            + ({_P} * x - 1) * ln(m) + {_P} * x * ln(x)
            - ({_P} * x + {_Q}) * ln(x * m + {_V})), 3) AS loglik
          FROM summary WHERE x > 0""",
        "gg_expected": f"""{model} SELECT customer_id,
          round({_mean_value_sql('x')}, 3) AS expected_average_profit FROM summary""",
        "gg_expected_first": f"""{model}, firsts AS (
            SELECT customer_id, purchases, round(total, 4) / purchases AS m FROM history)
          SELECT customer_id, round({_mean_value_sql('purchases')}, 3) AS expected_average_profit
          FROM firsts""",
        "cltv": f"{model}, {_CLTV} SELECT {_CLTV_COLUMNS} FROM predicted",
        "cltv_discounted": f"{model}, {_CLTV_DISCOUNTED} SELECT {_CLTV_COLUMNS} FROM predicted",
        "cltv_segments": f"{model}, {_CLTV}, {labelled} SELECT * FROM rounded",
        "cltv_segment_summary": f"""{model}, {_CLTV}, labelled AS (
            SELECT *, {_LABEL.format('cltv')} FROM predicted)
          {_summary_sql('labelled', ['cltv'], 9)}""",
        "cltv_whole": f"{model}, {_CLTV_DISCOUNTED}, {labelled} SELECT * FROM rounded",
        "cltv_horizons": f"""{model}, {_EXPECTED}, valued AS (
            SELECT *, expected_purchases * expected_average_profit AS cltv
            FROM (SELECT *, {_mean_value_sql('x')} AS expected_average_profit FROM expected))
          SELECT {_CLTV_COLUMNS}, CAST(horizon AS INTEGER) AS horizon, ['D', 'C', 'B', 'A'][ntile(4) OVER (
            PARTITION BY horizon ORDER BY cltv, customer_id)] AS segment FROM valued""",
        "cltv_whole_cutoff": f"""WITH {_HELD}, {_OCC}, {_SUMMARY.format(day=f"DATE '{HOLDOUT_FROM}'")},
          {_CLTV_DISCOUNTED}, {labelled} SELECT * FROM rounded""",
    }
    return registered | (llm.oracle_sql() if llm else {})
