"""Customer-value analytics on Spark DataFrames."""

from shopworth.functions.models import BgParams, GgParams
from shopworth.plans import clv, fitted_cltv, predict_cltv, rfm

__all__ = ["BgParams", "GgParams", "clv", "fitted_cltv", "predict_cltv", "rfm"]
