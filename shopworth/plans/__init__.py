"""The three analyses from transactions to labelled customers."""

from shopworth.plans.analyses import Fits, clv, fit_cltv, fitted_cltv, predict_cltv, rfm

__all__ = ["Fits", "clv", "fit_cltv", "fitted_cltv", "predict_cltv", "rfm"]
