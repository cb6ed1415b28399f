"""wickline: candle, funding-rate and premium-index analytics on PySpark DataFrames."""

from wickline.session import configure

__all__ = ["configure"]
