"""Runnable plans: the registered queries and the forecasting workflows."""

from . import features, forecasting, learning, order_search, relational  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
