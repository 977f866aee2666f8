"""Every query the library offers by name."""

from zoneflow.plans import analytics, cleaning, forecasting, functions, models  # noqa: F401
from zoneflow.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
