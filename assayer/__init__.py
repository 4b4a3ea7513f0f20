"""Table inspection, cleaning, profiling, key discovery and integration on Spark."""

from assayer.config import DEFAULTS, LIMITS, Limits, Thresholds
from assayer.session import build_session

__all__ = ["DEFAULTS", "LIMITS", "Limits", "Thresholds", "build_session"]
