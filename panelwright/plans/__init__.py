from panelwright.plans.registry import ORACLES, QUERIES
from panelwright.plans import configurations, core, joining, research, technical  # noqa: F401

__all__ = ["ORACLES", "QUERIES"]
