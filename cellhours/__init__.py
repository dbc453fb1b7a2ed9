"""Leakage-safe cell-hour features over position reports, as Spark DataFrame jobs."""

from cellhours.config import DEFAULT_RULES, Rules

__all__ = ["DEFAULT_RULES", "Rules"]
