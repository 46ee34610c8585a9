"""Consolidation of DNS and content-filter lists on Spark."""

from listloom.engine import Engine, LineParser, Rule
from listloom.plans.report import Report

__version__ = "0.1.0"
__all__ = ["Engine", "LineParser", "Report", "Rule"]
