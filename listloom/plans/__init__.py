"""Whole plans: the merge of lists, its reports and its files."""

from listloom.plans.merge import MergeResult, merge, merge_lines
from listloom.plans.report import Report
from listloom.plans.sink import write_rules

__all__ = ["MergeResult", "Report", "merge", "merge_lines", "write_rules"]
