"""Operating-system log analytics on Spark."""

from .api import KINDS, analyze, host_report, labelled, parsed, report

__all__ = ["KINDS", "analyze", "host_report", "labelled", "parsed", "report"]
