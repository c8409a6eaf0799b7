"""Composite plans: the flagship query and its batch job."""

from .flagship import formatted_report, run_report, search_revenue

__all__ = ["formatted_report", "run_report", "search_revenue"]
