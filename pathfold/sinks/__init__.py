"""Sinks: CSV reports, reports by window."""
from .csv import write_csv
from .windows import write_window

__all__ = ["write_csv", "write_window"]
