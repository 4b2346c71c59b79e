"""Scans and sinks: delimited files, parquet, catalog views and tables."""

from tallyframe.sources.delimited import read_delimited, read_report, write_report
from tallyframe.sources.parquet import read_table
from tallyframe.sources.tables import checkpoint, materialize, register_view, save_table, scan_view

__all__ = [
    "read_delimited", "read_report", "write_report", "read_table",
    "register_view", "scan_view", "save_table", "materialize", "checkpoint",
]
