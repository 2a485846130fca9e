"""Sinks: versions of whole stars behind one pointer, full-refresh tables and load reports."""

from trip_star.sinks.tables import ensure_database, load_metrics, load_report, publish, write_table
from trip_star.sinks.versions import commit, expire, new_version, register, stage

__all__ = [
    "commit",
    "ensure_database",
    "expire",
    "load_metrics",
    "load_report",
    "new_version",
    "publish",
    "register",
    "stage",
    "write_table",
]
