"""Sources and sinks: hit files (S1), report file and name (S4, S5), events adapter."""

from .events import hits_from_events, read_event_hits
from .hits_file import read_hits, read_hits_parquet, report_name, write_report

__all__ = [
    "hits_from_events",
    "read_event_hits",
    "read_hits",
    "read_hits_parquet",
    "report_name",
    "write_report",
]
