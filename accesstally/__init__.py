"""Access-log analytics on Spark."""

from accesstally.functions.clf import malformed_lines, parse_lines, valid_records
from accesstally.operators.reports import daily_traffic, hourly_errors, top_resources
from accesstally.sources.text import read_lines, read_numbered_lines

__all__ = [
    "daily_traffic",
    "hourly_errors",
    "malformed_lines",
    "parse_lines",
    "read_lines",
    "read_numbered_lines",
    "top_resources",
    "valid_records",
]
