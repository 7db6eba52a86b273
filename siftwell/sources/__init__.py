"""Scans, writers and work tables."""

from siftwell.sources.sinks import write_csv, write_parquet, write_report, write_reports
from siftwell.sources.text import cast_columns, cast_failures, read_text_csv
from siftwell.sources.workspace import discard, materialize, shared_folder, work_path

__all__ = [
    "cast_columns",
    "cast_failures",
    "discard",
    "materialize",
    "read_text_csv",
    "shared_folder",
    "work_path",
    "write_csv",
    "write_parquet",
    "write_report",
    "write_reports",
]
