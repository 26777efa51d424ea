"""Scans, sources and sinks: the JSON feed, raw Parquet tables, CSV export
and the driver-table adapter used by the registered queries."""

from plyspark.sources.feed import (
    analysed_only,
    is_analysed,
    latest_games,
    perf_types_for,
    read_feed,
    require_rows,
    select_perf,
)
from plyspark.sources.tables import (
    RAW_TABLES,
    conform,
    read_raw,
    read_raw_csv,
    read_raw_tables,
    write_csv,
    write_table,
)

__all__ = [
    "RAW_TABLES",
    "analysed_only",
    "conform",
    "is_analysed",
    "latest_games",
    "perf_types_for",
    "read_feed",
    "read_raw",
    "read_raw_csv",
    "read_raw_tables",
    "require_rows",
    "select_perf",
    "write_csv",
    "write_table",
]
