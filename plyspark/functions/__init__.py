"""Column-level helpers (pure ``Column -> Column``; all JVM-side built-ins)."""

from plyspark.functions.scalar import (
    PERF_GROUPS,
    clock_ratio,
    epoch_ms_to_ts,
    move_flags,
    outcome_for,
    piece_type,
    seconds_between,
    time_control_label,
    whole_number_text,
)

__all__ = [
    "PERF_GROUPS",
    "clock_ratio",
    "epoch_ms_to_ts",
    "move_flags",
    "outcome_for",
    "piece_type",
    "seconds_between",
    "time_control_label",
    "whole_number_text",
]
