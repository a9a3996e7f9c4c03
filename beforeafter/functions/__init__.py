"""Column expressions."""

from beforeafter.functions.columns import (
    clean_number,
    interpolate,
    percent_change,
    quoted,
    signed_log,
    status_label,
    time_index,
)

__all__ = [
    "clean_number",
    "interpolate",
    "percent_change",
    "quoted",
    "signed_log",
    "status_label",
    "time_index",
]
