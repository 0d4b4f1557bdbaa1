"""Relational operators of the library (all plain DataFrame plans)."""

from .counts import row_count, row_counts
from .enrich import Lookup, enrich, unique_by_key
from .latest import latest_per_key, max_per_key, not_null_rows, observe_dropped
from .layout import drop_stable, shape_output, stable
from .profile import null_pattern, null_profile

__all__ = [
    "row_count", "row_counts",
    "Lookup", "enrich", "unique_by_key",
    "latest_per_key", "max_per_key", "not_null_rows", "observe_dropped",
    "drop_stable", "shape_output", "stable",
    "null_pattern", "null_profile",
]
