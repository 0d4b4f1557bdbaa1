"""Batch sinks."""

from .buckets import Buckets, read_bucketed, write_bucketed
from .tables import write_parquet, write_table
from .versions import VersionConflict, read_current, read_version, write_version

__all__ = [
    "Buckets", "read_bucketed", "write_bucketed", "write_parquet", "write_table",
    "VersionConflict", "read_current", "read_version", "write_version",
]
