"""Batch sources: Parquet, CSV, message topics, partition inventory."""

from .csv import read_csv, read_csv_by_name
from .footers import footer_counts, footer_stats
from .inventory import partition_inventory
from .parquet import read_parquet, read_parquets, read_snapshot
from .topic import offset_slice, read_topic, read_topic_stream, slice_offsets, topic_options

__all__ = [
    "read_csv", "read_csv_by_name", "footer_counts", "footer_stats", "partition_inventory", "read_parquet", "read_parquets", "read_snapshot",
    "offset_slice", "read_topic", "read_topic_stream", "slice_offsets", "topic_options",
]
