"""Composite flows built from the operators."""

from .counts import table_counts
from .enrichment import enrich_entity, enrich_from_lake
from .extract import decode_envelope, extract_snapshot, latest_snapshot, stamp_date
from .incremental import compact, live_snapshot, publish, read_live, read_state, squash
from .quarantine import quarantine

__all__ = [
    "compact", "live_snapshot", "publish", "read_live", "read_state", "squash", "quarantine",
    "table_counts", "enrich_entity", "enrich_from_lake",
    "decode_envelope", "extract_snapshot", "latest_snapshot", "stamp_date",
]
