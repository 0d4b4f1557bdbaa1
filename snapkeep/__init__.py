"""snapkeep: land change records as dated table snapshots and query them, on Spark."""

from . import functions, operators, plans, schemas, sinks, sources, streaming
from .session import apply_settings, build_session, ensure_checkpoint_dir, remove_scratch, scratch_path

__all__ = [
    "functions", "operators", "plans", "schemas", "sinks", "sources", "streaming",
    "apply_settings", "build_session", "ensure_checkpoint_dir", "remove_scratch", "scratch_path",
]
