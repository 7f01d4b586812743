"""Reading and writing tables, and the shared folder for intermediate results."""

from .scan import ingest_audit, load_ledgers, scan_parquet
from .sinks import next_to, publish, refuse_overlap, write_csv, write_table
from .staging import broadcast_if_small, remove, scratch_path, stage

__all__ = [
    "broadcast_if_small", "ingest_audit", "load_ledgers", "next_to", "publish", "refuse_overlap", "remove",
    "scan_parquet", "scratch_path", "stage", "write_csv", "write_table",
]
