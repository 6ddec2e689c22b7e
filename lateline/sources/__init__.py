"""Readers: CSV/parquet sources, snapshots, and the synthetic-table adapter."""

from lateline.sources.files import (Tables, scan_csv, scan_parquet, scan_sources,
                                    read_snapshot, latest_snapshot)
from lateline.sources.synthetic import synthetic_tables

__all__ = ["Tables", "scan_csv", "scan_parquet", "scan_sources", "read_snapshot",
           "latest_snapshot", "synthetic_tables"]
