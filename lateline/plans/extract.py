"""Extract step: read the seven sources and keep two copies of each -- a
timestamped snapshot in the lake (partition ``snapshot_ts``, so any past run
can be replayed) and the latest raw copy that the
transform reads.  All sources are resolved before anything is written, so a
missing source fails the step with nothing half-written."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import SparkSession

from lateline.functions.columns import snapshot_label  # noqa: F401  (same label as a Column)
from lateline.sinks import writers as W
from lateline.sources.files import Tables, read_snapshot, scan_sources


def extract(spark: SparkSession, paths: dict[str, str], lake_dir: str, raw_dir: str,
            run_ts: dt.datetime | None = None, fmt: str = "csv") -> str:
    """Returns the snapshot label ``yyyyMMdd_HHmmss`` written."""
    run_ts = run_ts or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    label = run_ts.strftime("%Y%m%d_%H%M%S")
    tables = scan_sources(spark, paths, fmt)      # raises before any write
    for name, df in tables.as_dict().items():
        W.write_snapshot(df, f"{lake_dir}/{name}", label)
        # the latest copy comes from the snapshot: the export is parsed once
        W.write_latest(read_snapshot(spark, f"{lake_dir}/{name}", label), f"{raw_dir}/{name}")
    return label


def replay(spark: SparkSession, lake_dir: str, snapshot_ts: str | None = None) -> Tables:
    """The seven sources as of one extract (default: the newest)."""
    names = ["orders", "items", "sellers", "customers", "reviews", "products", "cat_trans"]
    return Tables(**{n: read_snapshot(spark, f"{lake_dir}/{n}", snapshot_ts) for n in names})
