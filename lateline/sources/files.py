"""File sources with declared schemas.

The reference reads seven CSV exports (``scan_sources``); columns are selected
per source, so Spark prunes the rest at the scan.  Snapshots are one parquet
dataset per source partitioned by ``snapshot_ts``; replaying a run reads one partition folder.
"""

from __future__ import annotations

from dataclasses import dataclass, fields, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lateline import schemas


@dataclass(frozen=True)
class Tables:
    """The seven sources of the pipeline."""

    orders: DataFrame
    items: DataFrame
    sellers: DataFrame
    customers: DataFrame
    reviews: DataFrame
    products: DataFrame
    cat_trans: DataFrame

    def as_dict(self) -> dict[str, DataFrame]:
        return {f.name: getattr(self, f.name) for f in fields(self)}

    def with_(self, **kw) -> "Tables":
        return replace(self, **kw)


def scan_csv(spark: SparkSession, path: str, schema, multiline: bool = False) -> DataFrame:
    """Headered CSV; the schema's columns are taken by name from whatever
    columns the file has, in any order, and cast (ANSI: an unparsable value
    fails the read).  A column that the header lacks is an error here; files
    of one path must share one header.  ``multiline`` (quoted line breaks)
    makes a file one task, so only sources that need it set it."""
    raw = (spark.read.option("header", True).option("enforceSchema", False)
           .option("multiLine", multiline).option("escape", '"').option("mode", "FAILFAST").csv(path))
    missing = [f.name for f in schema.fields if f.name not in raw.columns]
    if missing:
        raise ValueError(f"columns missing in {path}: {missing}")

    def typed(f):
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.StringType):
            return c
        c = F.nullif(F.trim(c), F.lit(""))
        if isinstance(f.dataType, T.TimestampType):
            c = F.to_timestamp(c, "yyyy-MM-dd HH:mm:ss")
        return c.cast(f.dataType)

    return raw.select(*[typed(f).alias(f.name) for f in schema.fields])


def scan_parquet(spark: SparkSession, path: str, columns=None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def scan_sources(spark: SparkSession, paths: dict[str, str], fmt: str = "csv") -> Tables:
    """Read the seven named sources; a missing one is an error raised before
    anything is written (the reader fails at analysis time)."""
    missing = [k for k in schemas.SOURCES if k not in paths]
    if missing:
        raise FileNotFoundError(f"sources missing: {missing}")
    out = {}
    for name, schema in schemas.SOURCES.items():
        if fmt == "csv":
            out[name] = scan_csv(spark, paths[name], schema, name in schemas.MULTILINE)
        else:
            df = spark.read.parquet(paths[name])
            out[name] = df.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])
    return Tables(**out)


def read_snapshot(spark: SparkSession, path: str, snapshot_ts: str | None = None) -> DataFrame:
    """Replay one extract: ``snapshot_ts`` (``yyyyMMdd_HHmmss``) or the newest.
    Only that snapshot's folder is listed and read."""
    if snapshot_ts is None:
        snapshot_ts = latest_snapshot(spark, path)
    df = spark.read.option("basePath", path).parquet(f"{path}/snapshot_ts={snapshot_ts}")
    return df.where(F.col("snapshot_ts") == F.lit(snapshot_ts)).drop("snapshot_ts")


def latest_snapshot(spark: SparkSession, path: str) -> str:
    """Newest label by the names of the partition folders; no data is read."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    labels = [st.getPath().getName().split("=", 1)[1] for st in (fs.listStatus(p) if fs.exists(p) else [])
              if st.isDirectory() and st.getPath().getName().startswith("snapshot_ts=")]
    if not labels:
        raise FileNotFoundError("no snapshot found")
    return max(labels)
