"""Sinks.

* ``enforce_schema``   -- project onto a declared warehouse schema (fail on a
  missing column), ``stringify_codes`` for zip/prefix columns;
* ``write_snapshot`` / ``write_latest`` -- the extract's versioned lake copy
  (partition ``snapshot_ts``) and its latest copy;
* ``publish_run``      -- write every table below a folder of the run, then one
  small manifest file that names them all.  ``read_published`` resolves the
  newest manifest, so a reader has one whole version whatever fails, nothing
  large is moved, and the version before stays readable;
* ``publish``          -- the same tables at fixed paths: a staging folder, then
  swapped folders, all put back if one swap fails.  Readers may see a mixed
  set while the folders move;
* ``write_fact``       -- fact partitioned by purchase month and sorted by
  order id inside each file; range partitioning on (month, order_id) keeps
  tasks of even size instead of one task per month;
* quality report rows appended per week, with retention of the newest weeks.

File-system moves go through Hadoop's ``FileSystem`` of the target path, so
they work on any cluster store Spark can write to.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lateline import schemas

__all__ = ["enforce_schema", "stringify_codes", "write_snapshot", "write_latest", "write_table",
           "write_fact", "publish", "publish_run", "published", "read_published", "append_report", "report_retention", "report_summary",
           "counted"]


def enforce_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"columns missing for the declared schema: {missing}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def stringify_codes(df: DataFrame) -> DataFrame:
    """Columns named like ``*zip*`` or ``*prefix*`` to text (null stays null)."""
    return df.select(*[F.col(c).cast("string").alias(c) if ("zip" in c or "prefix" in c) else F.col(c)
                       for c in df.columns])


def write_snapshot(df: DataFrame, path: str, snapshot_ts: str) -> None:
    """One extract as partition ``snapshot_ts=<yyyyMMdd_HHmmss>``; writing a
    label again replaces it, so a retried run does not double the data."""
    df.write.mode("overwrite").parquet(f"{path}/snapshot_ts={snapshot_ts}")


def write_latest(df: DataFrame, path: str) -> None:
    """The new copy is written beside the old one and takes its place when it
    is complete; a failed write or move leaves the old copy."""
    spark = df.sparkSession
    fs, final, jvm = _fs(spark, path)
    side = lambda kind: jvm.org.apache.hadoop.fs.Path(final.getParent(), f"_{kind}-{final.getName()}-{uuid.uuid4().hex}")
    new, old = side("next"), side("old")
    df.write.parquet(new.toString())
    had = fs.exists(final)
    if had and not fs.rename(final, old):
        raise RuntimeError(f"move failed: {path}")
    if not fs.rename(new, final):
        if had:
            fs.rename(old, final)
        raise RuntimeError(f"move failed: {new.toString()} -> {path}")
    if had:
        fs.delete(old, True)


def counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Row count observed while the data is written (no second pass)."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def write_table(df: DataFrame, path: str, sort_keys=()) -> Observation:
    out, obs = counted(df, path)
    if sort_keys:
        out = out.sortWithinPartitions(*sort_keys)
    out.write.mode("overwrite").parquet(path)
    return obs


def write_fact(df: DataFrame, path: str, partitions: int | None = None,
               max_records_per_file: int = 5_000_000) -> Observation:
    # without a count adaptive execution sizes the partitions from the data;
    # observe above the range exchange: its sampling job must not count rows
    keys = ("purchase_month", "order_id")
    ranged = df.repartitionByRange(partitions, *keys) if partitions else df.repartitionByRange(*keys)
    out, obs = counted(ranged, path)
    (out.sortWithinPartitions("purchase_month", "order_id")
     .write.mode("overwrite").option("maxRecordsPerFile", max_records_per_file)
     .partitionBy("purchase_month").parquet(path))
    return obs


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def _write_all(tables: dict[str, DataFrame], folder: str, enforce: bool) -> dict[str, Observation]:
    obs = {}
    for name, df in tables.items():
        if enforce and name in schemas.OUTPUTS:
            df = enforce_schema(stringify_codes(df), schemas.OUTPUTS[name])
        if name == "fact_deliveries":
            obs[name] = write_fact(df, f"{folder}/{name}")
        else:
            obs[name] = write_table(df, f"{folder}/{name}", schemas.SORT_KEYS.get(name, ()))
    return obs


def _manifests(spark: SparkSession, out_dir: str) -> list[str]:
    fs, p, _ = _fs(spark, f"{out_dir}/_manifests")
    if not fs.exists(p):
        return []
    return sorted(x for x in (st.getPath().getName() for st in fs.listStatus(p)) if x.endswith(".json") and x[0].isdigit())


def publish_run(tables: dict[str, DataFrame], out_dir: str, run_id: str, keep: int = 2, enforce: bool = True) -> dict[str, int]:
    """Write all tables below ``<out>/runs/<run_id>-<attempt>``, then make them
    the published version by one move of a small manifest file, which the file
    system does whole or not at all.  The newest ``keep`` versions stay.
    Returns row counts observed during the writes."""
    if not tables:
        return {}
    spark = next(iter(tables.values())).sparkSession
    out_dir = out_dir.rstrip("/")
    run = f"runs/{run_id}-{uuid.uuid4().hex[:8]}"
    rows = {k: int(o.get.get("rows", 0)) for k, o in _write_all(tables, f"{out_dir}/{run}", enforce).items()}
    fs, _, jvm = _fs(spark, out_dir)
    Path = jvm.org.apache.hadoop.fs.Path
    last = _manifests(spark, out_dir)
    number = int(last[-1].split("-")[0]) + 1 if last else 1
    part = Path(f"{out_dir}/_manifests/part-{uuid.uuid4().hex}")
    stream = fs.create(part, False)
    stream.writeBytes(json.dumps({"run_id": run_id, "tables": {n: {"path": f"{run}/{n}", "rows": rows[n]} for n in tables}}))
    stream.close()
    final = Path(f"{out_dir}/_manifests/{number:012d}-{run_id}.json")
    if fs.exists(final) or not fs.rename(part, final):
        raise RuntimeError(f"could not commit {final.toString()}")
    for name in _manifests(spark, out_dir)[:-keep]:
        old = _manifest(spark, out_dir, name)
        fs.delete(Path(f"{out_dir}/_manifests/{name}"), False)  # no reader can find the version any more
        for folder in {t["path"].rsplit("/", 1)[0] for t in old["tables"].values()}:
            fs.delete(Path(f"{out_dir}/{folder}"), True)
    return rows


def _manifest(spark: SparkSession, out_dir: str, name: str) -> dict:
    return json.loads(spark.read.text(f"{out_dir}/_manifests/{name}", wholetext=True).first()[0])


def published(spark: SparkSession, out_dir: str, back: int = 0) -> dict | None:
    """The manifest of the newest version, or of one ``back`` versions before."""
    names = _manifests(spark, out_dir.rstrip("/"))
    return _manifest(spark, out_dir.rstrip("/"), names[-1 - back]) if len(names) > back else None


def read_published(spark: SparkSession, out_dir: str, table: str, back: int = 0) -> DataFrame:
    """A table of the newest whole version; all tables of one ``published()``
    manifest belong together."""
    m = published(spark, out_dir, back)
    if m is None or table not in m["tables"]:
        raise ValueError(f"{table} is not published in {out_dir}")
    return spark.read.parquet(f"{out_dir.rstrip('/')}/{m['tables'][table]['path']}")


def publish(tables: dict[str, DataFrame], out_dir: str, run_id: str,
            enforce: bool = True) -> dict[str, int]:
    """Write all tables to ``<out>/_staging/<run_id>``, then swap each folder
    into place (previous copy kept as ``<out>/_previous/<table>`` until the
    swap succeeds).  Returns row counts observed during the writes."""
    if not tables:
        return {}
    spark = next(iter(tables.values())).sparkSession
    stage = f"{out_dir.rstrip('/')}/_staging/{run_id}"
    obs = _write_all(tables, stage, enforce)
    swap_all(spark, list(tables), stage, out_dir)
    return {k: int(o.get.get("rows", 0)) for k, o in obs.items()}


def swap_all(spark: SparkSession, names: list[str], stage: str, out_dir: str) -> None:
    """Move every staged folder into place; if any move fails, all tables are
    put back as they were and the failure is raised."""
    fs, _, jvm = _fs(spark, out_dir)
    Path = jvm.org.apache.hadoop.fs.Path
    new = {n: Path(f"{stage}/{n}") for n in names}
    final = {n: Path(f"{out_dir}/{n}") for n in names}
    prev = {n: Path(f"{out_dir}/_previous/{n}") for n in names}
    lost = [n for n in names if not fs.exists(new[n])]
    if lost:
        raise RuntimeError(f"nothing staged for {lost}")

    def move(a, b):
        if not fs.rename(a, b):
            raise RuntimeError(f"move failed: {a} -> {b}")

    fs.mkdirs(Path(f"{out_dir}/_previous"))
    saved, placed = [], []
    try:
        for n in names:
            if fs.exists(final[n]):
                if fs.exists(prev[n]):
                    fs.delete(prev[n], True)
                move(final[n], prev[n])
                saved.append(n)
            move(new[n], final[n])
            placed.append(n)
    except Exception:
        for n in placed:
            move(final[n], new[n])
        for n in saved:
            move(prev[n], final[n])
        raise
    fs.delete(Path(stage), True)


def append_report(results: DataFrame, path: str, week: str, run_ts: str) -> None:
    """The check rows of one run in the report, partitioned by week and run;
    a retried run replaces its own rows."""
    results.write.mode("overwrite").parquet(f"{path}/week={week}/run_ts={run_ts}")


def report_summary(report: DataFrame) -> DataFrame:
    s = F.col("status")
    return (report.groupBy("week", "run_ts")
            .agg(F.count(F.lit(1)).alias("total"), F.count_if(s == "PASS").alias("passed"),
                 F.count_if(s == "FAIL").alias("failed")).orderBy("week", "run_ts"))


def report_retention(spark: SparkSession, path: str, keep: int = 4) -> list[str]:
    """Drop week partitions older than the newest ``keep`` weeks; returns the
    dropped weeks.  Week labels sort in time order (``YYYY-WNN``)."""
    fs, p, jvm = _fs(spark, path)
    if not fs.exists(p):
        return []
    weeks = sorted(st.getPath().getName().split("=", 1)[1] for st in fs.listStatus(p)
                   if st.isDirectory() and st.getPath().getName().startswith("week="))
    drop = weeks[:-keep] if keep > 0 else weeks
    for w in drop:
        fs.delete(jvm.org.apache.hadoop.fs.Path(f"{path}/week={w}"), True)
    return drop
