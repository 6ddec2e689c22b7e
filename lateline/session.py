"""SparkSession helpers.

A cluster passes its own settings (checkpoint folder, partitions, memory);
``get_session`` only fills in what is unset, whatever the master is.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # wide single-pass aggregates (all checks of a table, 55 correlations)
    # exceed the default 100-field limit and would lose whole-stage codegen
    "spark.sql.codegen.maxFields": "1000",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "lateline", extra: dict | None = None) -> SparkSession:
    """The active session or a new one.  ``master`` and ``extra`` (settings of
    the JVM among them) are the caller's explicit wishes for a new session;
    the defaults above are set only where neither the cluster nor the caller
    has set a value."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    wishes = dict(extra or {})
    if shuffle_partitions:
        wishes["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for k, v in wishes.items():
        builder = builder.config(k, v)
    if SparkSession.getActiveSession() is None:
        # static settings cannot follow later; spark-defaults are not known yet
        for k in ("spark.ui.enabled", "spark.ui.showConsoleProgress"):
            if k not in wishes:
                builder = builder.config(k, _DEFAULTS[k])
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    given = spark.conf.getAll
    for k, v in _DEFAULTS.items():
        if k not in given and spark.conf.isModifiable(k):
            spark.conf.set(k, v)
    # session time zone is semantic (timestamps have no zone); pin it always
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    # the checkpoint folder is resolved where a table is staged, not here
    return spark


#: For sessions of one machine that start their own JVM (tests, bench): memory,
#: and compilation of generated methods above 8000 bytes, which README asks
#: clusters to set for driver and executors.
LOCAL_JVM = {
    "spark.driver.memory": os.environ.get("LATELINE_DRIVER_MEMORY", "16g"),
    "spark.driver.extraJavaOptions": "-XX:-DontCompileHugeMethods",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def staged(df, name: str):
    """Write a DataFrame as Parquet below the checkpoint folder and read it
    back: lineage is cut, later readers prune columns and know the size."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder; create a scratch one
    only when the session has none (local tests)."""
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not spark.sparkContext._jsc.sc().isLocal():
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        # driver and tasks are one process (tests, bench): a scratch folder of this machine
        configured = tempfile.mkdtemp(prefix="lateline-ckpt-")
    spark.sparkContext.setCheckpointDir(configured)
    return spark.sparkContext.getCheckpointDir() or configured
