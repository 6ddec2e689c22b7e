"""Helpers shared by the corpus operators: staged tables, word rules, folds
and connected components.

Intermediate results are written as Parquet below the cluster's checkpoint
folder (``spark.checkpoint.dir``) and read back, so a lost executor costs a
re-read and not a re-computation.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lateline.session import ensure_checkpoint_dir

#: Fixed value of the contracts: a word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def text_batches(spark: SparkSession, rows: int = 1_000) -> None:
    """Whole texts go to Python in small batches, so that a worker and its
    buffers stay small; a value that the session has set stays."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if key not in spark.conf.getAll:
        spark.conf.set(key, str(rows))


class Stage:
    """A fresh folder in the shared checkpoint folder; ``save`` writes a
    DataFrame there and returns the re-read table.  Like checkpoint files, the
    folder lives as long as results that read it; the cluster's clean-up of
    ``spark.checkpoint.dir`` removes it."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        text_batches(spark)
        self.root = f"{ensure_checkpoint_dir(spark)}/stage-{uuid.uuid4().hex}"
        self._n = 0

    def save(self, df: DataFrame, name: str) -> DataFrame:
        self._n += 1
        path = f"{self.root}/{self._n:03d}-{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, df: DataFrame) -> None:
        """Delete a staged table that no later result reads."""
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            if path.startswith(self.root) or f"/{self.root.rsplit('/', 1)[1]}/" in path:
                p = jvm.org.apache.hadoop.fs.Path(path)
                p.getFileSystem(conf).delete(p, True)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: Column | str, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod``; null ids fall in fold 0."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) % mod, F.lit(0))


def bounded_sample(df: DataFrame, key: Column, limit: int) -> DataFrame:
    """About ``limit`` rows at most, picked by a hash of ``key``: the same rows
    in every run, whatever the partitions.  One count, no sort."""
    n = df.count()
    if n <= limit:
        return df
    return df.where(F.pmod(F.xxhash64(key), F.lit(1 << 40)) < int(limit / n * (1 << 40)))


def components(stage: Stage, edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of the links ``(a, b)``: rows ``(node, comp)``,
    ``comp`` being the smallest node of the component; only linked nodes occur.

    Alternating large-star / small-star rounds on the edge table: a node sends
    its neighbours to their minimum, so a hot node is only ever aggregated
    (``min``) and joined, never collected.  Every round is written out; the
    loop ends when a round changes nothing.
    """
    e = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).where("u <> v")
    e = stage.save(e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    for _ in range(max_rounds):
        # large star: every larger neighbour of a node moves to the node's minimum
        both = e.union(e.select(F.col("v"), F.col("u")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        big = (both.where("v > u").join(low, "u")
               .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())
        big = stage.save(big, "large")
        # small star: smaller neighbours and the node itself move to the minimum
        low = big.groupBy("u").agg(F.min("v").alias("m"))
        small = (big.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        small = stage.save(small, "small")
        # a star forest: every u has one v and no v is a u
        deg = small.groupBy("u").agg(F.count("*").alias("n"))
        done = (deg.where("n > 1").limit(1).count() == 0
                and small.select("u").join(small.select(F.col("v").alias("u")).distinct(), "u", "left_semi").limit(1).count() == 0)
        e = small
        if done:
            break
    else:
        raise RuntimeError("components did not converge")
    return e.select(F.col("u").alias("node"), F.col("v").alias("comp")).union(
        e.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct())
