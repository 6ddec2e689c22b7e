"""Table profiles: rows, columns, nulls, duplicate rows, per-column nulls.
Rows and nulls are one aggregate without a shuffle.  Duplicates are looked for
by a 128-bit hash of the row, so two numbers per row are shuffled and not the
row; whole rows are compared only where a hash repeats."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lateline.functions import labels as L
from lateline.functions.buckets import severity_band
from lateline.functions.columns import with_scalars


def duplicate_rows(df: DataFrame) -> DataFrame:
    """One row: how many rows equal an earlier one, nulls being equal."""
    cols = [F.col(f"`{c}`") for c in df.columns]
    # a hash skips nulls, so where they are is hashed too
    parts = [*cols, *[c.isNull() for c in cols]]
    hashed = df.select(*cols, *[F.xxhash64(F.lit(seed), *parts).alias(h) for seed, h in ((1, "_h1"), (2, "_h2"))])
    again = hashed.groupBy("_h1", "_h2").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_h1", "_h2")
    rows = hashed.join(again, ["_h1", "_h2"], "left_semi")
    return (rows.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
            .agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicate_rows")))


def table_profile(tables: dict[str, DataFrame]) -> DataFrame:
    out = None
    for name, df in tables.items():
        cols = df.columns
        missing = sum(F.col(f"`{c}`").isNull().cast("int") for c in cols)
        one = with_scalars(df.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(missing), F.lit(0)).alias("null_total")),
                           duplicate_rows(df))
        part = one.select(
            F.lit(name).alias("table"), "rows", F.lit(len(cols)).alias("n_columns"),
            F.col("null_total").cast("long").alias("null_total"),
            (F.col("null_total") * 100.0 / F.nullif(F.col("rows") * len(cols), F.lit(0))).alias("null_pct"),
            F.col("duplicate_rows").cast("long").alias("duplicate_rows"))
        out = part if out is None else out.unionByName(part)
    return out


def null_profile(df: DataFrame, table: str) -> DataFrame:
    """Null count and share per column, only columns with nulls, ascending
    share, with the chart's severity band (>= 20 red, >= 5 orange)."""
    cols = df.columns
    one = df.agg(F.count(F.lit(1)).alias("_rows"),
                 *[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in cols])
    long = one.unpivot(["_rows"], cols, "column", "nulls")
    pct = F.col("nulls") * 100.0 / F.col("_rows")
    return (long.where(F.col("nulls") > 0)
            .select(F.lit(table).alias("table"), "column", F.col("nulls").cast("long").alias("nulls"),
                    pct.alias("null_pct"), severity_band(pct, *L.SEVERITY_MISSING).alias("severity"))
            .orderBy("null_pct", "column"))
