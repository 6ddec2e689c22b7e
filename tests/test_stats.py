import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lateline.operators import stats as ST


def test_chi2_yates_s34(spark):
    counts = spark.createDataFrame([(10, 20, 30, 40)], "a long, b long, c long, d long")
    r = ST.chi2_from_counts(counts).collect()[0]
    assert abs(r.chi2 - 0.4464) < 1e-4
    assert abs(r.exp_a - 12.0) < 1e-9 and r.dof == 1
    assert 0.5 < r.p_value < 0.51 and r.significant == 0


def test_chi2_symmetric_in_row_swap(spark):
    a = spark.createDataFrame([(100, 20, 300, 10)], "a long, b long, c long, d long")
    b = spark.createDataFrame([(300, 10, 100, 20)], "a long, b long, c long, d long")
    assert abs(ST.chi2_from_counts(a).first().chi2 - ST.chi2_from_counts(b).first().chi2) < 1e-9


def test_correlation_matches_pandas(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"x": rng.normal(size=400), "y": rng.normal(size=400)})
    pdf["z"] = pdf.x * 2 + rng.normal(size=400) * 0.1
    pdf.loc[::7, "y"] = np.nan
    got = {(r.col_a, r.col_b): r.r for r in ST.correlation_matrix(spark.createDataFrame(pdf), ["x", "y", "z"]).collect()}
    want = pdf.corr()
    for (a, b), v in got.items():
        assert abs(v - want.loc[a, b]) < 1e-9


def test_histogram_counts_all(spark):
    df = spark.createDataFrame([(float(i),) for i in range(101)], "v double")
    h = ST.histogram(df, "v", 10).collect()
    assert sum(r.n for r in h) == 101 and max(r.bin for r in h) == 9


def test_sample_fixed_repeatable(spark):
    df = spark.range(1000).selectExpr("cast(id as string) as order_id")
    a = sorted(r.order_id for r in ST.sample_fixed(df.repartition(3), 50).collect())
    b = sorted(r.order_id for r in ST.sample_fixed(df.repartition(11), 50).collect())
    assert a == b and len(a) == 50


def test_empty_inputs_do_not_raise_under_ansi(spark):
    from lateline.operators import profile as PR, risk as R
    empty = spark.createDataFrame([], "a long, b long, c long, d long")
    assert ST.chi2_from_counts(spark.createDataFrame([(0, 0, 0, 0)], "a long, b long, c long, d long")).first().chi2 is None
    assert PR.table_profile({"t": empty}).first().null_pct is None
    none = spark.createDataFrame([(0.5, 0)], "late_probability double, is_late int")
    assert R.roc_auc_exact(none).first().roc_auc is None


def test_native_p_value_matches_published_values(spark):
    """Upper tail of chi-square with one degree of freedom, from tables to 1e-10."""
    import math

    from lateline.functions import columns as C
    xs = [0.0, 1e-8, 0.1, 0.5, 1.0, 1.5, 2.0, 2.4999, 2.5, 2.5001, 3.0, 4.0, 5.0, 8.0]
    got = spark.createDataFrame([(x,) for x in xs], "x double").select("x", F.expr(C.erfc_sql("x")).alias("p")).collect()
    for r in got:
        assert r.p == pytest.approx(math.erfc(r.x), rel=1e-10, abs=1e-300)
    known = {3.841458820694124: 0.05, 6.634896601021213: 0.01, 10.827566170662733: 0.001, 0.45493642311957283: 0.5}
    df = spark.createDataFrame([(c,) for c in known], "c double").select("c", F.sqrt(F.col("c") / 2).alias("x"))
    for r in df.select("c", F.expr(C.erfc_sql("x")).alias("p")).collect():
        assert r.p == pytest.approx(known[r.c], rel=1e-10)


def test_box_plot_numbers_keep_a_group_out_of_one_task(spark):
    from pyspark.sql import functions as F
    df = spark.range(0, 4000, 1, 8).select((F.col("id") % 2).cast("int").alias("g"), (F.col("id") % 100).cast("double").alias("v"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as where Spark cannot tell how small a group's row is
    try:
        out = ST.five_number_summary(df, "v", by=["g"])
        plan = out._jdf.queryExecution().sparkPlan().toString()
        assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan
        got = {r.g: tuple(r)[1:] for r in out.collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == {0: (24.0, 49.0, 74.0, 0.0, 98.0, 0, 2000), 1: (25.0, 50.0, 75.0, 1.0, 99.0, 0, 2000)}
