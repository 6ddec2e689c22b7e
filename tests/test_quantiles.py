"""Distributed exact quantiles and running totals vs pandas, partition
independence, and a hot group holding most rows."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lateline.operators.quantiles import builtin_quantiles, exact_quantiles, running_totals

PROBS = [0.0, 0.2, 0.25, 0.5, 0.75, 0.95, 1.0]


def _data(n=3000, seed=7):
    rng = np.random.default_rng(seed)
    g = np.where(rng.random(n) < 0.6, "hot", rng.choice(["a", "b", "c"], n))
    v = np.round(rng.gamma(2.0, 10.0, n), 2)
    v[rng.random(n) < 0.05] = np.nan
    return pd.DataFrame({"g": g, "v": v})


@pytest.mark.parametrize("parts", [1, 8, 64])
def test_exact_quantiles_match_pandas(spark, parts):
    pdf = _data()
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        df = spark.createDataFrame(pdf).repartition(parts)
        got = exact_quantiles(df, "v", PROBS, by=["g"], names=[f"p{i}" for i in range(len(PROBS))]).toPandas()
        for _, row in got.iterrows():
            want = pdf[pdf.g == row.g].v.dropna().quantile(PROBS).values
            assert np.allclose([row[f"p{i}"] for i in range(len(PROBS))], want, atol=1e-9)
        glob = exact_quantiles(df, "v", [0.2, 0.8], names=["a", "b"]).collect()[0]
        assert np.allclose([glob.a, glob.b], pdf.v.dropna().quantile([0.2, 0.8]).values)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_constant_column_and_duplicates(spark):
    df = spark.createDataFrame([(5.0,)] * 50 + [(1.0,), (9.0,)], "v double")
    r = exact_quantiles(df, "v", [0.0, 0.5, 1.0], names=["lo", "mid", "hi"]).collect()[0]
    assert (r.lo, r.mid, r.hi) == (1.0, 5.0, 9.0)


def test_s13_linear_interpolation(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (8.0,)], "v double")
    r = exact_quantiles(df, "v", [0.2, 0.4, 0.75], names=["a", "b", "c"]).collect()[0]
    assert np.allclose([r.a, r.b, r.c], [1.6, 2.4, 5.0])
    r2 = builtin_quantiles(df, "v", [0.2, 0.4, 0.75], names=["a", "b", "c"]).collect()[0]
    assert np.allclose([r2.a, r2.b, r2.c], [1.6, 2.4, 5.0])


def test_running_totals(spark):
    pdf = pd.DataFrame({"k": np.arange(500) % 37 * 1.0, "x": np.arange(500) % 5})
    df = spark.createDataFrame(pdf).repartition(7)
    got = running_totals(df, "k", ["x"]).toPandas()
    per = pdf.groupby("k").x.sum().sort_index()
    before = per.cumsum().shift(1, fill_value=0)
    # rows of one key are ordered arbitrarily among themselves; check first-of-key totals
    mins = got.groupby("k").x_before.min()
    assert (mins.sort_index().values == before.values).all()


@pytest.mark.parametrize("conf", [{}, {"spark.sql.adaptive.enabled": "false", "spark.sql.exchange.reuse": "false"}])
def test_ranks_do_not_rest_on_exchange_reuse(spark, conf):
    """400k distinct values, 8 partitions: quantiles and AUC equal numpy's."""
    from lateline.operators.risk import roc_auc_exact
    n = 400_000
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        df = spark.range(0, n, 1, 8).select(
            (F.abs(F.hash("id").cast("long")) / 1e9 + F.col("id") * 1e-12).alias("late_probability"), "id")
        df = df.withColumn("is_late", (F.col("late_probability") * 0.4 + F.abs(F.hash(F.col("id") + 7)) / 2**31 > 0.9).cast("int"))
        pdf = df.toPandas()
        v = pdf.late_probability
        got = exact_quantiles(df, "late_probability", [0.1, 0.5, 0.95], names=["a", "b", "c"]).first()
        assert np.allclose([got.a, got.b, got.c], v.quantile([0.1, 0.5, 0.95]).values, rtol=0, atol=1e-12)
        rank, y = v.rank().values, pdf.is_late.values
        pos, neg = y.sum(), (1 - y).sum()
        want = (rank[y == 1].sum() - pos * (pos + 1) / 2) / (pos * neg)
        assert abs(roc_auc_exact(df).first().roc_auc - want) < 1e-9
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_bucket_is_monotone_with_nulls_nan_and_infinities(spark):
    from lateline.operators.quantiles import bucket_borders, value_bucket
    vals = [None, float("-inf"), -1e300, -5.0, -5.0, 0.0, 1e-9, 3.0, 3.5, 1e12, float("inf"), float("nan")]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    rows = df.select("v", value_bucket(F.col("v"), bucket_borders(df, F.col("v"))).alias("b")).orderBy("v").collect()
    assert [r.b for r in rows] == sorted(r.b for r in rows)


def test_many_columns_at_once_with_moments(spark):
    """Ties, nulls, NaN, an empty and a constant column; per group and overall."""
    import numpy as np

    from lateline.operators.quantiles import select_quantiles
    rng = np.random.default_rng(11)
    n = 30_000
    data = pd.DataFrame({"g": rng.integers(0, 3, n).astype(str), "a": rng.lognormal(0, 3, n), "b": rng.integers(0, 5, n).astype(float),
                         "c": np.where(rng.random(n) < 0.4, np.nan, rng.normal(size=n)), "d": 7.0, "e": np.nan})
    data.loc[data.g == "2", "c"] = np.nan
    probs = {"lo": 0.0, "q": 0.25, "m": 0.5, "p": 0.977, "hi": 1.0}
    df = spark.createDataFrame(data).withColumn("d", F.when(F.rand(3) < 2, F.col("d"))).repartition(13)
    what = {k: (F.col(k), {f"{name}_{k}": p for name, p in probs.items()}) for k in "abcde"}

    def check(row, part):
        for k in "abcde":
            v = part[k].dropna()
            assert row[f"n_{k}"] == len(v)
            for name, p in probs.items():
                want = None if v.empty else v.quantile(p)
                assert row[f"{name}_{k}"] == (None if want is None else pytest.approx(want, rel=1e-12, abs=1e-300)), (k, name)
            if len(v):
                assert row[f"mean_{k}"] == pytest.approx(v.mean()) and row[f"min_{k}"] == v.min() and row[f"max_{k}"] == v.max()

    check(select_quantiles(df, what, moments=True).first(), data)
    got = select_quantiles(df, what, by=["g"], moments=True).collect()
    assert len(got) == 3
    for r in got:
        check(r, data[data.g == r.g])
    empty = select_quantiles(df.limit(0), what).first()
    assert empty.n_a == 0 and empty.m_a is None
