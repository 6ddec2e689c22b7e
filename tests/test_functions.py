"""Value traps of the scalar layer (one literal fixture each)."""

import datetime as dt

from pyspark.sql import functions as F

from lateline.functions import columns as C
from lateline.functions import labels as L
from lateline.functions.buckets import bucketize, risk_level, severity_band
from lateline.operators import enrich


def _one(spark, expr, schema, rows):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_floor_days_s1(spark):
    rows = [(dt.datetime(2017, 1, 1, 10), dt.datetime(2017, 1, 2, 0)),
            (dt.datetime(2017, 1, 2, 1), dt.datetime(2017, 1, 1, 23))]
    got = _one(spark, C.floor_days("d", "e"), "d timestamp, e timestamp", rows)
    assert got == [-1, 0]
    assert _one(spark, C.late_flag("d", "e"), "d timestamp, e timestamp", rows) == [0, 1]


def test_breach_s2(spark):
    got = _one(spark, (F.coalesce(F.col("x"), F.lit(0)) > 3).cast("int"), "x int",
               [(3,), (4,), (None,), (-5,)])
    assert got == [0, 1, 0, 0]


def test_late_flag_null_s3(spark):
    got = _one(spark, C.late_flag("d", "e"), "d timestamp, e timestamp", [(None, dt.datetime(2017, 1, 1))])
    assert got == [0]


def test_clip_keeps_null_s4(spark):
    assert _one(spark, C.clip_lower("x"), "x double", [(-1.0,), (None,), (2.0,)]) == [0.0, None, 2.0]


def test_safe_div_s6(spark):
    assert _one(spark, C.safe_div("a", "b"), "a int, b int", [(5, 0), (6, 3)]) == [None, 2.0]


def test_outlier_filter_drops_null_s8(spark):
    df = spark.createDataFrame([(None, 1.0), (700.0, 1.0), (700.01, 1.0)],
                               "t1_approval_h double, t3_shipping_h double")
    assert [r[0] for r in enrich.filter_outliers(df).collect()] == [700.0]


def test_weekday_monday_zero_s10(spark):
    rows = [(dt.datetime(2017, 7, 3),), (dt.datetime(2017, 7, 9),)]
    assert _one(spark, F.weekday("t"), "t timestamp", rows) == [0, 6]
    assert _one(spark, C.weekend_flag(F.weekday("t")), "t timestamp", rows) == [0, 1]


def test_bucket_edges_s11(spark):
    got = _one(spark, risk_level("p"), "p double", [(0.0,), (0.3,), (0.30001,), (0.6,), (1.0,)])
    assert got == [None, "Low Risk", "Medium Risk", "Medium Risk", "High Risk"]
    got = _one(spark, bucketize("r", L.RATIO_EDGES, L.RATIO_LABELS), "r double",
               [(0.0,), (0.5,), (20.0,), (20.1,)])
    assert got == [None, "<50%", ">150%", None]


def test_duplicate_edges_s12(spark):
    e = [float("-inf"), 5.0, 5.0, 5.0, 5.0, float("inf")]
    got = _one(spark, bucketize("x", e, L.FREIGHT_LABELS), "x double", [(5.0,), (5.0,)])
    assert got == ["Sangat murah", "Sangat murah"]


def test_week_label_s31(spark):
    rows = [(dt.datetime(2026, 6, 9),), (dt.datetime(2027, 1, 1),)]
    assert _one(spark, C.week_label("t"), "t timestamp", rows) == ["2026-W23", "2027-W00"]


def test_time_period_labels(spark):
    hours = [0, 5, 6, 11, 12, 17, 18, 23]
    got = _one(spark, C.time_period("h"), "h int", [(h,) for h in hours])
    p = L.TIME_PERIODS
    assert got == [p[0], p[0], p[1], p[1], p[2], p[2], p[3], p[3]]


def test_recommended_days_and_severity(spark):
    assert _one(spark, C.recommended_days("p"), "p double", [(9.25,), (9.0,)]) == [10, 10]
    got = _one(spark, severity_band("v", 15, 8), "v double", [(15.0,), (14.99,), (8.0,), (7.99,)])
    assert got == ["red", "orange", "orange", "green"]


def test_half_even_rounding_s26(spark):
    assert _one(spark, C.hours_to_days("h"), "h double", [(6.0,), (18.0,)]) == [0.2, 0.8]


def test_quarter_and_month_labels(spark):
    rows = [(dt.datetime(2017, 8, 1),)]
    assert _one(spark, C.quarter_label("t"), "t timestamp", rows) == ["2017Q3"]
    assert _one(spark, C.year_month("t"), "t timestamp", rows) == ["2017-08"]
    assert _one(spark, C.day_name(F.weekday("t")), "t timestamp", rows) == ["Selasa"]


def test_duplicate_rows_by_hash(spark):
    from lateline.operators import profile as PR
    rows = [("a", None), (None, "a"), ("a", None), ("a", "a"), ("a", "a"), ("a", "a"), (None, None), (None, None), ("", None)]
    df = spark.createDataFrame(rows, "x string, y string").repartition(3)
    assert PR.duplicate_rows(df).first()[0] == len(rows) - len(set(rows)) == 4
    assert PR.duplicate_rows(df.limit(0)).first()[0] == 0
    r = PR.table_profile({"t": df}).first()
    assert (r.rows, r.null_total, r.duplicate_rows) == (9, 8, 4)
    # the first exchange carries hashes, not the rows
    plan = PR.duplicate_rows(df)._jdf.queryExecution().executedPlan().toString()
    assert any("hashpartitioning(_h1" in x for x in plan.split("\n"))
