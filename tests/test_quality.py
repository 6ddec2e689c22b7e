"""Planted defects: each makes exactly its check fail; every check still runs."""

import pytest
from pyspark.sql import functions as F

from lateline.config import DEFAULT_CONFIG
from lateline.functions import labels as L
from lateline.operators import quality as Q

CFG = DEFAULT_CONFIG.with_(dq_fact_rows_min=5, dq_fact_rows_max=100, dq_sellers_min=0, dq_customers_min=0,
                           dq_products_min=0, dq_risk_rows_min=5, dq_monthly_min=2,
                           dq_late_rate_lo=0.0, dq_late_rate_hi=1.0)


def _good(spark):
    fact = spark.createDataFrame(
        [(f"o{i}", i % 2, 1 + i % 12, "SP", "2017Q1", "Murah", 10.0, 5.0, 100.0) for i in range(20)],
        "order_id string, is_late int, purchase_month int, customer_state string, seller_cohort string, "
        "freight_bucket string, t1_approval_h double, t2_processing_h double, t3_shipping_h double")
    one = spark.createDataFrame([("x",)], "a string")
    seller = spark.createDataFrame([("s", 0, 30)], "seller_id string, is_chronic int, total_orders long")
    monthly = spark.createDataFrame([("2017-01",), ("2017-02",)], "year_month string")
    kpis = spark.createDataFrame([(n, 90.0) for n in [L.KPI_ON_TIME, "b", "c", "d", "e"]],
                                 "kpi_name string, actual_value double")
    risk = spark.createDataFrame([(f"o{i}", "Low Risk", 0.2) for i in range(10)],
                                 "order_id string, risk_level string, late_probability double")
    return {"fact_deliveries": fact, "dim_sellers": one, "dim_customers": one, "dim_products": one,
            "agg_seller_performance": seller, "agg_regional_stats": one, "agg_monthly_trend": monthly,
            "agg_cohort_performance": one, "kpi_summary": kpis, "fact_late_risk": risk}


def _failed(tables):
    res = Q.run_checks(tables, Q.hard_checks(CFG)).collect()
    assert len(res) == len(Q.hard_checks(CFG))
    return sorted(r["check"] for r in res if r["status"] == Q.FAIL)


def test_good_marts_pass(spark):
    assert _failed(_good(spark)) == []


@pytest.mark.parametrize("table,col,value,check", [
    ("fact_deliveries", "t1_approval_h", 701.0, "dq_t1_max"),
    ("fact_deliveries", "t3_shipping_h", 3001.0, "dq_t3_max"),
    ("fact_deliveries", "order_id", None, "dq_not_null_order_id"),
    ("fact_deliveries", "seller_cohort", None, "dq_not_null_seller_cohort"),
    ("fact_deliveries", "t2_processing_h", -1.0, "dq_non_negative_t2_processing_h"),
    ("fact_deliveries", "is_late", 2, "dq_is_late_domain"),
    ("fact_deliveries", "purchase_month", 13, "dq_month_range"),
    ("fact_late_risk", "risk_level", "Risiko", "dq_risk_domain"),
    ("fact_late_risk", "late_probability", 1.01, "dq_probability_range"),
])
def test_planted_defect(spark, table, col, value, check):
    t = _good(spark)
    df = t[table]
    first = df.limit(1).withColumn(col, F.lit(value).cast(dict(df.dtypes)[col]))
    t[table] = df.unionByName(first)
    assert _failed(t) == [check]


def test_chronic_rule_and_kpi_rows(spark):
    t = _good(spark)
    t["agg_seller_performance"] = spark.createDataFrame([("s", 1, 19)], "seller_id string, is_chronic int, total_orders long")
    assert _failed(t) == ["dq_chronic_rule"]
    t = _good(spark)
    t["kpi_summary"] = t["kpi_summary"].limit(4)
    res = {r["check"]: r["status"] for r in Q.run_checks(t, Q.hard_checks(CFG)).collect()}
    assert res["dq_kpi_rows"] == Q.FAIL and res["dq_kpi_ontime_range"] == Q.SKIP


def test_gate_raises_after_all_checks(spark):
    t = _good(spark)
    t["agg_regional_stats"] = t["agg_regional_stats"].limit(0)
    with pytest.raises(Q.QualityGateError, match="1 checks failed"):
        Q.gate(Q.run_checks(t, Q.hard_checks(CFG)))


def test_mostly_s35_and_null_policy_s36(spark):
    rows = [(float(i % 500), 1, 1) for i in range(999)] + [(701.0, 1, None)]
    fact = spark.createDataFrame(rows, "t1_approval_h double, is_late int, purchase_month int") \
        .withColumn("t3_shipping_h", F.lit(1.0)).withColumn("order_id", F.lit("o")) \
        .withColumn("seller_cohort", F.lit("q")).withColumn("freight_bucket", F.lit("Murah"))
    exp = {r["check"]: r["status"] for r in Q.run_checks({"fact_deliveries": fact}, Q.expectations(CFG)).collect()}
    assert exp["expect_between_mostly_t1_approval_h"] == Q.PASS      # 1 in 1000 tolerated
    assert exp["expect_between_purchase_month"] == Q.PASS            # null skipped
    fact2 = fact.unionByName(fact.limit(1).withColumn("t1_approval_h", F.lit(702.0)))
    exp2 = {r["check"]: r["status"] for r in Q.run_checks({"fact_deliveries": fact2}, Q.expectations(CFG)).collect()}
    assert exp2["expect_between_mostly_t1_approval_h"] == Q.FAIL
    hard = {r["check"]: r["status"] for r in Q.run_checks({"fact_deliveries": fact}, [
        c for c in Q.hard_checks(CFG) if c.name == "dq_month_range"]).collect()}
    assert hard["dq_month_range"] == Q.FAIL                          # null fails closed range
