"""Business impact of reaching the late-rate target (notebook population).

All quantities are one-row aggregates joined together (no driver values):
orders saved, review score before/after, average order value, revenue at
risk, and the chronic sellers' share of it.  ``trunc`` reproduces the
reference's ``int(...)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lateline.config import DEFAULT_CONFIG, Config
from lateline.functions import columns as C
from lateline.operators import breakdowns as B


def _trunc(c):
    return F.floor(c).cast("long")   # non-negative inputs: floor == int()


def impact_orders_saved(nb: DataFrame, cfg: Config = DEFAULT_CONFIG) -> DataFrame:
    n, rate = F.col("total_orders"), F.col("late_rate_actual")
    return (nb.agg(F.count(F.lit(1)).alias("total_orders"), F.avg("is_late").alias("late_rate_actual"))
            .select("total_orders", "late_rate_actual",
                    F.lit(cfg.impact_target_late_rate).alias("late_rate_target"),
                    _trunc(n * rate).alias("late_orders_actual"),
                    _trunc(n * F.lit(cfg.impact_target_late_rate)).alias("late_orders_target"))
            .withColumn("orders_saved", F.col("late_orders_actual") - F.col("late_orders_target")))


def review_score_means(orr: DataFrame) -> DataFrame:
    """One row: mean review score of on-time and late orders (reviewed only)."""
    r = orr.where(F.col("review_score").isNotNull())
    return r.agg(F.avg(F.when(F.col("is_late") == 0, F.col("review_score"))).alias("score_on_time"),
                 F.avg(F.when(F.col("is_late") == 1, F.col("review_score"))).alias("score_late"))


def impact_review_score(saved: DataFrame, scores: DataFrame) -> DataFrame:
    """Order-weighted mean score now and at the target late rate."""
    n = F.nullif(F.col("total_orders"), F.lit(0))
    on, late = F.col("score_on_time"), F.col("score_late")
    before = ((n - F.col("late_orders_actual")) * on + F.col("late_orders_actual") * late) / n
    after = ((n - F.col("late_orders_target")) * on + F.col("late_orders_target") * late) / n
    return (C.with_scalars(saved, scores)
            .select("score_on_time", "score_late", before.alias("score_before"),
                    after.alias("score_after"), (after - before).alias("score_gain")))


def avg_order_value(oi: DataFrame) -> DataFrame:
    """Mean over orders of the summed item price (two-level aggregate)."""
    per = oi.groupBy("order_id").agg(F.sum(C.money("price")).alias("v"))
    return per.agg(F.avg(F.col("v").cast("double")).alias("avg_order_value"))


def impact_revenue_at_risk(saved: DataFrame, aov: DataFrame) -> DataFrame:
    a = F.col("avg_order_value")
    return C.with_scalars(saved, aov).select(
        "avg_order_value", (F.col("late_orders_actual") * a).alias("revenue_at_risk"),
        (F.col("orders_saved") * a).alias("revenue_saved"))


def impact_chronic_sellers(seller_items: DataFrame, cfg: Config = DEFAULT_CONFIG) -> DataFrame:
    """Chronic active sellers: count, estimated late orders and revenue at risk
    (both scaled by the chronic sellers' mean late rate)."""
    ch = seller_items.where((F.col("total_orders") >= cfg.active_min_orders)
                            & (F.col("late_rate") > cfg.chronic_rate))
    return (ch.agg(F.count(F.lit(1)).alias("chronic_sellers"),
                   F.sum("total_orders").alias("_orders"), F.avg("late_rate").alias("_rate"),
                   F.sum("total_revenue").alias("_rev"))
            .select("chronic_sellers",
                    F.coalesce(_trunc(F.col("_orders") * F.col("_rate")), F.lit(0)).alias("chronic_late_orders"),
                    F.coalesce(F.col("_rev") * F.col("_rate"), F.lit(0.0)).alias("chronic_revenue_at_risk")))


def business_impact(nb: DataFrame, items: DataFrame, reviews: DataFrame,
                    cfg: Config = DEFAULT_CONFIG, scores: DataFrame | None = None) -> DataFrame:
    """All impact figures in one row."""
    oi = B.orders_items(nb, items)
    saved = impact_orders_saved(nb, cfg)
    scores = review_score_means(B.orders_reviews(nb, reviews)) if scores is None else scores
    out = C.with_scalars(saved, impact_review_score(saved, scores))
    out = C.with_scalars(out, impact_revenue_at_risk(saved, avg_order_value(oi)))
    return C.with_scalars(out, impact_chronic_sellers(B.seller_perf_items(oi), cfg))


def sla_whatif(oc: DataFrame) -> DataFrame:
    """Mean actual/estimate ratio if every state's estimate were its
    recommended P75-based days (the reference claims ~0.75 but has no code)."""
    est = B.delivery_estimate_by_state(oc).select("customer_state", "recommended_days")
    # one row per state: Spark sizes the join itself (AQE broadcasts it when small)
    j = oc.where(F.col("customer_state").isNotNull()).join(est, "customer_state")
    return j.agg(F.avg("actual_vs_est_ratio").alias("current_ratio"),
                 F.avg(C.safe_div("delivery_days", "recommended_days")).alias("whatif_ratio"))
