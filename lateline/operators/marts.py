"""Pipeline marts over the fact (grain: order x review, S18-S19).

Each mart is one ``groupBy().agg()``: Spark plans a partial (map-side)
aggregate, one shuffle on the group key, and a final aggregate, so a hot
key costs one row per task before the shuffle.  Exact distinct counts
(``countDistinct``) shuffle on (key, order_id), which also spreads a hot key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lateline.config import DEFAULT_CONFIG, Config
from lateline.functions import columns as C


#: Columns of the fact that each mart reads: what to ask the builder for.
RATE_COLS = ("order_id", "seller_id", "is_late")
SELLER_COLS = (*RATE_COLS, "seller_state", "seller_city", "seller_cohort", "t2_processing_h", "delivery_days", "price")
REGIONAL_COLS = ("order_id", "customer_state", "is_late", "delivery_days", "t3_shipping_h")
MONTHLY_COLS = ("order_id", "order_purchase_timestamp", "is_late", "delivery_days")
COHORT_COLS = ("order_id", "seller_id", "seller_cohort", "is_late", "delivery_days")


def with_seller_flags(sellers: DataFrame, cfg: Config = DEFAULT_CONFIG) -> DataFrame:
    return sellers.withColumns({
        "is_chronic": ((F.col("late_rate") > cfg.chronic_rate)
                       & (F.col("total_orders") >= cfg.active_min_orders)).cast("int"),
        "is_new_problem": ((F.col("total_orders") < cfg.active_min_orders)
                           & (F.col("late_rate") == 1.0)).cast("int"),
    })


def seller_rates(fact: DataFrame, cfg: Config = DEFAULT_CONFIG) -> DataFrame:
    """Orders, late rate and flags per seller, from the three ``RATE_COLS``."""
    return with_seller_flags(fact.where(F.col("seller_id").isNotNull()).groupBy("seller_id").agg(
        F.countDistinct("order_id").alias("total_orders"), F.avg("is_late").alias("late_rate")), cfg)


def seller_performance_all(fact: DataFrame, cfg: Config = DEFAULT_CONFIG) -> DataFrame:
    """Per seller, every seller (null seller dropped, S14).  ``total_orders``
    counts distinct orders but ``late_orders``/``late_rate`` are row-level (S19)."""
    # a seller with several dimension rows is one row: its first state and city
    # by the declared order (state, city, cohort)
    agg = (fact.where(F.col("seller_id").isNotNull()).groupBy("seller_id").agg(
        F.min(F.struct("seller_state", "seller_city", "seller_cohort")).alias("_first"),
        F.countDistinct("order_id").alias("total_orders"),
        F.sum("is_late").cast("long").alias("late_orders"),
        F.avg("is_late").alias("late_rate"),
        F.avg("t2_processing_h").alias("avg_t2_processing_h"),
        F.avg("delivery_days").alias("avg_delivery_days"),
        F.coalesce(F.sum(C.money("price")), F.lit(0)).cast("double").alias("total_revenue"),
    ))
    return with_seller_flags(agg.select("seller_id", "_first.*", *[c for c in agg.columns if c not in ("seller_id", "_first")]), cfg)


def agg_seller_performance(fact: DataFrame, cfg: Config = DEFAULT_CONFIG) -> DataFrame:
    """Active sellers only (``total_orders >= active_min_orders``)."""
    return seller_performance_all(fact, cfg).where(F.col("total_orders") >= cfg.active_min_orders)


def agg_regional_stats(fact: DataFrame) -> DataFrame:
    return (fact.where(F.col("customer_state").isNotNull()).groupBy("customer_state").agg(
        F.count("order_id").alias("total_orders"),
        F.sum("is_late").cast("long").alias("late_orders"),
        F.avg("is_late").alias("late_rate"),
        F.avg("delivery_days").alias("avg_delivery_days"),
        F.avg("t3_shipping_h").alias("avg_t3_shipping_h"),
    ))


def agg_monthly_trend(fact: DataFrame) -> DataFrame:
    return (fact.withColumn("year_month", C.year_month("order_purchase_timestamp"))
            .groupBy("year_month").agg(
                F.count("order_id").alias("total_orders"),
                F.sum("is_late").cast("long").alias("late_orders"),
                F.avg("is_late").alias("late_rate"),
                F.avg("delivery_days").alias("avg_delivery_days"))
            .orderBy("year_month"))


def agg_cohort_performance(fact: DataFrame) -> DataFrame:
    return (fact.where(F.col("seller_cohort").isNotNull()).groupBy("seller_cohort").agg(
        F.countDistinct("seller_id").alias("seller_count"),
        F.count("order_id").alias("total_orders"),
        F.sum("is_late").cast("long").alias("late_orders"),
        F.avg("is_late").alias("late_rate"),
        F.avg("delivery_days").alias("avg_delivery_days"))
        .orderBy("seller_cohort"))
