"""Dashboard datasets (the reference describes the dashboard but ships no
queries; only the data sets are built, rendering is out of scope)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lateline.config import DEFAULT_CONFIG, Config
from lateline.functions import columns as C
from lateline.operators import kpi, marts

CHRONIC, NORMAL, NEW_PROBLEM, OTHER = "chronic", "normal", "new_problem", "other"


def seller_class(sellers_all: DataFrame, cfg: Config = DEFAULT_CONFIG) -> DataFrame:
    """chronic / normal (active, not chronic) / new_problem / other, per seller."""
    active = F.col("total_orders") >= cfg.active_min_orders
    cls = (F.when(F.col("is_chronic") == 1, F.lit(CHRONIC))
           .when(active, F.lit(NORMAL))
           .when(F.col("is_new_problem") == 1, F.lit(NEW_PROBLEM))
           .otherwise(F.lit(OTHER)))
    return sellers_all.select("seller_id", cls.alias("seller_class"))


def dash_headline(fact: DataFrame, cfg: Config = DEFAULT_CONFIG) -> DataFrame:
    """KPI actuals, late orders, revenue of late rows, chronic seller count."""
    v = kpi.kpi_values(fact, cfg)
    late = fact.agg(F.sum("is_late").cast("long").alias("late_orders"),
                    F.sum(F.when(F.col("is_late") == 1, F.col("price").cast("decimal(18,2)")))
                    .cast("double").alias("late_revenue"))
    chronic = (marts.seller_rates(fact, cfg)
               .agg(F.sum("is_chronic").cast("long").alias("chronic_sellers")))
    return C.with_scalars(C.with_scalars(v, late), chronic)


def dash_chronic_list(fact: DataFrame, cfg: Config = DEFAULT_CONFIG) -> DataFrame:
    return (marts.seller_performance_all(fact, cfg).where(F.col("is_chronic") == 1)
            .orderBy(F.desc("late_rate"), "seller_id"))


def dash_seller_categories(fact: DataFrame, cfg: Config = DEFAULT_CONFIG) -> DataFrame:
    return (seller_class(marts.seller_rates(fact, cfg), cfg)
            .groupBy("seller_class").agg(F.count(F.lit(1)).alias("n_sellers")))


def dash_seller_class_by_state(fact: DataFrame, cfg: Config = DEFAULT_CONFIG) -> DataFrame:
    """Late rate by seller class x customer state (fact grain).  The class
    table has one row per seller; Spark broadcasts it when small enough."""
    cls = seller_class(marts.seller_rates(fact, cfg), cfg)
    return (fact.where(F.col("customer_state").isNotNull()).join(cls, "seller_id")
            .groupBy("seller_class", "customer_state")
            .agg(F.count(F.lit(1)).alias("n_rows"), F.avg("is_late").alias("late_rate")))


def dash_freight(fact: DataFrame) -> DataFrame:
    return (fact.where(F.col("freight_bucket").isNotNull()).groupBy("freight_bucket")
            .agg(F.count(F.lit(1)).alias("n_rows"), F.avg("is_late").alias("late_rate")))


def dash_category_revenue_at_risk(fact: DataFrame) -> DataFrame:
    return (fact.groupBy("product_category_name_en")
            .agg(F.coalesce(F.sum(F.when(F.col("is_late") == 1, F.col("price").cast("decimal(18,2)"))),
                            F.lit(0)).cast("double").alias("late_revenue"),
                 F.count_if(F.col("is_late") == 1).alias("late_rows")))


def dash_reviews(fact: DataFrame) -> DataFrame:
    """Mean fact review score (missing review = 0, S25) by lateness."""
    return fact.groupBy("is_late").agg(F.avg("review_score").alias("mean_score"),
                                       F.count(F.lit(1)).alias("n_rows"))
