"""Order enrichment: stage durations, whole days, lateness, calendar parts.

Two populations exist (blueprint "two populations"):

* pipeline  -- delivered, negative stages clipped to 0, outliers removed (S9);
* notebook  -- delivered, raw values, no outlier filter.

Everything here is one narrow projection over the orders scan: the status
filter is pushed into the parquet reader, the rest fuses into one codegen stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lateline.config import DEFAULT_CONFIG, Config
from lateline.functions import columns as C

PURCHASE, APPROVED, CARRIER, DELIVERED, ESTIMATE = (
    "order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date",
    "order_delivered_customer_date", "order_estimated_delivery_date")

DERIVED = ["t1_approval_h", "t2_processing_h", "t3_shipping_h", "delivery_days",
           "estimated_days", "days_late", "is_late", "actual_vs_est_ratio",
           "purchase_month", "purchase_dayofweek", "purchase_hour"]


def filter_delivered(orders: DataFrame) -> DataFrame:
    return orders.where(F.col("order_status") == F.lit("delivered"))


def enrich_orders(orders: DataFrame, clip_negative: bool = True) -> DataFrame:
    """Add the eleven derived columns of a delivered order."""
    t1 = C.stage_hours(APPROVED, PURCHASE)
    t2 = C.stage_hours(CARRIER, APPROVED)
    t3 = C.stage_hours(DELIVERED, CARRIER)
    if clip_negative:
        t1, t2, t3 = C.clip_lower(t1), C.clip_lower(t2), C.clip_lower(t3)
    delivery_days = C.floor_days(DELIVERED, PURCHASE)
    estimated_days = C.floor_days(ESTIMATE, PURCHASE)
    ts = F.col(PURCHASE)
    return orders.select(
        "*",
        t1.alias("t1_approval_h"), t2.alias("t2_processing_h"), t3.alias("t3_shipping_h"),
        delivery_days.alias("delivery_days"), estimated_days.alias("estimated_days"),
        C.floor_days(DELIVERED, ESTIMATE).alias("days_late"),
        C.late_flag(DELIVERED, ESTIMATE).alias("is_late"),
        C.safe_div(delivery_days, estimated_days).alias("actual_vs_est_ratio"),
        F.month(ts).alias("purchase_month"),
        F.weekday(ts).alias("purchase_dayofweek"),
        F.hour(ts).alias("purchase_hour"),
    )


def outlier_predicate(cfg: Config = DEFAULT_CONFIG):
    """Kept rows: a null stage compares as unknown and is dropped too (S8)."""
    return ((F.col("t1_approval_h") <= cfg.max_approval_h)
            & (F.col("t3_shipping_h") <= cfg.max_shipping_h))


def filter_outliers(df: DataFrame, cfg: Config = DEFAULT_CONFIG) -> DataFrame:
    return df.where(outlier_predicate(cfg))


def outlier_audit(enriched: DataFrame, cfg: Config = DEFAULT_CONFIG) -> DataFrame:
    """Rows before, removed by each rule (applied in order), and after; one pass."""
    r1 = F.coalesce(F.col("t1_approval_h") <= cfg.max_approval_h, F.lit(False))
    r2 = F.coalesce(F.col("t3_shipping_h") <= cfg.max_shipping_h, F.lit(False))
    return enriched.agg(
        F.count(F.lit(1)).alias("rows_before"),
        F.count_if(~r1).alias("removed_approval"),
        F.count_if(r1 & ~r2).alias("removed_shipping"),
        F.count_if(r1 & r2).alias("rows_after"),
    ).withColumn("rows_removed", F.col("rows_before") - F.col("rows_after"))


def kept_orders(orders: DataFrame, cfg: Config = DEFAULT_CONFIG) -> DataFrame:
    """Delivered, clipped, outlier-free orders (population of the marts)."""
    return filter_outliers(enrich_orders(filter_delivered(orders), clip_negative=True), cfg)


def notebook_orders(orders: DataFrame) -> DataFrame:
    """Delivered orders with raw (unclipped) stages, no outlier filter."""
    return enrich_orders(filter_delivered(orders), clip_negative=False)
