"""Declared schemas of the seven sources and the ten published tables.

Sources are read with these schemas (never ``inferSchema``); outputs are
projected onto the warehouse schemas by ``lateline.sinks.enforce_schema``.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, TS, D, I, L, F, SH = (T.StringType(), T.TimestampType(), T.DoubleType(),
                         T.IntegerType(), T.LongType(), T.FloatType(), T.ShortType())


def _st(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


TS_COLS = [
    "order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date",
    "order_delivered_customer_date", "order_estimated_delivery_date",
]

# ---- sources (CSV text: timestamps arrive as strings and are parsed by name)
ORDERS = _st(("order_id", S, False), ("customer_id", S, False), ("order_status", S, False),
             *[(c, TS, c != "order_purchase_timestamp") for c in TS_COLS])
ITEMS = _st(("order_id", S, False), ("order_item_id", I, False), ("product_id", S, False),
            ("seller_id", S, False), ("price", D, True), ("freight_value", D, True))
SELLERS = _st(("seller_id", S, False), ("seller_zip_code_prefix", I, True),
              ("seller_city", S, True), ("seller_state", S, True))
CUSTOMERS = _st(("customer_id", S, False), ("customer_unique_id", S, True),
                ("customer_zip_code_prefix", I, True), ("customer_city", S, True),
                ("customer_state", S, True))
REVIEWS = _st(("order_id", S, False), ("review_score", I, True))
PRODUCTS = _st(("product_id", S, False), ("product_category_name", S, True),
               ("product_weight_g", D, True), ("product_length_cm", D, True),
               ("product_height_cm", D, True), ("product_width_cm", D, True))
CAT_TRANS = _st(("product_category_name", S, False), ("product_category_name_english", S, True))

SOURCES = {
    "orders": ORDERS, "items": ITEMS, "sellers": SELLERS, "customers": CUSTOMERS,
    "reviews": REVIEWS, "products": PRODUCTS, "cat_trans": CAT_TRANS,
}

#: Sources whose text fields hold line breaks.
MULTILINE = {"reviews"}

# ---- published tables (warehouse types)
FACT_DELIVERIES = _st(
    ("order_id", S, False), ("customer_id", S, True), ("seller_id", S, True), ("product_id", S, True),
    *[(c, TS, True) for c in TS_COLS],
    ("t1_approval_h", F, True), ("t2_processing_h", F, True), ("t3_shipping_h", F, True),
    ("delivery_days", I, True), ("estimated_days", I, True), ("days_late", I, True),
    ("actual_vs_est_ratio", F, True),
    ("is_late", SH, False), ("purchase_month", SH, False), ("purchase_dayofweek", SH, False),
    ("purchase_hour", SH, False),
    ("customer_state", S, True), ("customer_city", S, True),
    ("seller_state", S, True), ("seller_city", S, True),
    ("seller_cohort", S, True), ("freight_bucket", S, True),
    ("product_category_name", S, True), ("product_category_name_en", S, True),
    ("price", F, True), ("freight_value", F, True), ("review_score", F, False),
)
FACT_COLS = [f.name for f in FACT_DELIVERIES.fields]

DIM_SELLERS = _st(("seller_id", S, False), ("seller_zip_code_prefix", S, True),
                  ("seller_city", S, True), ("seller_state", S, True))
DIM_CUSTOMERS = _st(("customer_id", S, False), ("customer_unique_id", S, True),
                    ("customer_zip_code_prefix", S, True), ("customer_city", S, True),
                    ("customer_state", S, True))
DIM_PRODUCTS = _st(("product_id", S, False), ("product_category_name", S, True),
                   ("product_category_name_en", S, True), ("product_weight_g", F, True),
                   ("product_length_cm", F, True), ("product_height_cm", F, True),
                   ("product_width_cm", F, True))
AGG_SELLER_PERFORMANCE = _st(
    ("seller_id", S, False), ("seller_state", S, True), ("seller_city", S, True),
    ("seller_cohort", S, True), ("total_orders", L, False), ("late_orders", L, False),
    ("late_rate", F, False), ("avg_t2_processing_h", F, True), ("avg_delivery_days", F, True),
    ("total_revenue", F, False), ("is_chronic", SH, False), ("is_new_problem", SH, False))
AGG_REGIONAL_STATS = _st(
    ("customer_state", S, False), ("total_orders", L, False), ("late_orders", L, False),
    ("late_rate", F, False), ("avg_delivery_days", F, True), ("avg_t3_shipping_h", F, True))
AGG_MONTHLY_TREND = _st(
    ("year_month", S, False), ("total_orders", L, False), ("late_orders", L, False),
    ("late_rate", F, False), ("avg_delivery_days", F, True))
AGG_COHORT_PERFORMANCE = _st(
    ("seller_cohort", S, False), ("seller_count", L, False), ("total_orders", L, False),
    ("late_orders", L, False), ("late_rate", F, False), ("avg_delivery_days", F, True))
KPI_SUMMARY = _st(
    ("kpi_name", S, False), ("actual_value", F, False), ("target_value", F, False),
    ("target_operator", S, False), ("status", S, False), ("unit", S, False))
FACT_LATE_RISK = _st(
    ("order_id", S, False), ("customer_state", S, True), ("seller_state", S, True),
    ("seller_cohort", S, True), ("purchase_month", SH, False), ("freight_bucket", S, True),
    ("late_probability", F, False), ("late_prediction", SH, False), ("risk_level", S, True),
    ("is_late", SH, False))

OUTPUTS = {
    "fact_deliveries": FACT_DELIVERIES, "dim_sellers": DIM_SELLERS,
    "dim_customers": DIM_CUSTOMERS, "dim_products": DIM_PRODUCTS,
    "agg_seller_performance": AGG_SELLER_PERFORMANCE, "agg_regional_stats": AGG_REGIONAL_STATS,
    "agg_monthly_trend": AGG_MONTHLY_TREND, "agg_cohort_performance": AGG_COHORT_PERFORMANCE,
    "kpi_summary": KPI_SUMMARY, "fact_late_risk": FACT_LATE_RISK,
}

# sort key of each published table (row-group min/max skipping on read)
SORT_KEYS = {
    "fact_deliveries": ["order_id"], "dim_sellers": ["seller_id"],
    "dim_customers": ["customer_id"], "dim_products": ["product_id"],
    "agg_seller_performance": ["seller_id"], "agg_regional_stats": ["customer_state"],
    "agg_monthly_trend": ["year_month"], "agg_cohort_performance": ["seller_cohort"],
    "kpi_summary": ["kpi_name"], "fact_late_risk": ["order_id"],
}
PARTITION_KEYS = {"fact_deliveries": ["purchase_month"]}
