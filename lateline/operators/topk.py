"""Top-k reports.  Each is ``orderBy(...).limit(k)``, which Spark plans as
``TakeOrderedAndProject``: every task keeps its own k best rows and only
those reach the final merge, so no full sort or shuffle of the input.
Ties are broken by the key (S33) so results do not depend on file order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lateline.config import DEFAULT_CONFIG, Config
from lateline.functions import columns as C


def worst_approvals(nb: DataFrame, n: int = 5) -> DataFrame:
    return (nb.where(F.col("t1_approval_h").isNotNull())
            .orderBy(F.desc("t1_approval_h"), "order_id").limit(n)
            .select("order_id", "order_purchase_timestamp", "order_approved_at", "t1_approval_h",
                    "is_late", C.hours_to_days("t1_approval_h").alias("t1_days")))


def worst_sellers(seller_items: DataFrame, cfg: Config = DEFAULT_CONFIG, n: int = 10) -> DataFrame:
    return (seller_items.where(F.col("total_orders") >= cfg.active_min_orders)
            .orderBy(F.desc("late_pct"), "seller_id").limit(n)
            .select("seller_id", C.short_id("seller_id").alias("seller_short"),
                    "total_orders", "late_pct", "avg_t2"))


def best_sellers(seller_items: DataFrame, cfg: Config = DEFAULT_CONFIG, n: int = 10) -> DataFrame:
    return (seller_items.where((F.col("total_orders") >= cfg.active_min_orders)
                               & (F.col("total_orders") >= cfg.best_min_orders))
            .orderBy(F.asc("late_pct"), "seller_id").limit(n)
            .select("seller_id", C.short_id("seller_id").alias("seller_short"),
                    "total_orders", "late_pct", "avg_t2"))


def worst_categories(categories: DataFrame, n: int = 15) -> DataFrame:
    return categories.orderBy(F.desc("late_pct"), "category_en").limit(n)


def best_categories(categories: DataFrame, n: int = 15) -> DataFrame:
    return categories.orderBy(F.asc("late_pct"), "category_en").limit(n)


def top_bottom_states(state_stats: DataFrame, n: int = 5) -> DataFrame:
    """Head and tail of the states sorted by late rate (descending)."""
    top = (state_stats.orderBy(F.desc("late_pct"), "customer_state").limit(n)
           .withColumn("position", F.lit("top")))
    bottom = (state_stats.orderBy(F.asc("late_pct"), F.desc("customer_state")).limit(n)
              .withColumn("position", F.lit("bottom")))
    return top.unionByName(bottom)


def limit_n(df: DataFrame, n: int = 5, order_by=None) -> DataFrame:
    """``head(n)`` with a declared order (a bare limit has none)."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)
