"""Counts that FIXTURES.md states for the adapter at sf0.01 (computed there in
Spark and DuckDB independently): the populations must reproduce them."""

from pyspark.sql import functions as F

from lateline.config import SYNTHETIC_CONFIG as CFG
from lateline.operators import enrich, fact as FT
from lateline.sources import synthetic_tables

from fulfilment_fixtures import SF001


def test_adapter_goldens_sf001(spark):
    t = synthetic_tables(spark, SF001)
    nb = enrich.notebook_orders(t.orders)
    r = nb.agg(F.count(F.lit(1)).alias("delivered"),
               F.count_if(F.col("t2_processing_h") < 0).alias("neg_t2"),
               F.count_if(F.col("t1_approval_h") > 700).alias("t1_over"),
               F.count_if(F.col("t1_approval_h").isNull()).alias("t1_null"),
               F.count_if(F.col("t3_shipping_h") > 3000).alias("t3_over"),
               F.count_if(F.col("t3_shipping_h").isNull()).alias("t3_null")).first()
    assert (r.delivered, r.neg_t2, r.t1_over, r.t1_null, r.t3_over, r.t3_null) == (9912, 190, 7, 7, 8, 28)
    kept = enrich.kept_orders(t.orders, CFG)
    k = kept.agg(F.count(F.lit(1)).alias("n"), F.avg("is_late").alias("late"),
                 F.avg((F.coalesce(F.col("days_late"), F.lit(0)) > 3).cast("int")).alias("breach"),
                 F.avg((F.col("t2_processing_h") <= 48).cast("int")).alias("t2_48"),
                 F.count_if(F.col("estimated_days") == 0).alias("zero_est")).first()
    assert k.n == 9862 and k.zero_est == 12
    assert round(k.late, 4) == 0.1040 and round(k.breach, 4) == 0.0646 and round(k.t2_48, 4) == 0.5186
    no_items = kept.join(t.items.select("order_id").distinct(), "order_id", "left_anti").count()
    assert no_items == 168
    # every such order reaches the fact with a null seller (S23)
    f = FT.fact_deliveries(t, CFG)
    assert f.where(F.col("seller_id").isNull()).select("order_id").distinct().count() == 168
