"""Adapter from the driver's TPC-H-like tables to the seven source schemas.

Pure column arithmetic (the same formulas run in DuckDB for the oracle), so
every table is one narrow projection of its scan; only nation names are
joined in (25 rows, fixed by nature, broadcast).  ``h`` is a multiplicative
hash of the order key reduced modulo a prime *before* multiplying so it never
overflows 64 bits at any key range.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lateline.sources.files import Tables

# FIXED VALUES of the adapter (must equal the oracle's formulas).
HASH_MUL = 2654435761
HASH_MOD = 1000003


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def order_hash(key) -> "F.Column":
    key = F.col(key) if isinstance(key, str) else key
    return ((key % HASH_MOD) * F.lit(HASH_MUL)) % HASH_MOD


def adapt_orders(orders: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    h = order_hash(k)
    p0 = F.unix_timestamp(F.col("o_orderdate"))
    p = p0 + h % 86400
    a = (F.when(k % 997 == 0, F.lit(None).cast("long"))
         .when(k % 1499 == 0, F.lit(2667600)).otherwise(h % 90000))
    t2 = F.when(k % 53 == 0, F.lit(-3600)).otherwise(3600 + h % 400000)
    carrier = p + F.coalesce(a, F.lit(0)) + t2
    t3 = (F.when(k % 389 == 0, F.lit(None).cast("long"))
          .when(k % 1201 == 0, F.lit(11160000))
          .when(h % 7 == 0, 1200000 + h % 1500000)
          .otherwise(86400 + h % 900000))
    ed = F.when(k % 701 == 0, F.lit(0)).otherwise(16 + h % 14)
    est = p0 + ed * 86400 + F.when(ed == 0, F.lit(86399)).otherwise(F.lit(0))
    return orders.select(
        k.cast("string").alias("order_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.when(F.col("o_orderstatus").isin("F", "O"), F.lit("delivered"))
         .otherwise(F.lit("shipped")).alias("order_status"),
        F.timestamp_seconds(p).alias("order_purchase_timestamp"),
        F.timestamp_seconds(p + a).alias("order_approved_at"),
        F.timestamp_seconds(carrier).alias("order_delivered_carrier_date"),
        F.timestamp_seconds(carrier + t3).alias("order_delivered_customer_date"),
        F.timestamp_seconds(est).alias("order_estimated_delivery_date"),
    )


def adapt_items(lineitem: DataFrame) -> DataFrame:
    # order_item_id is the line number; ties (the synthetic data repeats line
    # numbers within an order) are broken by product and seller in every
    # "first" (see lateline.operators.fact.items_agg), so no window is needed.
    return lineitem.select(
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("l_linenumber").cast("int").alias("order_item_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("l_suppkey").cast("string").alias("seller_id"),
        F.col("l_extendedprice").cast("double").alias("price"),
        F.when(F.col("l_partkey") % 499 == 0, F.lit(None).cast("double"))
         .otherwise(F.round(F.col("l_quantity") * 0.9 + F.col("l_discount") * 100, 2))
         .alias("freight_value"),
    )


def adapt_sellers(supplier: DataFrame, nation: DataFrame) -> DataFrame:
    n = nation.select(F.col("n_nationkey"), F.col("n_name"))
    return supplier.join(n, supplier.s_nationkey == n.n_nationkey, "left").select(
        F.col("s_suppkey").cast("string").alias("seller_id"),
        (F.lit(10000) + (F.col("s_suppkey") * 7919) % 90000).cast("int").alias("seller_zip_code_prefix"),
        F.concat(F.lit("city_"), (F.col("s_suppkey") % 17).cast("string")).alias("seller_city"),
        F.col("n_name").alias("seller_state"),
    )


def adapt_customers(customer: DataFrame, nation: DataFrame) -> DataFrame:
    n = nation.select(F.col("n_nationkey"), F.col("n_name"))
    c = F.col("c_custkey")
    return customer.join(n, customer.c_nationkey == n.n_nationkey, "left").select(
        c.cast("string").alias("customer_id"),
        F.concat(F.lit("u"), (c - c % 3).cast("string")).alias("customer_unique_id"),
        (F.lit(10000) + (c * 7919) % 90000).cast("int").alias("customer_zip_code_prefix"),
        F.concat(F.lit("city_"), (c % 41).cast("string")).alias("customer_city"),
        F.col("n_name").alias("customer_state"),
    )


def adapt_reviews(orders: DataFrame) -> DataFrame:
    """One review for most orders, none for some, a second one for a few
    (fan-out).  Both rows come from one pass: explode a two-slot array and
    drop the empty slots (no higher-order function, so it stays in codegen)."""
    k = F.col("o_orderkey")
    h = order_hash(k)
    first = F.when(k % 131 != 0, F.when(h % 7 == 0, 1 + h % 3).otherwise(3 + h % 3))
    second = F.when(k % 173 == 0, 1 + (h + 2) % 5)
    return (orders.select(k.cast("string").alias("order_id"),
                          F.explode(F.array(first.cast("int"), second.cast("int"))).alias("review_score"))
            .where(F.col("review_score").isNotNull()))


def adapt_products(part: DataFrame) -> DataFrame:
    pk = F.col("p_partkey")
    size = F.col("p_size").cast("double")
    return part.select(
        pk.cast("string").alias("product_id"),
        F.when(pk % 50 == 0, F.lit(None).cast("string")).otherwise(F.lower("p_type"))
         .alias("product_category_name"),
        F.when(pk % 97 == 0, F.lit(None).cast("double")).otherwise(size * 100.0)
         .alias("product_weight_g"),
        (size + 10).alias("product_length_cm"),
        (size + 5).alias("product_height_cm"),
        (size + 7).alias("product_width_cm"),
    )


def adapt_cat_trans(part: DataFrame) -> DataFrame:
    cat = F.lower(F.col("p_type"))
    return (part.select(cat.alias("product_category_name")).distinct()
            .where(F.col("product_category_name") != "promo")
            .select("product_category_name",
                    F.concat(F.lit("en_"), F.col("product_category_name"))
                     .alias("product_category_name_english")))


def synthetic_tables(spark: SparkSession, sf_dir: str) -> Tables:
    orders = _read(spark, sf_dir, "orders")
    nation = _read(spark, sf_dir, "nation")
    part = _read(spark, sf_dir, "part")
    return Tables(
        orders=adapt_orders(orders),
        items=adapt_items(_read(spark, sf_dir, "lineitem")),
        sellers=adapt_sellers(_read(spark, sf_dir, "supplier"), nation),
        customers=adapt_customers(_read(spark, sf_dir, "customer"), nation),
        reviews=adapt_reviews(orders),
        products=adapt_products(part),
        cat_trans=adapt_cat_trans(part),
    )
