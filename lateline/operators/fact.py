"""Star schema: items per order, seller cohorts, dimensions, the wide fact.

Grain of ``fact_deliveries`` is order x review (S18): an order with two
reviews is two rows.  The builder is driven by the columns a caller asks for:

* the grain: kept orders, joined on ``order_id`` with their items (aggregated
  per order, only if an item column is asked for) and reviews.  Orders and
  items are read once.  An order's row keeps the set of its sellers, so the
  seller cohorts come from the same rows and not from a second item join;
* what is used twice (cohorts, freight quintiles, several aggregates) is
  written once as Parquet and read again, else nothing is staged;
* customers, sellers and products are joined only if one of their columns is
  asked for.  Their keys are unique, so a left join that is left out would add
  no row;
* rows without seller and product (orders without items) skip the exchanges of
  those joins and are unioned back: one null key cannot fill a task.
"""

from __future__ import annotations

import operator
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lateline import schemas
from lateline.config import DEFAULT_CONFIG, Config
from lateline.functions import columns as C
from lateline.functions import labels as L
from lateline.functions.buckets import bucketize
from lateline.operators import enrich
from lateline.operators.quantiles import exact_quantiles
from lateline.session import staged
from lateline.sources.files import Tables

FREIGHT_PROBS = [0.2, 0.4, 0.6, 0.8]


def _first_non_null(value: str, order):
    """``first`` of pandas = first non-null in file order (S15); here the file
    order is replaced by a declared total order."""
    return F.min_by(F.col(value), F.when(F.col(value).isNotNull(), order))


def item_order() -> "F.Column":
    return F.struct(F.col("order_item_id"), F.col("product_id"), F.col("seller_id"))


def items_agg(items: DataFrame, sellers: bool = False) -> DataFrame:
    """One row per order: first seller, first product, summed price and freight
    (sum of an all-null group is 0, S16); with ``sellers`` also the set of the
    order's sellers, as many as it has items at most."""
    more = [F.collect_set("seller_id").alias("sellers")] if sellers else []
    return items.groupBy("order_id").agg(
        _first_non_null("seller_id", item_order()).alias("seller_id"),
        _first_non_null("product_id", item_order()).alias("product_id"),
        F.coalesce(F.sum("price"), F.lit(0.0)).alias("price"),
        F.coalesce(F.sum("freight_value"), F.lit(0.0)).alias("freight_value"),
        *more,
    )


def seller_cohort(items_with_ts: DataFrame) -> DataFrame:
    """Quarter of each seller's earliest kept delivered order, over all its
    items (S21), so not only sellers that are first on an order."""
    return (items_with_ts.groupBy("seller_id")
            .agg(F.min("order_purchase_timestamp").alias("first_purchase"))
            .select("seller_id", C.quarter_label("first_purchase").alias("seller_cohort")))


def dim_sellers(sellers: DataFrame) -> DataFrame:
    return sellers.select("seller_id", "seller_zip_code_prefix", "seller_city",
                          "seller_state").distinct()


def dim_customers(customers: DataFrame) -> DataFrame:
    return customers.select("customer_id", "customer_unique_id", "customer_zip_code_prefix",
                            "customer_city", "customer_state").distinct()


def dim_products(products: DataFrame, cat_trans: DataFrame) -> DataFrame:
    """Category filled with ``unknown``, English name else the original.
    Spark broadcasts the translation table if its size allows."""
    p = products.withColumn("product_category_name", C.fill_unknown("product_category_name"))
    return (p.join(cat_trans, "product_category_name", "left")
            .select("product_id", "product_category_name",
                    C.translate_category("product_category_name_english",
                                         "product_category_name").alias("product_category_name_en"),
                    "product_weight_g", "product_length_cm", "product_height_cm",
                    "product_width_cm")
            .distinct())


def kept_items(tables: Tables, kept: DataFrame) -> DataFrame:
    """Items of kept orders with the order's purchase time (inner join: other
    items never reach the fact)."""
    return tables.items.join(kept.select("order_id", enrich.PURCHASE), "order_id")


def freight_bucket_edges(fact: DataFrame) -> DataFrame:
    """One row: the global quintile cut points of freight (fact grain)."""
    return exact_quantiles(fact, "freight_value", FREIGHT_PROBS,
                           names=["_f20", "_f40", "_f60", "_f80"])


def add_freight_bucket(fact: DataFrame, edges: DataFrame | None = None) -> DataFrame:
    """Label by quintile; the four edges are scalar subqueries (one row)."""
    edges = freight_bucket_edges(fact) if edges is None else edges
    e = [F.lit(float("-inf")), F.col("_f20"), F.col("_f40"), F.col("_f60"), F.col("_f80"),
         F.lit(float("inf"))]
    return (C.with_scalars(fact, edges)
            .withColumn("freight_bucket", bucketize("freight_value", e, L.FREIGHT_LABELS))
            .drop("_f20", "_f40", "_f60", "_f80"))


#: Where the columns of the fact that are not the order's own come from.
CUSTOMER_COLS = ("customer_state", "customer_city")
SELLER_COLS = ("seller_state", "seller_city")
PRODUCT_COLS = ("product_category_name", "product_category_name_en")
ITEM_COLS = ("seller_id", "product_id", "price", "freight_value", "seller_cohort", "freight_bucket", *SELLER_COLS, *PRODUCT_COLS)


def fact_grain(tables: Tables, cfg: Config = DEFAULT_CONFIG, columns: Sequence[str] | None = None) -> DataFrame:
    """Kept orders x reviews with the items of each order, as far as ``columns``
    (all by default) need them."""
    need = set(columns or schemas.FACT_COLS)
    out = enrich.kept_orders(tables.orders, cfg)
    if need & set(ITEM_COLS):
        out = out.join(items_agg(tables.items, sellers="seller_cohort" in need), "order_id", "left")
    # the grain needs the reviews' rows even where their scores are not asked for
    return out.join(tables.reviews.select("order_id", "review_score"), "order_id", "left")


def grain_cohort(grain: DataFrame) -> DataFrame:
    """``seller_cohort`` from the grain's sets of sellers."""
    return seller_cohort(grain.select(F.explode("sellers").alias("seller_id"), enrich.PURCHASE))


def with_dimensions(grain: DataFrame, tables: Tables, need: set[str], split: bool = False) -> DataFrame:
    """The grain joined with the dimensions whose columns are needed.  With
    ``split`` (the grain is a table) rows without an item key go past the
    sellers' and products' joins."""
    joins: list[tuple[str, DataFrame]] = []
    sellers = tables.sellers.select("seller_id", *SELLER_COLS)
    if "seller_cohort" in need:
        cohort = grain_cohort(grain)
        joins.append(("seller_id", cohort.join(sellers, "seller_id", "left") if need & set(SELLER_COLS) else cohort))
    elif need & set(SELLER_COLS):
        joins.append(("seller_id", sellers))
    if need & set(PRODUCT_COLS):
        joins.append(("product_id", dim_products(tables.products, tables.cat_trans).select("product_id", *PRODUCT_COLS)))
    out = grain.drop("sellers")
    if joins:
        bare = reduce(operator.and_, [F.col(key).isNull() for key, _ in joins])
        known = out.where(~bare) if split else out
        for key, dim in joins:
            known = known.join(dim, key, "left")
        out = known.unionByName(out.where(bare), allowMissingColumns=True) if split else known
    if need & set(CUSTOMER_COLS):
        out = out.join(tables.customers.select("customer_id", *CUSTOMER_COLS), "customer_id", "left")
    fill = {c: C.fill_unknown(c) for c in PRODUCT_COLS if need & set(PRODUCT_COLS)}
    if "seller_cohort" in need:
        # sellers of kept orders always have a cohort; null seller stays null (S23)
        fill["seller_cohort"] = F.when(F.col("seller_id").isNotNull(), C.fill_unknown("seller_cohort"))
    return out.withColumns(fill | {"review_score": F.coalesce(F.col("review_score").cast("double"), F.lit(0.0))})


def fact_deliveries(tables: Tables, cfg: Config = DEFAULT_CONFIG, base: DataFrame | None = None, materialize: bool = True,
                    columns: Sequence[str] | None = None, reuse: bool = False) -> DataFrame:
    """The wide fact in declared column order (compute types): all 31 columns,
    or the ``columns`` asked for, built by the joins they need.

    Cohorts and freight quintiles are statistics of the grain itself.  With
    ``materialize`` the grain is written once where it is used twice, or where
    the caller says it will ``reuse`` the fact, as Parquet below the session's
    checkpoint folder.  ``base`` is a grain that the caller has staged."""
    need = set(columns or schemas.FACT_COLS)
    grain, staged_grain = base, base is not None
    if grain is None:
        grain = fact_grain(tables, cfg, need)
        if materialize and (reuse or need & {"seller_cohort", "freight_bucket"}):
            kept = need | {"order_id"} | ({"seller_id", "sellers", enrich.PURCHASE} if "seller_cohort" in need else set())
            kept |= {"seller_id"} if need & set(SELLER_COLS) else set()
            kept |= {"product_id"} if need & set(PRODUCT_COLS) else set()
            kept |= {"customer_id"} if need & set(CUSTOMER_COLS) else set()
            kept |= {"freight_value"} if "freight_bucket" in need else set()
            grain, staged_grain = staged(grain.select(*[c for c in grain.columns if c in kept | {"review_score"}]), "fact-grain"), True
    fact = with_dimensions(grain, tables, need, split=staged_grain)
    if "freight_bucket" in need:
        edges = freight_bucket_edges(grain)
        if staged_grain:  # four numbers of a table that is written already
            row = edges.first()
            edges = edges.sparkSession.range(1).select(*[F.lit(row[c] if row else None).cast("double").alias(c) for c in edges.columns])
        fact = add_freight_bucket(fact, edges)
    return fact.select(*[c for c in schemas.FACT_COLS if c in need])
