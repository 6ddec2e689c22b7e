"""DuckDB twins of the registered queries (the correctness oracle).

``BASE`` re-states the synthetic-table adapter and the two populations in
DuckDB SQL, working in epoch seconds; every query below is ``WITH BASE
SELECT ...``.  Non-integer outputs are rounded to 4 decimals on both sides,
money is summed as DECIMAL(18,2), counts are BIGINT and flags INTEGER.
"""

# ----------------------------------------------------------------- adapter
ADAPTER = r"""
o0 AS (
  SELECT o_orderkey AS k, o_custkey, o_orderstatus,
         ((o_orderkey % 1000003) * 2654435761) % 1000003 AS h,
         CAST(epoch(o_orderdate) AS BIGINT) AS p0
  FROM orders),
o1 AS (
  SELECT *, p0 + h % 86400 AS p,
    CASE WHEN k % 997 = 0 THEN NULL WHEN k % 1499 = 0 THEN 2667600 ELSE h % 90000 END AS a,
    CASE WHEN k % 53 = 0 THEN -3600 ELSE 3600 + h % 400000 END AS t2s,
    CASE WHEN k % 389 = 0 THEN NULL WHEN k % 1201 = 0 THEN 11160000
         WHEN h % 7 = 0 THEN 1200000 + h % 1500000 ELSE 86400 + h % 900000 END AS t3s,
    CASE WHEN k % 701 = 0 THEN 0 ELSE 16 + h % 14 END AS ed
  FROM o0),
src_orders AS (
  SELECT CAST(k AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id,
    CASE WHEN o_orderstatus IN ('F', 'O') THEN 'delivered' ELSE 'shipped' END AS order_status,
    p AS ps, p + a AS aps, p + coalesce(a, 0) + t2s AS cs,
    p + coalesce(a, 0) + t2s + t3s AS ds,
    p0 + ed * 86400 + CASE WHEN ed = 0 THEN 86399 ELSE 0 END AS es
  FROM o1),
src_items AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_linenumber AS INTEGER) AS order_item_id,
    CAST(l_partkey AS VARCHAR) AS product_id, CAST(l_suppkey AS VARCHAR) AS seller_id,
    CAST(l_extendedprice AS DOUBLE) AS price,
    CASE WHEN l_partkey % 499 = 0 THEN NULL
         ELSE round(l_quantity * 0.9 + l_discount * 100, 2) END AS freight_value
  FROM lineitem),
src_sellers AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS seller_id,
    CAST(10000 + (s_suppkey * 7919) % 90000 AS INTEGER) AS seller_zip_code_prefix,
    'city_' || CAST(s_suppkey % 17 AS VARCHAR) AS seller_city, n_name AS seller_state
  FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey),
src_customers AS (
  SELECT CAST(c_custkey AS VARCHAR) AS customer_id,
    'u' || CAST(c_custkey - c_custkey % 3 AS VARCHAR) AS customer_unique_id,
    CAST(10000 + (c_custkey * 7919) % 90000 AS INTEGER) AS customer_zip_code_prefix,
    'city_' || CAST(c_custkey % 41 AS VARCHAR) AS customer_city, n_name AS customer_state
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey),
src_reviews AS (
  SELECT CAST(k AS VARCHAR) AS order_id,
    CAST(CASE WHEN h % 7 = 0 THEN 1 + h % 3 ELSE 3 + h % 3 END AS INTEGER) AS review_score
  FROM o0 WHERE k % 131 <> 0
  UNION ALL
  SELECT CAST(k AS VARCHAR), CAST(1 + (h + 2) % 5 AS INTEGER) FROM o0 WHERE k % 173 = 0),
src_products AS (
  SELECT CAST(p_partkey AS VARCHAR) AS product_id,
    CASE WHEN p_partkey % 50 = 0 THEN NULL ELSE lower(p_type) END AS product_category_name,
    CASE WHEN p_partkey % 97 = 0 THEN NULL ELSE CAST(p_size AS DOUBLE) * 100.0 END AS product_weight_g,
    CAST(p_size AS DOUBLE) + 10 AS product_length_cm,
    CAST(p_size AS DOUBLE) + 5 AS product_height_cm,
    CAST(p_size AS DOUBLE) + 7 AS product_width_cm
  FROM part),
src_cat_trans AS (
  SELECT DISTINCT lower(p_type) AS product_category_name,
    'en_' || lower(p_type) AS product_category_name_english
  FROM part WHERE lower(p_type) <> 'promo')
"""

# ------------------------------------------------------- populations (seconds)
POPULATIONS = r"""
dlv AS (
  SELECT order_id, customer_id, ps, aps, cs, ds, es,
    (aps - ps) / 3600.0 AS r1, (cs - aps) / 3600.0 AS r2, (ds - cs) / 3600.0 AS r3,
    CAST(floor((ds - ps) / 86400.0) AS INTEGER) AS delivery_days,
    CAST(floor((es - ps) / 86400.0) AS INTEGER) AS estimated_days,
    CAST(floor((ds - es) / 86400.0) AS INTEGER) AS days_late,
    coalesce(CAST(ds > es AS INTEGER), 0) AS is_late,
    CAST(month(make_timestamp(ps * 1000000)) AS INTEGER) AS purchase_month,
    CAST(isodow(make_timestamp(ps * 1000000)) - 1 AS INTEGER) AS purchase_dayofweek,
    CAST(hour(make_timestamp(ps * 1000000)) AS INTEGER) AS purchase_hour,
    CAST(day(make_timestamp(ps * 1000000)) AS INTEGER) AS purchase_day
  FROM src_orders WHERE order_status = 'delivered'),
nb AS (
  SELECT *, r1 AS t1_approval_h, r2 AS t2_processing_h, r3 AS t3_shipping_h,
    delivery_days / nullif(estimated_days, 0) AS actual_vs_est_ratio
  FROM dlv),
pl_all AS (
  SELECT *,
    CASE WHEN r1 < 0 THEN 0.0 ELSE r1 END AS t1_approval_h,
    CASE WHEN r2 < 0 THEN 0.0 ELSE r2 END AS t2_processing_h,
    CASE WHEN r3 < 0 THEN 0.0 ELSE r3 END AS t3_shipping_h,
    delivery_days / nullif(estimated_days, 0) AS actual_vs_est_ratio
  FROM dlv),
kept AS (SELECT * FROM pl_all WHERE t1_approval_h <= 700 AND t3_shipping_h <= 3000)
"""

# ------------------------------------------------------------- fact (pipeline)
FACT = r"""
k_items AS (
  SELECT i.*, k.ps FROM src_items i JOIN kept k USING (order_id)),
per_order AS (
  SELECT order_id,
    arg_min(seller_id, CASE WHEN seller_id IS NOT NULL THEN {'a': order_item_id, 'b': product_id, 'c': seller_id} END) AS seller_id,
    arg_min(product_id, CASE WHEN product_id IS NOT NULL THEN {'a': order_item_id, 'b': product_id, 'c': seller_id} END) AS product_id,
    coalesce(sum(price), 0.0) AS price,
    coalesce(sum(freight_value), 0.0) AS freight_value
  FROM k_items GROUP BY order_id),
cohort AS (
  SELECT seller_id,
    CAST(year(make_timestamp(min(ps) * 1000000)) AS VARCHAR) || 'Q' ||
    CAST(quarter(make_timestamp(min(ps) * 1000000)) AS VARCHAR) AS seller_cohort
  FROM k_items GROUP BY seller_id),
dim_products AS (
  SELECT DISTINCT product_id, coalesce(p.product_category_name, 'unknown') AS product_category_name,
    coalesce(c.product_category_name_english, coalesce(p.product_category_name, 'unknown')) AS product_category_name_en,
    product_weight_g, product_length_cm, product_height_cm, product_width_cm
  FROM src_products p LEFT JOIN src_cat_trans c
    ON coalesce(p.product_category_name, 'unknown') = c.product_category_name),
fact0 AS (
  SELECT k.order_id, k.customer_id, po.seller_id, po.product_id,
    k.ps, k.aps, k.cs, k.ds, k.es,
    k.t1_approval_h, k.t2_processing_h, k.t3_shipping_h,
    k.delivery_days, k.estimated_days, k.days_late, k.actual_vs_est_ratio, k.is_late,
    k.purchase_month, k.purchase_dayofweek, k.purchase_hour,
    c.customer_state, c.customer_city, s.seller_state, s.seller_city,
    CASE WHEN po.seller_id IS NOT NULL THEN coalesce(co.seller_cohort, 'unknown') END AS seller_cohort,
    coalesce(dp.product_category_name, 'unknown') AS product_category_name,
    coalesce(dp.product_category_name_en, 'unknown') AS product_category_name_en,
    po.price, po.freight_value,
    coalesce(CAST(r.review_score AS DOUBLE), 0.0) AS review_score
  FROM kept k
  LEFT JOIN per_order po USING (order_id)
  LEFT JOIN src_reviews r ON r.order_id = k.order_id
  LEFT JOIN src_customers c ON c.customer_id = k.customer_id
  LEFT JOIN src_sellers s ON s.seller_id = po.seller_id
  LEFT JOIN cohort co ON co.seller_id = po.seller_id
  LEFT JOIN dim_products dp ON dp.product_id = po.product_id),
fq AS (SELECT quantile_cont(freight_value, [0.2, 0.4, 0.6, 0.8]) AS q FROM fact0),
fact AS (
  SELECT f.*, CASE
      WHEN freight_value <= q[1] THEN 'Sangat murah'
      WHEN freight_value > q[1] AND freight_value <= q[2] THEN 'Murah'
      WHEN freight_value > q[2] AND freight_value <= q[3] THEN 'Sedang'
      WHEN freight_value > q[3] AND freight_value <= q[4] THEN 'Mahal'
      WHEN freight_value > q[4] THEN 'Sangat mahal' END AS freight_bucket
  FROM fact0 f CROSS JOIN fq)
"""

BASE = "WITH " + ADAPTER.strip() + ",\n" + POPULATIONS.strip() + ",\n" + FACT.strip() + "\n"


def q(body: str) -> str:
    """Append a query to the shared CTEs; a body may open its own ``WITH``."""
    b = body.lstrip()
    if b[:4].upper() == "WITH":
        return BASE.rstrip() + ",\n" + b[4:].lstrip()
    return BASE + body


def r4(expr: str, alias: str) -> str:
    return f"round(CAST({expr} AS DOUBLE), 4) AS {alias}"
