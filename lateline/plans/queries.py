"""Registry of named queries: a Spark plan and, where SQL can state it, its
DuckDB twin.  Every query reads the driver's tables at ``sf_dir`` through
the adapter, so its work grows with them.

Seller thresholds use ``SYNTHETIC_CONFIG`` (active >= 95 orders, chronic
> 12 %): every synthetic supplier has 68-122 orders, so the reference's
20-order rule would make all of them active.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lateline.config import SYNTHETIC_CONFIG as CFG
from lateline.functions import columns as C
from lateline.operators import breakdowns as B
from lateline.operators import enrich, fact as FT, kpi, marts
from lateline.oracle_sql import q
from lateline.plans.present import present
from lateline.session import staged
from lateline.sources.synthetic import synthetic_tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


_TABLES: dict = {}


def _session_key(spark: SparkSession) -> tuple:
    # application id: a new SparkContext never reuses an old key (object ids can be)
    return (spark.sparkContext.applicationId, id(spark))


def _tables(spark: SparkSession, sf_dir: str):
    """Source relations resolved once per session and folder (file listing
    and footers); the DataFrames stay lazy, every query still scans."""
    key = (_session_key(spark), sf_dir)
    if key not in _TABLES:
        _TABLES[key] = synthetic_tables(spark, sf_dir)
    return _TABLES[key]


_LAZY: dict = {}


def _memo(ctx: "Ctx", name: str, build):
    """Lazy DataFrames (plans, no data) shared per session and folder; the
    fact, which holds checkpointed data, is built per query instead."""
    key = (_session_key(ctx.spark), ctx.sf_dir, name)
    if key not in _LAZY:
        _LAZY[key] = build()
    return _LAZY[key]


@dataclass
class Ctx:
    spark: SparkSession
    sf_dir: str

    @cached_property
    def t(self):
        return _tables(self.spark, self.sf_dir)

    @cached_property
    def nb(self):
        return _memo(self, "nb", lambda: enrich.notebook_orders(self.t.orders))

    @cached_property
    def kept(self):
        return _memo(self, "kept", lambda: enrich.kept_orders(self.t.orders, CFG))

    @cached_property
    def fact(self):
        return FT.fact_deliveries(self.t, CFG)

    def facts(self, *columns: str, reuse: bool = False):
        """The fact with these columns only, built by the joins they need."""
        return FT.fact_deliveries(self.t, CFG, columns=columns, reuse=reuse)

    @cached_property
    def risk_rows(self):
        """The risk model's rows, written once: the split, the fit and the reports
        read this narrow table, not the fact's joins."""
        fact = self.fact_table if "fact_table" in self.__dict__ else self.facts(*R.FACT_COLS)
        return staged(R.ml_features(fact), "risk-rows")

    @cached_property
    def fact_table(self):
        """The whole fact written once, for the many readers of a published version."""
        return staged(self.fact, "fact")

    @cached_property
    def oi(self):
        return _memo(self, "oi", lambda: B.orders_items(self.nb, self.t.items))

    @cached_property
    def oc(self):
        return _memo(self, "oc", lambda: B.orders_customers(self.nb, self.t.customers))

    @cached_property
    def orr(self):
        return _memo(self, "orr", lambda: B.orders_reviews(self.nb, self.t.reviews))


def register(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            # timestamps carry no zone: every derived hour/day/month is UTC
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return present(fn(Ctx(spark, sf_dir)))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = q(sql)
        return fn
    return deco


TS_TXT = "strftime(make_timestamp({c} * 1000000), '%Y-%m-%d %H:%M:%S')"


def r4(expr: str, alias: str) -> str:
    return f"round(CAST({expr} AS DOUBLE), 4) AS {alias}"


# =================================================================== minimum slice
@register("late_by_state", f"""
SELECT customer_state, CAST(count(order_id) AS BIGINT) AS total_orders,
  CAST(sum(is_late) AS BIGINT) AS late_orders, {r4('avg(is_late)', 'late_rate')},
  {r4('avg(delivery_days)', 'avg_days')}, {r4('avg(t3_shipping_h)', 'avg_t3')},
  {r4('avg(is_late) * 100', 'late_pct')},
  CASE WHEN avg(is_late) * 100 >= 15 THEN 'red' WHEN avg(is_late) * 100 >= 8 THEN 'orange'
       ELSE 'green' END AS severity
FROM nb JOIN src_customers USING (customer_id)
WHERE customer_state IS NOT NULL GROUP BY customer_state""")
def _late_by_state(c: Ctx):
    """Late rate, mean days and shipping hours per customer state (notebook population)."""
    return B.late_by_state(c.oc)


# =================================================================== star schema
_FACT_SQL = f"""
SELECT order_id, customer_id, seller_id, product_id,
  {TS_TXT.format(c='ps')} AS order_purchase_timestamp,
  {TS_TXT.format(c='aps')} AS order_approved_at,
  {TS_TXT.format(c='cs')} AS order_delivered_carrier_date,
  {TS_TXT.format(c='ds')} AS order_delivered_customer_date,
  {TS_TXT.format(c='es')} AS order_estimated_delivery_date,
  {r4('t1_approval_h', 't1_approval_h')}, {r4('t2_processing_h', 't2_processing_h')},
  {r4('t3_shipping_h', 't3_shipping_h')}, delivery_days, estimated_days, days_late,
  {r4('actual_vs_est_ratio', 'actual_vs_est_ratio')}, is_late, purchase_month,
  purchase_dayofweek, purchase_hour, customer_state, customer_city, seller_state, seller_city,
  seller_cohort, freight_bucket, product_category_name, product_category_name_en,
  {r4('price', 'price')}, {r4('freight_value', 'freight_value')},
  {r4('review_score', 'review_score')}
FROM fact"""


@register("fact_deliveries", _FACT_SQL)
def _fact(c: Ctx):
    """The 31-column wide fact (order x review grain)."""
    return c.fact


@register("dim_sellers", """
SELECT DISTINCT seller_id, seller_zip_code_prefix, seller_city, seller_state FROM src_sellers""")
def _dim_sellers(c: Ctx):
    return FT.dim_sellers(c.t.sellers)


@register("dim_customers", """
SELECT DISTINCT customer_id, customer_unique_id, customer_zip_code_prefix, customer_city,
  customer_state FROM src_customers""")
def _dim_customers(c: Ctx):
    return FT.dim_customers(c.t.customers)


@register("dim_products", f"""
SELECT product_id, product_category_name, product_category_name_en,
  {r4('product_weight_g', 'product_weight_g')}, {r4('product_length_cm', 'product_length_cm')},
  {r4('product_height_cm', 'product_height_cm')}, {r4('product_width_cm', 'product_width_cm')}
FROM dim_products""")
def _dim_products(c: Ctx):
    return FT.dim_products(c.t.products, c.t.cat_trans)


@register("items_agg", f"""
SELECT order_id,
  arg_min(seller_id, CASE WHEN seller_id IS NOT NULL THEN {{'a': order_item_id, 'b': product_id, 'c': seller_id}} END) AS seller_id,
  arg_min(product_id, CASE WHEN product_id IS NOT NULL THEN {{'a': order_item_id, 'b': product_id, 'c': seller_id}} END) AS product_id,
  {r4('coalesce(sum(price), 0.0)', 'price')}, {r4('coalesce(sum(freight_value), 0.0)', 'freight_value')}
FROM src_items GROUP BY order_id""")
def _items_agg(c: Ctx):
    """First seller and product (declared order) and summed money per order, all items."""
    return FT.items_agg(c.t.items)


@register("seller_cohort", "SELECT seller_id, seller_cohort FROM cohort")
def _seller_cohort(c: Ctx):
    """Quarter of each seller's first kept delivered order, over all its items."""
    return FT.seller_cohort(FT.kept_items(c.t, c.kept))


@register("outlier_audit", """
SELECT CAST(count(*) AS BIGINT) AS rows_before,
  CAST(count_if(NOT coalesce(t1_approval_h <= 700, false)) AS BIGINT) AS removed_approval,
  CAST(count_if(coalesce(t1_approval_h <= 700, false) AND NOT coalesce(t3_shipping_h <= 3000, false)) AS BIGINT) AS removed_shipping,
  CAST(count_if(coalesce(t1_approval_h <= 700, false) AND coalesce(t3_shipping_h <= 3000, false)) AS BIGINT) AS rows_after,
  CAST(count(*) - count_if(coalesce(t1_approval_h <= 700, false) AND coalesce(t3_shipping_h <= 3000, false)) AS BIGINT) AS rows_removed
FROM pl_all""")
def _outlier_audit(c: Ctx):
    """Rows removed by each outlier rule (pipeline population)."""
    return enrich.outlier_audit(enrich.enrich_orders(enrich.filter_delivered(c.t.orders)), CFG)


# =================================================================== pipeline marts
_SELLER_ALL_SQL = f"""
SELECT seller_id, seller_state, seller_city, seller_cohort,
  CAST(count(DISTINCT order_id) AS BIGINT) AS total_orders,
  CAST(sum(is_late) AS BIGINT) AS late_orders, {r4('avg(is_late)', 'late_rate')},
  {r4('avg(t2_processing_h)', 'avg_t2_processing_h')},
  {r4('avg(delivery_days)', 'avg_delivery_days')},
  {r4('coalesce(sum(CAST(price AS DECIMAL(18,2))), 0)', 'total_revenue')},
  CAST(avg(is_late) > 0.12 AND count(DISTINCT order_id) >= 95 AS INTEGER) AS is_chronic,
  CAST(count(DISTINCT order_id) < 95 AND avg(is_late) = 1.0 AS INTEGER) AS is_new_problem
FROM fact WHERE seller_id IS NOT NULL
GROUP BY seller_id, seller_state, seller_city, seller_cohort"""


@register("seller_performance_all", _SELLER_ALL_SQL)
def _seller_all(c: Ctx):
    return marts.seller_performance_all(c.facts(*marts.SELLER_COLS), CFG)


@register("agg_seller_performance",
          "SELECT * FROM (" + _SELLER_ALL_SQL + ") s WHERE total_orders >= 95")
def _agg_seller(c: Ctx):
    return marts.agg_seller_performance(c.facts(*marts.SELLER_COLS), CFG)


@register("agg_regional_stats", f"""
SELECT customer_state, CAST(count(order_id) AS BIGINT) AS total_orders,
  CAST(sum(is_late) AS BIGINT) AS late_orders, {r4('avg(is_late)', 'late_rate')},
  {r4('avg(delivery_days)', 'avg_delivery_days')}, {r4('avg(t3_shipping_h)', 'avg_t3_shipping_h')}
FROM fact WHERE customer_state IS NOT NULL GROUP BY customer_state""")
def _agg_regional(c: Ctx):
    return marts.agg_regional_stats(c.facts(*marts.REGIONAL_COLS))


@register("agg_monthly_trend", f"""
SELECT strftime(make_timestamp(ps * 1000000), '%Y-%m') AS year_month,
  CAST(count(order_id) AS BIGINT) AS total_orders, CAST(sum(is_late) AS BIGINT) AS late_orders,
  {r4('avg(is_late)', 'late_rate')}, {r4('avg(delivery_days)', 'avg_delivery_days')}
FROM fact GROUP BY 1""")
def _agg_monthly(c: Ctx):
    return marts.agg_monthly_trend(c.facts(*marts.MONTHLY_COLS))


@register("agg_cohort_performance", f"""
SELECT seller_cohort, CAST(count(DISTINCT seller_id) AS BIGINT) AS seller_count,
  CAST(count(order_id) AS BIGINT) AS total_orders, CAST(sum(is_late) AS BIGINT) AS late_orders,
  {r4('avg(is_late)', 'late_rate')}, {r4('avg(delivery_days)', 'avg_delivery_days')}
FROM fact WHERE seller_cohort IS NOT NULL GROUP BY seller_cohort""")
def _agg_cohort(c: Ctx):
    return marts.agg_cohort_performance(c.facts(*marts.COHORT_COLS))


_KPI_SQL = """
WITH v AS (
  SELECT avg(1 - is_late) * 100 AS on_time,
    avg(CAST(coalesce(days_late, 0) > 3 AS INTEGER)) * 100 AS breach,
    avg(actual_vs_est_ratio) AS sla,
    avg(CAST(t2_processing_h <= 48 AS INTEGER)) * 100 AS processing
  FROM fact),
s AS (
  SELECT avg(late_rate) * 100 AS seller_late FROM (
    SELECT seller_id, count(DISTINCT order_id) AS n, avg(is_late) AS late_rate
    FROM fact WHERE seller_id IS NOT NULL GROUP BY seller_id) WHERE n >= 95)
SELECT kpi_name, round(actual_value, 4) AS actual_value, target_value, target_operator, status, unit
FROM (
  SELECT 'On-Time Delivery Rate' AS kpi_name, round_even(on_time, 2) AS actual_value, 95.0 AS target_value, '>' AS target_operator,
    CASE WHEN on_time >= 95 THEN '✅' ELSE '❌' END AS status, '%' AS unit FROM v
  UNION ALL SELECT 'Customer Tolerance Breach Rate', round_even(breach, 2), 2.0, '<',
    CASE WHEN breach <= 2 THEN '✅' ELSE '❌' END, '%' FROM v
  UNION ALL SELECT 'SLA Accuracy Rate', round_even(sla, 3), 0.8, '>=',
    CASE WHEN sla >= 0.8 THEN '✅' ELSE '❌' END, 'ratio' FROM v
  UNION ALL SELECT 'Late Rate per Seller (avg aktif)', round_even(seller_late, 2), 5.0, '<',
    CASE WHEN seller_late <= 5 THEN '✅' ELSE '❌' END, '%' FROM s
  UNION ALL SELECT 'Processing Time Compliance', round_even(processing, 2), 80.0, '>',
    CASE WHEN processing >= 80 THEN '✅' ELSE '❌' END, '%' FROM v) k"""


@register("kpi_summary", _KPI_SQL)
def _kpi_summary(c: Ctx):
    """Five KPIs with target, displayed operator and status."""
    return kpi.kpi_summary(c.facts(*kpi.KPI_COLS, reuse=True), CFG)


# =================================================================== notebook breakdowns
def _lr(prefix: str = "") -> str:
    return (f"CAST(count(order_id) AS BIGINT) AS {prefix}total_orders, "
            f"CAST(sum(is_late) AS BIGINT) AS {prefix}late_orders, "
            f"{r4('avg(is_late)', prefix + 'late_rate')}")


def _sev(expr: str, hi: float, mid: float) -> str:
    return (f"CASE WHEN {expr} >= {hi} THEN 'red' WHEN {expr} >= {mid} THEN 'orange' "
            f"WHEN {expr} IS NOT NULL THEN 'green' END")


@register("order_status_distribution", """
SELECT order_status, CAST(count(*) AS BIGINT) AS n_orders,
  round(count(*) * 100.0 / sum(count(*)) OVER (), 4) AS share_pct
FROM src_orders GROUP BY order_status""")
def _status_dist(c: Ctx):
    return B.order_status_distribution(c.t.orders)


@register("delivered_summary", f"""
SELECT CAST(count(*) AS BIGINT) AS delivered, CAST(sum(is_late) AS BIGINT) AS late_orders,
  {r4('avg(is_late) * 100', 'late_pct')}, CAST(sum(1 - is_late) AS BIGINT) AS on_time_orders,
  {r4('avg(1 - is_late) * 100', 'on_time_pct')}
FROM nb""")
def _delivered_summary(c: Ctx):
    return B.delivered_summary(c.nb)


_DESC_COLS = ["t1_approval_h", "t2_processing_h", "t3_shipping_h", "delivery_days",
              "estimated_days", "days_late", "actual_vs_est_ratio", "is_late"]
_DESC_LONG = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST({c} AS DOUBLE) AS value FROM nb" for c in _DESC_COLS)


@register("describe_columns", f"""
SELECT "column", CAST(count(value) AS BIGINT) AS count, {r4('avg(value)', 'mean')},
  {r4('stddev_samp(value)', 'std')}, {r4('min(value)', 'min')},
  {r4('quantile_cont(value, 0.25)', 'q25')}, {r4('quantile_cont(value, 0.5)', 'q50')},
  {r4('quantile_cont(value, 0.75)', 'q75')}, {r4('max(value)', 'max')}
FROM ({_DESC_LONG}) l GROUP BY "column" """)
def _describe(c: Ctx):
    """count/mean/std/min/quartiles/max of the eight derived columns."""
    return B.describe_columns(c.nb, _DESC_COLS)


_STAGE_LONG = " UNION ALL ".join(
    f"SELECT '{s}' AS stage, is_late, CAST({s} AS DOUBLE) AS value FROM nb" for s in B.STAGES)


@register("stage_stats", f"""
SELECT stage, CAST(count(value) AS BIGINT) AS n, {r4('round_even(avg(value), 1)', 'mean_h')},
  {r4('round_even(quantile_cont(value, 0.5), 1)', 'median_h')}, {r4('round_even(quantile_cont(value, 0.95), 1)', 'p95_h')},
  {r4('round_even(max(value), 1)', 'max_h')}, {r4('round_even(max(value) / 24.0, 1)', 'max_days')}
FROM ({_STAGE_LONG}) l WHERE value >= 0 GROUP BY stage""")
def _stage_stats(c: Ctx):
    """Mean, median, P95 and max per stage over non-negative hours."""
    return B.stage_stats(c.nb)


@register("stage_late_vs_ontime", f"""
SELECT stage, {r4('round_even(avg(CASE WHEN is_late = 1 THEN value END), 1)', 'late_mean_h')},
  {r4('round_even(avg(CASE WHEN is_late = 0 THEN value END), 1)', 'on_time_mean_h')},
  {r4('round_even(avg(CASE WHEN is_late = 1 THEN value END) - avg(CASE WHEN is_late = 0 THEN value END), 1)', 'diff_h')},
  {r4('round_even((avg(CASE WHEN is_late = 1 THEN value END) - avg(CASE WHEN is_late = 0 THEN value END)) / 24.0, 1)', 'diff_days')}
FROM ({_STAGE_LONG}) l GROUP BY stage""")
def _stage_late(c: Ctx):
    return B.stage_late_vs_ontime(c.nb)


_MONTHS = "['Jan','Feb','Mar','Apr','May','Jun','Jul','Aug','Sep','Oct','Nov','Dec']"
_DAYS = "['Senin','Selasa','Rabu','Kamis','Jumat','Sabtu','Minggu']"


@register("late_by_month", f"""
SELECT purchase_month, {_lr()}, {r4('avg(delivery_days)', 'avg_days')},
  {r4('avg(is_late) * 100', 'late_pct')}, {_MONTHS}[purchase_month] AS month_name,
  {_sev('avg(is_late) * 100', 15.0, 8.0)} AS severity
FROM nb GROUP BY purchase_month""")
def _late_by_month(c: Ctx):
    return B.late_by_month(c.nb)


@register("late_by_dow", f"""
SELECT purchase_dayofweek, {_lr()}, {r4('avg(is_late) * 100', 'late_pct')}
FROM nb GROUP BY purchase_dayofweek""")
def _late_by_dow(c: Ctx):
    return B.late_by_dow(c.nb)


@register("late_by_hour", f"""
SELECT purchase_hour, {_lr()}, {r4('avg(is_late) * 100', 'late_pct')}
FROM nb GROUP BY purchase_hour""")
def _late_by_hour(c: Ctx):
    return B.late_by_hour(c.nb)


@register("dow_detail", f"""
SELECT purchase_dayofweek, {_DAYS}[purchase_dayofweek + 1] AS day_name, {_lr()},
  {r4('avg(is_late) * 100', 'late_pct')}
FROM nb GROUP BY 1, 2""")
def _dow_detail(c: Ctx):
    return B.dow_detail(c.nb)


@register("weekend_vs_workday", f"""
SELECT CAST(purchase_dayofweek >= 5 AS INTEGER) AS is_weekend, {_lr()},
  CASE WHEN purchase_dayofweek >= 5 THEN 'Weekend' ELSE 'Hari Kerja' END AS category,
  {r4('avg(is_late) * 100', 'late_pct')}
FROM nb GROUP BY is_weekend, category""")
def _weekend(c: Ctx):
    return B.weekend_vs_workday(c.nb)


_PERIOD_ORD = ("CASE WHEN purchase_hour >= 6 AND purchase_hour < 12 THEN 1 "
               "WHEN purchase_hour >= 12 AND purchase_hour < 18 THEN 2 "
               "WHEN purchase_hour >= 18 AND purchase_hour < 24 THEN 3 ELSE 0 END")
_PERIOD = ("CASE WHEN purchase_hour >= 6 AND purchase_hour < 12 THEN 'Pagi (06-12)' "
           "WHEN purchase_hour >= 12 AND purchase_hour < 18 THEN 'Siang (12-18)' "
           "WHEN purchase_hour >= 18 AND purchase_hour < 24 THEN 'Malam (18-24)' "
           "ELSE 'Dini Hari (00-06)' END")


@register("late_by_time_period", f"""
SELECT {_PERIOD_ORD} AS period_ord, {_PERIOD} AS time_period, {_lr()},
  {r4('avg(is_late) * 100', 'late_pct')}
FROM nb GROUP BY 1, 2""")
def _time_period(c: Ctx):
    return B.late_by_time_period(c.nb)


@register("november_daily", f"""
SELECT purchase_day AS day, {_lr()}, {r4('avg(is_late) * 100', 'late_pct')},
  CAST(purchase_day = 24 AS INTEGER) AS is_event_day
FROM nb WHERE purchase_month = 11 GROUP BY purchase_day""")
def _november(c: Ctx):
    return B.november_daily(c.nb, CFG)


@register("group_rate_benchmark", f"""
SELECT {r4('avg(late_rate)', 'mean_group_rate')}, CAST(count(*) AS BIGINT) AS n_groups
FROM (SELECT purchase_month, avg(is_late) AS late_rate FROM nb GROUP BY purchase_month) g""")
def _benchmark(c: Ctx):
    """Unweighted mean of the monthly late rates (reference line of the charts)."""
    return B.group_rate_benchmark(B.late_by_month(c.nb))


_RATIO_ORD = ("CASE WHEN r > 0 AND r <= 0.5 THEN 0 WHEN r > 0.5 AND r <= 0.75 THEN 1 "
              "WHEN r > 0.75 AND r <= 1.0 THEN 2 WHEN r > 1.0 AND r <= 1.5 THEN 3 "
              "WHEN r > 1.5 AND r <= 20 THEN 4 END")
_RATIO_LBL = ("CASE WHEN r > 0 AND r <= 0.5 THEN '<50%' WHEN r > 0.5 AND r <= 0.75 THEN '50-75%' "
              "WHEN r > 0.75 AND r <= 1.0 THEN '75-100%' WHEN r > 1.0 AND r <= 1.5 THEN '100-150%' "
              "WHEN r > 1.5 AND r <= 20 THEN '>150%' END")


@register("ratio_buckets", f"""
SELECT bucket_ord, ratio_bucket, n, round(n * 100.0 / sum(n) OVER (), 4) AS share_pct FROM (
  SELECT {_RATIO_ORD} AS bucket_ord, {_RATIO_LBL} AS ratio_bucket, CAST(count(*) AS BIGINT) AS n
  FROM (SELECT actual_vs_est_ratio AS r FROM nb WHERE actual_vs_est_ratio IS NOT NULL) x
  GROUP BY 1, 2) b WHERE bucket_ord IS NOT NULL""")
def _ratio_buckets(c: Ctx):
    """Counts per actual/estimate ratio bucket; ratio 0 and > 20 have no bucket."""
    return B.ratio_buckets(c.nb)


@register("ratio_shares", f"""
SELECT CAST(count_if(r < 0.5) AS BIGINT) AS n_under_half,
  {r4('avg(CAST(r < 0.5 AS INTEGER)) * 100', 'pct_under_half')},
  CAST(count_if(r > 1.0) AS BIGINT) AS n_over_one,
  {r4('avg(CAST(r > 1.0 AS INTEGER)) * 100', 'pct_over_one')}
FROM (SELECT actual_vs_est_ratio AS r FROM nb WHERE actual_vs_est_ratio IS NOT NULL) x""")
def _ratio_shares(c: Ctx):
    return B.ratio_shares(c.nb)


_APPR = [(0, 1, '<1h'), (1, 12, '1-12h'), (12, 24, '12-24h'), (24, 48, '24-48h'),
         (48, 100, '48-100h'), (100, None, '>100h')]


def _appr_case(kind: str) -> str:
    parts = []
    for i, (lo, hi, lbl) in enumerate(_APPR):
        hi_s = "mx" if hi is None else str(hi)
        parts.append(f"WHEN t1 > {lo} AND t1 <= {hi_s} THEN " + (f"'{lbl}'" if kind == "l" else str(i)))
    return "CASE " + " ".join(parts) + " END"


@register("approval_buckets", f"""
SELECT bucket_ord, approval_bucket, CAST(count(*) AS BIGINT) AS n,
  {r4('avg(is_late) * 100', 'late_pct')}
FROM (SELECT {_appr_case('o')} AS bucket_ord, {_appr_case('l')} AS approval_bucket, is_late
      FROM (SELECT t1_approval_h AS t1, is_late FROM nb WHERE t1_approval_h IS NOT NULL) a
      CROSS JOIN (SELECT max(t1_approval_h) AS mx FROM nb) m) b
WHERE bucket_ord IS NOT NULL GROUP BY 1, 2""")
def _approval_buckets(c: Ctx):
    return B.approval_buckets(c.nb)


@register("approval_tail", f"""
SELECT {r4('max(t1)', 'max_h')}, CAST(count(*) AS BIGINT) AS n_known,
  CAST(count_if(t1 > 24) AS BIGINT) AS n_over_24, {r4('avg(CAST(t1 > 24 AS INTEGER)) * 100', 'pct_over_24')},
  CAST(count_if(t1 > 100) AS BIGINT) AS n_over_100, {r4('avg(CAST(t1 > 100 AS INTEGER)) * 100', 'pct_over_100')},
  CAST(count_if(t1 > 200) AS BIGINT) AS n_over_200, {r4('avg(CAST(t1 > 200 AS INTEGER)) * 100', 'pct_over_200')},
  CAST(count_if(t1 > 500) AS BIGINT) AS n_over_500, {r4('avg(CAST(t1 > 500 AS INTEGER)) * 100', 'pct_over_500')},
  CAST(count_if(t1 = (SELECT max(t1_approval_h) FROM nb)) AS BIGINT) AS n_at_max,
  {r4('round_even(max(t1) / 24.0, 1)', 'max_days')}
FROM (SELECT t1_approval_h AS t1 FROM nb WHERE t1_approval_h IS NOT NULL) x""")
def _approval_tail(c: Ctx):
    return B.approval_tail(c.nb)


_OI = "(SELECT * FROM nb JOIN src_items USING (order_id))"
_SELLER_ITEMS_SQL = f"""
SELECT seller_id, CAST(count(DISTINCT order_id) AS BIGINT) AS total_orders,
  {r4('avg(is_late)', 'late_rate')}, {r4('avg(t2_processing_h)', 'avg_t2')},
  {r4('avg(delivery_days)', 'avg_delivery')},
  {r4('sum(CAST(price AS DECIMAL(18,2)))', 'total_revenue')},
  {r4('avg(is_late) * 100', 'late_pct')}
FROM {_OI} oi GROUP BY seller_id"""


@register("seller_perf_items", _SELLER_ITEMS_SQL)
def _seller_items(c: Ctx):
    """Item-grain seller performance (notebook population)."""
    return B.seller_perf_items(c.oi)


@register("seller_perf_summary", """
SELECT CAST(count(*) AS BIGINT) AS sellers, CAST(count_if(total_orders >= 95) AS BIGINT) AS active_sellers,
  CAST(count_if(total_orders >= 95 AND late_rate = 0) AS BIGINT) AS perfect_sellers,
  CAST(count_if(total_orders >= 95 AND late_rate > 0.12) AS BIGINT) AS chronic_sellers
FROM (SELECT seller_id, count(DISTINCT order_id) AS total_orders, avg(is_late) AS late_rate
      FROM nb JOIN src_items USING (order_id) GROUP BY seller_id) s""")
def _seller_summary(c: Ctx):
    return B.seller_perf_summary(B.seller_perf_items(c.oi), CFG)


_CAT_ITEMS = """(SELECT nb.*, oi.product_id, coalesce(ct.product_category_name_english, p.product_category_name) AS category_en
  FROM nb JOIN src_items oi USING (order_id)
  JOIN src_products p ON p.product_id = oi.product_id
  LEFT JOIN src_cat_trans ct ON ct.product_category_name = p.product_category_name)"""
_CAT_SQL = f"""
SELECT category_en, CAST(count(DISTINCT order_id) AS BIGINT) AS total_orders,
  {r4('avg(is_late)', 'late_rate')}, {r4('avg(delivery_days)', 'avg_days')},
  {r4('avg(is_late) * 100', 'late_pct')}
FROM {_CAT_ITEMS} ci WHERE category_en IS NOT NULL GROUP BY category_en
HAVING count(DISTINCT order_id) >= 100"""


@register("late_by_category", _CAT_SQL)
def _late_by_category(c: Ctx):
    return B.late_by_category(B.category_items(c.oi, c.t.products, c.t.cat_trans), CFG)


_ORR = "(SELECT nb.*, r.review_score FROM nb JOIN src_reviews r USING (order_id))"


@register("review_late_vs_ontime", f"""
SELECT is_late, CAST(count(*) AS BIGINT) AS n, {r4('avg(review_score)', 'mean_score')},
  {r4('min(review_score)', 'min_score')}, {r4('max(review_score)', 'max_score')},
  CAST(count_if(review_score >= 4) AS BIGINT) AS n_score_4_5,
  {r4('avg(CAST(review_score >= 4 AS INTEGER)) * 100', 'pct_score_4_5')},
  {r4('quantile_cont(review_score, 0.25)', 'q25')}, {r4('quantile_cont(review_score, 0.5)', 'median')},
  {r4('quantile_cont(review_score, 0.75)', 'q75')}
FROM {_ORR} r GROUP BY is_late""")
def _review_late(c: Ctx):
    return B.review_late_vs_ontime(c.orr)


def _case(col: str, edges, labels, kind: str) -> str:
    parts = []
    for i, lbl in enumerate(labels):
        out = f"'{lbl}'" if kind == "l" else str(i)
        parts.append(f"WHEN {col} > {edges[i]} AND {col} <= {edges[i + 1]} THEN {out}")
    return "CASE " + " ".join(parts) + " END"


_DEL_E, _DEL_L = [0, 7, 14, 21, 30, 200], ['<7d', '7-14d', '14-21d', '21-30d', '>30d']
_DL_E, _DL_L = [0, 3, 7, 14, 30, 200], ['1-3d late', '4-7d late', '8-14d late', '15-30d late', '>30d late']


@register("review_by_delivery_bucket", f"""
SELECT * FROM (
  SELECT {_case('delivery_days', _DEL_E, _DEL_L, 'o')} AS bucket_ord,
    {_case('delivery_days', _DEL_E, _DEL_L, 'l')} AS delivery_bucket,
    {r4('avg(review_score)', 'mean_score')}, CAST(count(*) AS BIGINT) AS n
  FROM {_ORR} r GROUP BY 1, 2) x WHERE bucket_ord IS NOT NULL""")
def _review_delivery(c: Ctx):
    return B.review_by_delivery_bucket(c.orr)


@register("score_crosstab", f"""
SELECT is_late,
  {', '.join(f'CAST(count_if(review_score = {s}) AS BIGINT) AS n_{s}' for s in range(1, 6))},
  {', '.join(r4(f'count_if(review_score = {s}) * 100.0 / count(*)', f'pct_{s}') for s in range(1, 6))}
FROM {_ORR} r WHERE review_score IN (1, 2, 3, 4, 5) GROUP BY is_late""")
def _crosstab(c: Ctx):
    """is_late x review score counts and row percentages."""
    return B.score_crosstab(c.orr)


@register("review_tolerance", f"""
SELECT * FROM (
  SELECT {_case('days_late', _DL_E, _DL_L, 'o')} AS bucket_ord,
    {_case('days_late', _DL_E, _DL_L, 'l')} AS late_bucket,
    {r4('avg(review_score)', 'mean_score')}, CAST(count(*) AS BIGINT) AS n
  FROM {_ORR} r WHERE is_late = 1 GROUP BY 1, 2) x WHERE bucket_ord IS NOT NULL""")
def _tolerance(c: Ctx):
    return B.review_tolerance(c.orr)


_FIRST = f"""(SELECT seller_id,
    CAST(year(make_timestamp(min(ps) * 1000000)) AS VARCHAR) || 'Q' ||
    CAST(quarter(make_timestamp(min(ps) * 1000000)) AS VARCHAR) AS cohort
  FROM {_OI} oi GROUP BY seller_id)"""


@register("cohort_sizes", f"""
SELECT cohort, CAST(count(*) AS BIGINT) AS n_sellers FROM {_FIRST} f GROUP BY cohort""")
def _cohort_sizes(c: Ctx):
    return B.cohort_sizes(c.oi)


@register("cohort_perf_items", f"""
SELECT cohort, CAST(count(DISTINCT order_id) AS BIGINT) AS total_orders,
  CAST(sum(is_late) AS BIGINT) AS late_orders, {r4('avg(is_late)', 'late_rate')},
  CAST(count(DISTINCT seller_id) AS BIGINT) AS seller_count, {r4('avg(is_late) * 100', 'late_pct')},
  {_sev('avg(is_late) * 100', 10.0, 7.0)} AS severity
FROM {_OI} oi JOIN {_FIRST} f USING (seller_id) GROUP BY cohort""")
def _cohort_perf(c: Ctx):
    return B.cohort_perf_items(c.oi)


_OF = f"""(SELECT order_id,
    CAST(coalesce(sum(CAST(freight_value AS DECIMAL(18,2))), 0) AS DOUBLE) AS total_freight,
    CAST(coalesce(sum(CAST(price AS DECIMAL(18,2))), 0) AS DOUBLE) AS total_price,
    max(is_late) AS is_late
  FROM {_OI} oi GROUP BY order_id)"""


@register("order_freight", f"""
SELECT order_id, {r4('total_freight', 'total_freight')}, {r4('total_price', 'total_price')},
  is_late, {r4('total_freight / nullif(total_price, 0)', 'freight_ratio')}
FROM {_OF} o""")
def _order_freight(c: Ctx):
    return B.order_freight(c.oi)


@register("order_freight_summary", f"""
SELECT CAST(count(*) AS BIGINT) AS n_orders, {r4('avg(total_freight)', 'mean_freight')},
  {r4('avg(total_price)', 'mean_price')}, {r4('avg(total_freight / nullif(total_price, 0))', 'mean_ratio')}
FROM {_OF} o""")
def _order_freight_summary(c: Ctx):
    return B.order_freight_summary(B.order_freight(c.oi))


_FREIGHT_L = ['Sangat murah', 'Murah', 'Sedang', 'Mahal', 'Sangat mahal']


def _qcut(kind: str) -> str:
    parts = []
    for i, lbl in enumerate(_FREIGHT_L):
        lo = f"total_freight >= e[1]" if i == 0 else f"total_freight > e[{i + 1}]"
        out = f"'{lbl}'" if kind == "l" else str(i)
        parts.append(f"WHEN {lo} AND total_freight <= e[{i + 2}] THEN {out}")
    return "CASE " + " ".join(parts) + " END"


@register("late_by_freight", f"""
SELECT bucket_ord, freight_bucket, CAST(count(*) AS BIGINT) AS total_orders,
  {r4('avg(is_late)', 'late_rate')}, {r4('avg(total_freight)', 'avg_freight')},
  {r4('avg(is_late) * 100', 'late_pct')}, {_sev('avg(is_late) * 100', 10.0, 7.0)} AS severity
FROM (SELECT {_qcut('o')} AS bucket_ord, {_qcut('l')} AS freight_bucket, is_late, total_freight
      FROM {_OF} o CROSS JOIN (SELECT quantile_cont(total_freight, [0.0, 0.2, 0.4, 0.6, 0.8, 1.0]) AS e
                               FROM {_OF} o2) q) b
WHERE bucket_ord IS NOT NULL GROUP BY 1, 2""")
def _late_by_freight(c: Ctx):
    """Order-grain freight quintiles: orders, late rate, mean freight."""
    return B.late_by_freight(B.order_freight(c.oi))


_STATE_SQL = "(SELECT nb.*, c.customer_state FROM nb JOIN src_customers c USING (customer_id))"


@register("delivery_estimate_by_state", f"""
SELECT customer_state, CAST(NULL AS VARCHAR) AS state_name,
  {r4('quantile_cont(estimated_days, 0.5)', 'median_estimate')},
  {r4('quantile_cont(delivery_days, 0.5)', 'median_actual')},
  {r4('quantile_cont(delivery_days, 0.75)', 'p75_actual')},
  {r4('quantile_cont(delivery_days, 0.9)', 'p90_actual')},
  CAST(count(order_id) AS BIGINT) AS total_orders,
  CAST(floor(quantile_cont(delivery_days, 0.75)) + 1 AS INTEGER) AS recommended_days,
  {r4('quantile_cont(estimated_days, 0.5) - quantile_cont(delivery_days, 0.5)', 'estimate_gap')}
FROM {_STATE_SQL} s WHERE customer_state IS NOT NULL GROUP BY customer_state""")
def _estimates(c: Ctx):
    """Per state: median estimate vs actual, P75/P90, recommended estimate.
    (Synthetic states are nation names, so the state-name lookup is null.)"""
    return B.delivery_estimate_by_state(c.oc)


# =================================================================== statistics
from lateline.operators import stats as ST, topk as TK  # noqa: E402

_IQR_LONG = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST({c} AS DOUBLE) AS value FROM nb" for c in ST.IQR_COLS)


@register("iqr_outliers", f"""
WITH l AS (SELECT * FROM ({_IQR_LONG}) x WHERE value >= 0),
f AS (SELECT "column", quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3
      FROM l GROUP BY "column")
SELECT "column", {r4('q1', 'q1')}, {r4('q3', 'q3')}, {r4('q3 - q1', 'iqr')},
  {r4('q1 - 1.5 * (q3 - q1)', 'lower')}, {r4('q3 + 1.5 * (q3 - q1)', 'upper')},
  CAST(count_if(value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)) AS BIGINT) AS n_outliers,
  {r4('avg(CAST(value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1) AS INTEGER)) * 100', 'outlier_pct')},
  {r4('max(value)', 'max')}, CAST(count(value) AS BIGINT) AS n
FROM l JOIN f USING ("column") GROUP BY "column", q1, q3""")
def _iqr(c: Ctx):
    """Q1, Q3, fences, outlier counts per stage/day column (non-negative values)."""
    return ST.iqr_outliers(c.nb)


_RULES_SQL = [("t1_approval_h", 700.0, "aps"), ("t3_shipping_h", 3000.0, "ds"), ("t2_processing_h", 2000.0, "cs")]


@register("extreme_rows", " UNION ALL ".join(f"""
SELECT order_id, customer_id, {TS_TXT.format(c='ps')} AS order_purchase_timestamp, is_late, delivery_days,
  '{s}' AS rule, CAST({thr} AS DOUBLE) AS threshold_h, {r4(s, 'hours')},
  strftime(CAST(make_timestamp({col} * 1000000) AS DATE), '%Y-%m-%d') AS event_date
FROM nb WHERE {s} > {thr}""" for s, thr, col in _RULES_SQL))
def _extreme(c: Ctx):
    """Orders beyond the approval, shipping and processing limits, with the inspected date."""
    return ST.rule_rows(c.nb, cols=["customer_id", "order_purchase_timestamp", "is_late", "delivery_days"])


_EXT = " UNION ALL ".join(
    f"SELECT '{s}' AS rule, {thr} AS threshold_h, order_id, "
    f"CAST(make_timestamp({col} * 1000000) AS DATE) AS event_date FROM nb WHERE {s} > {thr}"
    for s, thr, col in _RULES_SQL)


@register("outlier_decision_evidence", f"""
WITH e AS ({_EXT}),
r AS (SELECT rule, threshold_h, count(*) AS n_rows FROM e GROUP BY rule, threshold_h),
d AS (SELECT rule, count(*) AS distinct_dates, max(n_day) AS modal_date_rows
      FROM (SELECT rule, event_date, count(*) AS n_day FROM e GROUP BY rule, event_date) x GROUP BY rule),
s AS (SELECT rule, count(DISTINCT seller_id) AS distinct_sellers
      FROM e JOIN src_items USING (order_id) GROUP BY rule)
SELECT rule, {r4('threshold_h', 'threshold_h')}, CAST(n_rows AS BIGINT) AS n_rows,
  CAST(coalesce(distinct_sellers, 0) AS BIGINT) AS distinct_sellers,
  CAST(distinct_dates AS BIGINT) AS distinct_dates, CAST(modal_date_rows AS BIGINT) AS modal_date_rows,
  {r4('modal_date_rows * 100.0 / n_rows', 'modal_date_pct')}
FROM r LEFT JOIN d USING (rule) LEFT JOIN s USING (rule)""")
def _evidence(c: Ctx):
    """Per outlier rule: rows, sellers, distinct dates, share on the modal date."""
    return ST.outlier_decision_evidence(c.nb, c.t.items)


@register("outlier_dates", f"""
WITH e AS ({_EXT}),
n AS (SELECT rule, event_date, count(*) AS n FROM e GROUP BY rule, event_date)
SELECT rule, strftime(event_date, '%Y-%m-%d') AS event_date, CAST(n AS BIGINT) AS n
FROM n QUALIFY row_number() OVER (PARTITION BY rule ORDER BY n DESC, event_date NULLS FIRST) <= 10""")
def _outlier_dates(c: Ctx):
    """Per outlier rule, the top-10 dates of its timestamp."""
    return ST.outlier_dates(c.nb)


@register("outlier_unique_sellers", f"""
WITH e AS ({_EXT})
SELECT rule, CAST(count(DISTINCT seller_id) AS BIGINT) AS distinct_sellers, CAST(count(*) AS BIGINT) AS n_item_rows
FROM e JOIN src_items USING (order_id) GROUP BY rule""")
def _outlier_sellers(c: Ctx):
    """Per outlier rule, distinct sellers and item rows."""
    return ST.outlier_unique_sellers(c.nb, c.t.items)


_CORR_PAIRS = [(a, b) for i, a in enumerate(ST.CORR_COLS) for b in ST.CORR_COLS[i + 1:]]


@register("correlation_matrix", "SELECT col_a, col_b, round(r, 4) AS r FROM (" + " UNION ALL ".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)) AS r "
    f"FROM (SELECT nb.*, rv.review_score FROM nb LEFT JOIN src_reviews rv USING (order_id)) x"
    for a, b in _CORR_PAIRS) + ") m")
def _corr(c: Ctx):
    """55 pairwise Pearson correlations (delivered x reviews, left join)."""
    return ST.correlation_matrix(c.orr)


#: (name, column, upper limit: none, a value, or the column's own quantile)
_HISTS = [("ratio", "actual_vs_est_ratio", 3.0, None), ("delivery_days", "delivery_days", None, None),
          ("approval", "t1_approval_h", None, 0.95), ("processing", "t2_processing_h", None, 0.95),
          ("shipping", "t3_shipping_h", None, 0.95), ("approval_200h", "t1_approval_h", 200.0, None)]


def _hist_sql(name: str, col: str, cap, prob) -> str:
    top = (f"AND {col} <= {cap}" if cap is not None else
           f"AND {col} <= (SELECT quantile_cont(CAST({col} AS DOUBLE), {prob}) FROM nb)" if prob else "")
    return f"""
SELECT '{name}' AS chart, bin, round(lo + bin * ((hi - lo) / 40), 4) AS bin_lo, round(lo + (bin + 1) * ((hi - lo) / 40), 4) AS bin_hi,
  CAST(count(*) AS BIGINT) AS n
FROM (SELECT CAST(CASE WHEN hi = lo THEN 0 ELSE least(floor((v - lo) / ((hi - lo) / 40)), 39) END AS INTEGER) AS bin, lo, hi
      FROM (SELECT CAST({col} AS DOUBLE) AS v, min(CAST({col} AS DOUBLE)) OVER () AS lo, max(CAST({col} AS DOUBLE)) OVER () AS hi
            FROM nb WHERE {col} IS NOT NULL {top}) d) b
GROUP BY bin, lo, hi"""


@register("histogram", " UNION ALL ".join(f"SELECT * FROM ({_hist_sql(*h)}) x" for h in _HISTS))
def _hist(c: Ctx):
    """40 equal-width bins of the ratio up to 3, the delivery days, each stage
    up to its P95, and approval up to 200 h."""
    return ST.histograms(c.nb, _HISTS, 40)


def _five_sql(name: str, col: str, src: str) -> str:
    inside = "v >= q1 - 1.5 * (q3 - q1) AND v <= q3 + 1.5 * (q3 - q1)"
    return f"""
SELECT '{name}' AS chart, is_late, {r4('q1', 'q1')}, {r4('median', 'median')}, {r4('q3', 'q3')},
  {r4(f'min(CASE WHEN {inside} THEN v END)', 'whisker_low')}, {r4(f'max(CASE WHEN {inside} THEN v END)', 'whisker_high')},
  CAST(count_if(NOT ({inside})) AS BIGINT) AS n_outside, CAST(count(*) AS BIGINT) AS n
FROM (SELECT is_late, CAST({col} AS DOUBLE) AS v FROM {src}) d
JOIN (SELECT is_late, quantile_cont(CAST({col} AS DOUBLE), 0.25) AS q1, quantile_cont(CAST({col} AS DOUBLE), 0.5) AS median,
             quantile_cont(CAST({col} AS DOUBLE), 0.75) AS q3 FROM {src} GROUP BY is_late) q USING (is_late)
WHERE v IS NOT NULL GROUP BY is_late, q1, median, q3"""


@register("five_number_summary", f"""
SELECT * FROM ({_five_sql('review_score', 'review_score', _ORR + ' r')}) a
UNION ALL SELECT * FROM ({_five_sql('delivery_days', 'delivery_days', 'nb')}) b""")
def _five(c: Ctx):
    """Box-plot numbers of review score and of delivery days, late vs on time."""
    score = ST.five_number_summary(c.orr.where(F.col("review_score").isNotNull()), "review_score", by=["is_late"])
    days = ST.five_number_summary(c.nb, "delivery_days", by=["is_late"])
    return (score.select(F.lit("review_score").alias("chart"), "*")
            .unionByName(days.select(F.lit("delivery_days").alias("chart"), "*")))


def _chi2_sql(counts_sql: str) -> str:
    return f"""
WITH t AS ({counts_sql}),
z AS (SELECT *, CAST(a AS DOUBLE) + b + c + d AS n, CAST(a AS DOUBLE) + b AS r1, CAST(c AS DOUBLE) + d AS r2,
             CAST(a AS DOUBLE) + c AS c1, CAST(b AS DOUBLE) + d AS c2 FROM t),
y AS (SELECT *, CASE WHEN r1 * r2 * c1 * c2 > 0 THEN
        n * pow(greatest(abs(CAST(a AS DOUBLE) * d - CAST(b AS DOUBLE) * c) - n / 2, 0), 2) / (r1 * r2 * c1 * c2) END AS chi2
      FROM z),
x AS (SELECT *, sqrt(chi2 / 2) AS root FROM y),
w AS (SELECT *, {C.erfc_sql('root')} AS p FROM x)
SELECT CAST(a AS BIGINT) AS a, CAST(b AS BIGINT) AS b, CAST(c AS BIGINT) AS c, CAST(d AS BIGINT) AS d,
  round(chi2, 4) AS chi2, 1 AS dof, round(r1 * c1 / n, 4) AS exp_a, round(r1 * c2 / n, 4) AS exp_b,
  round(r2 * c1 / n, 4) AS exp_c, round(r2 * c2 / n, 4) AS exp_d,
  round(p, 4) AS p_value, CAST(p < 0.05 AS INTEGER) AS significant
FROM w"""


def _late_counts(src: str, g: str, x: str, y: str) -> str:
    return (f"SELECT count_if({g} = {x} AND is_late = 0) AS a, count_if({g} = {x} AND is_late = 1) AS b, "
            f"count_if({g} = {y} AND is_late = 0) AS c, count_if({g} = {y} AND is_late = 1) AS d FROM {src}")


@register("chi2_state_pair", _chi2_sql(_late_counts(_STATE_SQL + " s", "customer_state",
                                                    "'NATION_0'", "'NATION_1'")))
def _chi2_state(c: Ctx):
    """Yates chi-square, late vs on time, for two customer states."""
    return ST.chi2_state_pair(c.oc, "NATION_0", "NATION_1")


@register("chi2_month_pair", _chi2_sql(_late_counts("nb", "purchase_month", "3", "6")))
def _chi2_month(c: Ctx):
    """March vs June."""
    return ST.chi2_month_pair(c.nb, 3, 6)


@register("chi2_chronic_normal", _chi2_sql(f"""
SELECT sum(CASE WHEN late_rate > 0.12 THEN total_orders END) - floor(sum(CASE WHEN late_rate > 0.12 THEN total_orders * late_rate END)) AS a,
  floor(sum(CASE WHEN late_rate > 0.12 THEN total_orders * late_rate END)) AS b,
  sum(CASE WHEN late_rate <= 0.12 THEN total_orders END) - floor(sum(CASE WHEN late_rate <= 0.12 THEN total_orders * late_rate END)) AS c,
  floor(sum(CASE WHEN late_rate <= 0.12 THEN total_orders * late_rate END)) AS d
FROM (SELECT seller_id, count(DISTINCT order_id) AS total_orders, avg(is_late) AS late_rate
      FROM {_OI} oi GROUP BY seller_id) s WHERE total_orders >= 95"""))
def _chi2_chronic(c: Ctx):
    """Chronic vs normal active sellers (late counts rebuilt from rates)."""
    return ST.chi2_chronic_normal(B.seller_perf_items(c.oi), CFG)


@register("chi2_freight_pair", _chi2_sql(_late_counts(f"""(SELECT {_qcut('l')} AS freight_bucket, is_late
      FROM {_OF} o CROSS JOIN (SELECT quantile_cont(total_freight, [0.0, 0.2, 0.4, 0.6, 0.8, 1.0]) AS e
                               FROM {_OF} o2) q) b""", "freight_bucket", "'Sangat murah'", "'Sangat mahal'")))
def _chi2_freight(c: Ctx):
    """Cheapest vs dearest order-freight quintile."""
    return ST.chi2_freight_pair(B.freight_qcut(B.order_freight(c.oi)))


@register("sample_fixed")
def _sample(c: Ctx):
    """5,000 delivered orders chosen by a seeded hash (repeatable)."""
    return ST.sample_fixed(c.nb.select("order_id", "is_late", "delivery_days"), CFG.sample_n, CFG.seed)


# =================================================================== top-k
@register("worst_approvals", f"""
SELECT order_id, {TS_TXT.format(c='ps')} AS order_purchase_timestamp,
  {TS_TXT.format(c='aps')} AS order_approved_at, {r4('t1_approval_h', 't1_approval_h')}, is_late,
  {r4('round_even(t1_approval_h / 24.0, 1)', 't1_days')}
FROM nb WHERE t1_approval_h IS NOT NULL ORDER BY t1_approval_h DESC, order_id LIMIT 5""")
def _worst_approvals(c: Ctx):
    return TK.worst_approvals(c.nb)


_SELLER_TOP = f"""SELECT seller_id, substr(seller_id, 1, 8) || '...' AS seller_short, total_orders,
  late_pct, avg_t2 FROM ({_SELLER_ITEMS_SQL}) s WHERE total_orders >= 95"""


@register("worst_sellers", _SELLER_TOP + " ORDER BY late_pct DESC, seller_id LIMIT 10")
def _worst_sellers(c: Ctx):
    return TK.worst_sellers(B.seller_perf_items(c.oi), CFG)


@register("best_sellers", _SELLER_TOP + " AND total_orders >= 50 ORDER BY late_pct ASC, seller_id LIMIT 10")
def _best_sellers(c: Ctx):
    return TK.best_sellers(B.seller_perf_items(c.oi), CFG)


_CAT_ALL = _CAT_SQL.replace("HAVING count(DISTINCT order_id) >= 100", "")


@register("worst_categories", f"SELECT * FROM ({_CAT_ALL}) c ORDER BY late_pct DESC, category_en LIMIT 15")
def _worst_categories(c: Ctx):
    """Highest late rate categories (no minimum: synthetic categories are few)."""
    return TK.worst_categories(B.late_by_category(
        B.category_items(c.oi, c.t.products, c.t.cat_trans), CFG.with_(category_min_orders=0)))


@register("best_categories", f"SELECT * FROM ({_CAT_ALL}) c ORDER BY late_pct ASC, category_en LIMIT 15")
def _best_categories(c: Ctx):
    return TK.best_categories(B.late_by_category(
        B.category_items(c.oi, c.t.products, c.t.cat_trans), CFG.with_(category_min_orders=0)))


_STATES_FULL = f"""
SELECT customer_state, CAST(count(order_id) AS BIGINT) AS total_orders,
  CAST(sum(is_late) AS BIGINT) AS late_orders, {r4('avg(is_late)', 'late_rate')},
  {r4('avg(delivery_days)', 'avg_days')}, {r4('avg(t3_shipping_h)', 'avg_t3')},
  avg(is_late) * 100 AS late_pct_raw,
  CASE WHEN avg(is_late) * 100 >= 15 THEN 'red' WHEN avg(is_late) * 100 >= 8 THEN 'orange'
       ELSE 'green' END AS severity
FROM {_STATE_SQL} s WHERE customer_state IS NOT NULL GROUP BY customer_state"""


@register("top_bottom_states", f"""
SELECT customer_state, total_orders, late_orders, late_rate, avg_days, avg_t3,
  round(late_pct_raw, 4) AS late_pct, severity, position FROM (
  (SELECT *, 'top' AS position FROM ({_STATES_FULL}) s ORDER BY late_pct_raw DESC, customer_state LIMIT 5)
  UNION ALL
  (SELECT *, 'bottom' AS position FROM ({_STATES_FULL}) s ORDER BY late_pct_raw ASC, customer_state DESC LIMIT 5)) u""")
def _top_bottom(c: Ctx):
    """Five worst and five best states by late rate."""
    return TK.top_bottom_states(B.late_by_state(c.oc))


@register("state_days_ranking", f"""
SELECT customer_state, total_orders, late_orders, late_rate, avg_days, avg_t3,
  round(late_pct_raw, 4) AS late_pct, severity FROM ({_STATES_FULL}) s""")
def _state_days(c: Ctx):
    """States sorted by mean delivery days (descending)."""
    return B.state_days_ranking(B.late_by_state(c.oc))


# =================================================================== profiles
from lateline.operators import profile as PR  # noqa: E402

_SRC_COLS = {
    "orders": ["order_id", "customer_id", "order_status", "order_purchase_timestamp", "order_approved_at",
               "order_delivered_carrier_date", "order_delivered_customer_date", "order_estimated_delivery_date"],
    "items": ["order_id", "order_item_id", "product_id", "seller_id", "price", "freight_value"],
    "sellers": ["seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"],
    "customers": ["customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_city",
                  "customer_state"],
    "reviews": ["order_id", "review_score"],
    "products": ["product_id", "product_category_name", "product_weight_g", "product_length_cm",
                 "product_height_cm", "product_width_cm"],
    "cat_trans": ["product_category_name", "product_category_name_english"],
}
_ORDERS_TS = """(SELECT order_id, customer_id, order_status, ps AS order_purchase_timestamp,
  aps AS order_approved_at, cs AS order_delivered_carrier_date, ds AS order_delivered_customer_date,
  es AS order_estimated_delivery_date FROM src_orders)"""


def _src(t: str) -> str:
    return _ORDERS_TS if t == "orders" else f"src_{t}"


@register("table_profile", " UNION ALL ".join(
    f"""SELECT '{t}' AS "table", CAST(count(*) AS BIGINT) AS rows, {len(cs)} AS n_columns,
  CAST({' + '.join(f'count_if({c} IS NULL)' for c in cs)} AS BIGINT) AS null_total,
  round(({' + '.join(f'count_if({c} IS NULL)' for c in cs)}) * 100.0 / (count(*) * {len(cs)}), 4) AS null_pct,
  CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {_src(t)} d) x) AS BIGINT) AS duplicate_rows
FROM {_src(t)} s""" for t, cs in _SRC_COLS.items()))
def _table_profile(c: Ctx):
    """Rows, columns, nulls and duplicate rows of the seven sources."""
    return PR.table_profile(c.t.as_dict())


def _null_sql(t: str, cs: list[str]) -> str:
    return f"""
SELECT '{t}' AS "table", "column", nulls, round(nulls * 100.0 / n, 4) AS null_pct,
  CASE WHEN nulls * 100.0 / n >= 20 THEN 'red' WHEN nulls * 100.0 / n >= 5 THEN 'orange' ELSE 'green' END AS severity
FROM (SELECT count(*) AS n, {', '.join(f"CAST(count_if({c} IS NULL) AS BIGINT) AS {c}" for c in cs)}
      FROM {_src(t)} o) UNPIVOT (nulls FOR "column" IN ({', '.join(cs)})) WHERE nulls > 0"""


@register("null_profile", " UNION ALL ".join(f"SELECT * FROM ({_null_sql(t, cs)}) z" for t, cs in _SRC_COLS.items()))
def _null_profile(c: Ctx):
    """Columns with nulls of all seven sources, and their share."""
    out = None
    for name, df in c.t.as_dict().items():
        part = PR.null_profile(df, name)
        out = part if out is None else out.unionByName(part)
    return out


# =================================================================== risk model
from lateline.operators import risk as R  # noqa: E402

_MODELS: dict = {}


def _model(c: Ctx, kind: str):
    """Fitted pipelines are reused within a session (training is the cost)."""
    key = (_session_key(c.spark), c.sf_dir, kind)
    if key not in _MODELS:
        rows = c.risk_rows
        if kind == "boosted_all":
            _MODELS[key] = R.train_boosted(rows, CFG)
        else:
            train, _ = R.stratified_split(rows, CFG.test_fraction, CFG.seed)
            _MODELS[key] = (R.train_boosted(train, CFG) if kind == "boosted"
                            else R.train_forest(train, CFG))
    return _MODELS[key]


def _test_rows(c: Ctx):
    # staged: the split's cuts are found once, whatever reads the rows
    return staged(R.stratified_split(c.risk_rows, CFG.test_fraction, CFG.seed)[1], "risk-test")


@register("fact_late_risk")
def _fact_late_risk(c: Ctx):
    """Boosted model fitted on all feature rows, scoring the same rows."""
    return R.fact_late_risk(c.risk_rows, CFG, _model(c, "boosted_all"))


@register("risk_distribution")
def _risk_dist(c: Ctx):
    return R.risk_distribution(R.fact_late_risk(c.risk_rows, CFG, _model(c, "boosted_all")))


@register("stratified_split", f"""
WITH f AS (SELECT DISTINCT * FROM (SELECT customer_state, seller_state, purchase_month, purchase_dayofweek,
             purchase_hour, freight_bucket, seller_cohort, order_id, is_late FROM fact) x
           WHERE customer_state IS NOT NULL AND seller_state IS NOT NULL AND freight_bucket IS NOT NULL
             AND seller_cohort IS NOT NULL)
SELECT CAST(sum(n) AS BIGINT) AS n, split FROM (
  SELECT is_late, count(*) AS n,
    'train' AS split FROM (SELECT is_late, row_number() OVER (PARTITION BY is_late ORDER BY order_id) AS rn,
       count(*) OVER (PARTITION BY is_late) AS cnt FROM f) z
  WHERE rn <= floor((cnt - 1) * 0.8) + 1 GROUP BY is_late
  UNION ALL
  SELECT is_late, count(*) - (floor((count(*) - 1) * 0.8) + 1), 'test' FROM f GROUP BY is_late) s
GROUP BY split""")
def _split(c: Ctx):
    """Sizes of the stratified 80/20 split (per-class exact proportions)."""
    tr, te = R.stratified_split(c.risk_rows.distinct(), CFG.test_fraction, CFG.seed)
    return R.split_report(tr, te).select(F.col("n").cast("long").alias("n"), "split")


@register("model_comparison")
def _model_comparison(c: Ctx):
    """Hold-out AUC, recall, precision and counts of both models."""
    return R.model_comparison(_model(c, "boosted"), _model(c, "forest"), _test_rows(c))


@register("roc_auc")
def _roc_auc(c: Ctx):
    return R.roc_auc_exact(R.score_risk(_model(c, "boosted"), _test_rows(c)))


@register("classification_report")
def _class_report(c: Ctx):
    return R.classification_report(R.score_risk(_model(c, "boosted"), _test_rows(c)))


@register("confusion_matrix")
def _confusion(c: Ctx):
    return R.confusion_matrix(R.score_risk(_model(c, "boosted"), _test_rows(c)))


@register("feature_importance")
def _importance(c: Ctx):
    return R.feature_importance(_model(c, "boosted"), "boosted").unionByName(
        R.feature_importance(_model(c, "forest"), "forest"))


@register("top_features")
def _top_features(c: Ctx):
    return R.top_features(R.feature_importance(_model(c, "boosted"), "boosted"))


# The reports of a scored table on a score that both engines can compute: a rule of calendar features.
_RULE = """(SELECT *, CAST(late_probability >= 0.5 AS INTEGER) AS late_prediction,
    CASE WHEN late_probability > 0 AND late_probability <= 0.3 THEN 'Low Risk' WHEN late_probability > 0.3 AND late_probability <= 0.6 THEN 'Medium Risk'
         WHEN late_probability > 0.6 AND late_probability <= 1 THEN 'High Risk' END AS risk_level
  FROM (SELECT order_id, is_late, (purchase_month * 37 + purchase_hour * 11 + purchase_dayofweek * 5) % 101 / 100.0 AS late_probability
        FROM fact WHERE customer_state IS NOT NULL AND seller_state IS NOT NULL AND freight_bucket IS NOT NULL AND seller_cohort IS NOT NULL) f)"""


def _rule_scored(c: Ctx) -> DataFrame:
    rows = c.risk_rows
    p = (F.col("purchase_month") * 37 + F.col("purchase_hour") * 11 + F.col("purchase_dayofweek") * 5) % 101 / F.lit(100.0)
    return (rows.withColumn("late_probability", p).withColumn("late_prediction", (F.col("late_probability") >= 0.5).cast("int"))
            .withColumn("risk_level", R.risk_level("late_probability")))


@register("rule_roc_auc", f"""
WITH n AS (SELECT late_probability AS s, count_if(is_late = 1) AS pos, count_if(is_late = 0) AS neg FROM {_RULE} r GROUP BY 1),
b AS (SELECT *, coalesce(sum(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM n)
SELECT round(sum(pos * (before + 0.5 * neg)) / (sum(pos) * sum(neg)), 4) AS roc_auc, CAST(sum(pos) AS BIGINT) AS positives,
  CAST(sum(neg) AS BIGINT) AS negatives FROM b""")
def _rule_auc(c: Ctx):
    """Exact ROC-AUC of the rule's score."""
    return R.roc_auc_exact(_rule_scored(c))


@register("rule_confusion_matrix", f"""
SELECT CAST(is_late AS INTEGER) AS actual, late_prediction AS predicted, count(*) AS n FROM {_RULE} r GROUP BY 1, 2""")
def _rule_confusion(c: Ctx):
    return R.confusion_matrix(_rule_scored(c))


@register("rule_classification_report", f"""
WITH c AS (SELECT count_if(is_late = 1 AND late_prediction = 1) * 1.0 AS tp, count_if(is_late = 0 AND late_prediction = 1) * 1.0 AS fp,
             count_if(is_late = 1 AND late_prediction = 0) * 1.0 AS fn, count_if(is_late = 0 AND late_prediction = 0) * 1.0 AS tn FROM {_RULE} r),
k AS (SELECT '0' AS label, tn AS hit, fn AS extra, fp AS missed FROM c UNION ALL SELECT '1', tp, fp, fn FROM c),
p AS (SELECT label, CASE WHEN hit + extra > 0 THEN hit / (hit + extra) ELSE 0 END AS pr,
             CASE WHEN hit + missed > 0 THEN hit / (hit + missed) ELSE 0 END AS re, hit + missed AS s FROM k),
f AS (SELECT *, CASE WHEN pr + re > 0 THEN 2 * pr * re / (pr + re) ELSE 0 END AS f1 FROM p)
SELECT label, round(pr, 4) AS "precision", round(re, 4) AS recall, round(f1, 4) AS f1, CAST(s AS BIGINT) AS support FROM f
UNION ALL SELECT 'macro avg', round(avg(pr), 4), round(avg(re), 4), round(avg(f1), 4), CAST(sum(s) AS BIGINT) FROM f
UNION ALL SELECT 'weighted avg', round(sum(pr * s) / sum(s), 4), round(sum(re * s) / sum(s), 4), round(sum(f1 * s) / sum(s), 4), CAST(sum(s) AS BIGINT) FROM f""")
def _rule_report(c: Ctx):
    return R.classification_report(_rule_scored(c))


@register("rule_risk_distribution", f"""
SELECT risk_level, count(*) AS n, round(count(*) * 1.0 / sum(count(*)) OVER (), 4) AS share FROM {_RULE} r GROUP BY risk_level""")
def _rule_distribution(c: Ctx):
    return R.risk_distribution(_rule_scored(c))


@register("rule_chi2_risk_pair", _chi2_sql(_late_counts(_RULE + " r", "risk_level", "'High Risk'", "'Low Risk'")))
def _rule_chi2(c: Ctx):
    """High vs Low risk by the rule's score."""
    return ST.chi2_risk_pair(_rule_scored(c))


@register("chi2_risk_pair")
def _chi2_risk(c: Ctx):
    """High vs Low risk on all rows, scored by the model of the training split."""
    return ST.chi2_risk_pair(R.score_risk(_model(c, "boosted"), c.risk_rows))


@register("attribution")
def _attribution(c: Ctx):
    """Exact Shapley contributions of all rows to the margin, against all rows."""
    return R.attribution(_model(c, "boosted"), c.risk_rows)


@register("attribution_row")
def _attribution_row(c: Ctx):
    """Contributions and decoded values of one order (smallest id), against
    the baseline of all rows."""
    rows = c.risk_rows
    pick = rows.agg(F.min("order_id").alias("order_id"))
    contrib = R.attribution(_model(c, "boosted"), rows.join(pick, "order_id"), rows)
    return R.attribution_row(contrib, rows, pick)


@register("attribution_global")
def _attribution_global(c: Ctx):
    return R.attribution_global(R.attribution(_model(c, "boosted"), c.risk_rows))


# =================================================================== quality
from lateline.operators import dash as DS, impact as IM, quality as Q  # noqa: E402


def _published(c: Ctx, with_risk: bool = True) -> dict:
    f = c.fact_table
    out = {"fact_deliveries": f, "dim_sellers": FT.dim_sellers(c.t.sellers),
           "dim_customers": FT.dim_customers(c.t.customers),
           "dim_products": FT.dim_products(c.t.products, c.t.cat_trans),
           "agg_seller_performance": marts.agg_seller_performance(f, CFG),
           "agg_regional_stats": marts.agg_regional_stats(f),
           "agg_monthly_trend": marts.agg_monthly_trend(f),
           "agg_cohort_performance": marts.agg_cohort_performance(f),
           "kpi_summary": kpi.kpi_summary(f, CFG)}
    if with_risk:
        out["fact_late_risk"] = R.fact_late_risk(c.risk_rows, CFG, _model(c, "boosted_all"))
    return out


@register("quality_expectations", f"""
SELECT * FROM (
  SELECT 'expect_not_null_order_id' AS "check", 'fact_deliveries' AS "table", 'order_id' AS "column",
    'not_null' AS kind, CAST(count_if(order_id IS NULL) AS DOUBLE) AS observed, '0 nulls' AS expected,
    CASE WHEN count_if(order_id IS NULL) = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM fact
  UNION ALL SELECT 'expect_in_set_is_late', 'fact_deliveries', 'is_late', 'in_set',
    CAST(count_if(is_late IS NOT NULL AND is_late NOT IN (0, 1)) AS DOUBLE), 'in {{0,1}}',
    CASE WHEN count_if(is_late IS NOT NULL AND is_late NOT IN (0, 1)) = 0 THEN 'PASS' ELSE 'FAIL' END FROM fact
  UNION ALL SELECT 'expect_mean_between_is_late', 'fact_deliveries', 'is_late', 'mean_between',
    round(avg(is_late), 4), '[0.06, 0.12]',
    CASE WHEN avg(is_late) BETWEEN 0.06 AND 0.12 THEN 'PASS' ELSE 'FAIL' END FROM fact
  UNION ALL SELECT 'expect_between_purchase_month', 'fact_deliveries', 'purchase_month', 'between',
    CAST(count_if(purchase_month IS NOT NULL AND NOT purchase_month BETWEEN 1 AND 12) AS DOUBLE), '[1, 12]',
    CASE WHEN count_if(purchase_month IS NOT NULL AND NOT purchase_month BETWEEN 1 AND 12) = 0 THEN 'PASS' ELSE 'FAIL' END FROM fact
  UNION ALL SELECT 'expect_between_mostly_t1_approval_h', 'fact_deliveries', 't1_approval_h', 'between_mostly',
    round(coalesce(avg(CASE WHEN t1_approval_h IS NOT NULL THEN CAST(t1_approval_h BETWEEN 0 AND 700 AS INTEGER) END), 1.0), 4),
    '[0, 700.0] mostly 0.999',
    CASE WHEN coalesce(avg(CASE WHEN t1_approval_h IS NOT NULL THEN CAST(t1_approval_h BETWEEN 0 AND 700 AS INTEGER) END), 1.0) >= 0.999 THEN 'PASS' ELSE 'FAIL' END FROM fact
  UNION ALL SELECT 'expect_between_mostly_t3_shipping_h', 'fact_deliveries', 't3_shipping_h', 'between_mostly',
    round(coalesce(avg(CASE WHEN t3_shipping_h IS NOT NULL THEN CAST(t3_shipping_h BETWEEN 0 AND 3000 AS INTEGER) END), 1.0), 4),
    '[0, 3000.0] mostly 0.999',
    CASE WHEN coalesce(avg(CASE WHEN t3_shipping_h IS NOT NULL THEN CAST(t3_shipping_h BETWEEN 0 AND 3000 AS INTEGER) END), 1.0) >= 0.999 THEN 'PASS' ELSE 'FAIL' END FROM fact
  UNION ALL SELECT 'expect_row_count_between', 'fact_deliveries', '*', 'row_count', CAST(count(*) AS DOUBLE),
    '[90000, 100000]', CASE WHEN count(*) BETWEEN 90000 AND 100000 THEN 'PASS' ELSE 'FAIL' END FROM fact
  UNION ALL SELECT 'expect_not_null_seller_cohort', 'fact_deliveries', 'seller_cohort', 'not_null',
    CAST(count_if(seller_cohort IS NULL) AS DOUBLE), '0 nulls',
    CASE WHEN count_if(seller_cohort IS NULL) = 0 THEN 'PASS' ELSE 'FAIL' END FROM fact
  UNION ALL SELECT 'expect_in_set_freight_bucket', 'fact_deliveries', 'freight_bucket', 'in_set',
    CAST(count_if(freight_bucket IS NOT NULL AND freight_bucket NOT IN ('Sangat murah', 'Murah', 'Sedang', 'Mahal', 'Sangat mahal')) AS DOUBLE),
    '5 labels', CASE WHEN count_if(freight_bucket IS NOT NULL AND freight_bucket NOT IN ('Sangat murah', 'Murah', 'Sedang', 'Mahal', 'Sangat mahal')) = 0 THEN 'PASS' ELSE 'FAIL' END FROM fact
) e""")
def _expectations(c: Ctx):
    """The nine expectations on the fact (nulls skipped in set/range tests)."""
    return Q.run_checks({"fact_deliveries": c.facts(*Q.EXPECTED_COLS)}, Q.expectations(CFG))


@register("quality_hard_checks")
def _hard_checks(c: Ctx):
    """The hard checks over the ten published tables (one scan per table).
    Reference row-count bounds belong to its dataset, so several FAIL here."""
    return Q.run_checks(_published(c), Q.hard_checks(CFG))


def _st(cond: str) -> str:
    return f"CASE WHEN coalesce({cond}, false) THEN 'PASS' ELSE 'FAIL' END"


_FACT_CHECKS = [
    "count(*) > 90000", "count(*) < 97500",
    "coalesce(max(t1_approval_h), 0) <= 700", "coalesce(max(t3_shipping_h), 0) <= 3000",
    *[f"count_if({c} IS NULL) = 0" for c in ["order_id", "is_late", "customer_state", "purchase_month",
                                             "seller_cohort", "freight_bucket"]],
    *[f"count_if({c} < 0) = 0" for c in ["t1_approval_h", "t2_processing_h", "t3_shipping_h"]],
    "count_if(NOT coalesce(is_late IN (0, 1), false)) = 0",
    "avg(is_late) BETWEEN 0.06 AND 0.12",
    "count_if(NOT coalesce(purchase_month BETWEEN 1 AND 12, false)) = 0",
]
_KPI_SQL_ROWS = f"({_KPI_SQL})"
_AGG_S = "(SELECT * FROM (" + _SELLER_ALL_SQL + ") a WHERE total_orders >= 95)"


def _check_sql() -> str:
    """One row (check, status) per hard check, but for the risk table's."""
    names = ["dq_rows_fact_min", "dq_rows_fact_max", "dq_t1_max", "dq_t3_max",
             *[f"dq_not_null_{c}" for c in ["order_id", "is_late", "customer_state", "purchase_month", "seller_cohort", "freight_bucket"]],
             *[f"dq_non_negative_{c}" for c in ["t1_approval_h", "t2_processing_h", "t3_shipping_h"]],
             "dq_is_late_domain", "dq_late_rate_range", "dq_month_range"]
    rest = [("dq_rows_sellers", "count(*) > 3000", "(SELECT DISTINCT * FROM src_sellers)"),
            ("dq_rows_customers", "count(*) > 90000", "(SELECT DISTINCT * FROM src_customers)"),
            ("dq_rows_products", "count(*) > 30000", "dim_products"),
            ("dq_chronic_rule", "count_if(is_chronic = 1 AND total_orders < 95) = 0", _AGG_S),
            ("dq_agg_seller_nonempty", "count(*) > 0", _AGG_S),
            ("dq_agg_regional_nonempty", "count(*) > 0", "(SELECT DISTINCT customer_state FROM fact WHERE customer_state IS NOT NULL)"),
            ("dq_monthly_min", "count(*) >= 12", "(SELECT DISTINCT strftime(make_timestamp(ps * 1000000), '%Y-%m') FROM fact)"),
            ("dq_agg_cohort_nonempty", "count(*) > 0", "(SELECT DISTINCT seller_cohort FROM fact WHERE seller_cohort IS NOT NULL)"),
            ("dq_kpi_rows", "count(*) = 5", _KPI_SQL_ROWS)]
    rows = [(n, _st(c), "fact") for n, c in zip(names, _FACT_CHECKS, strict=True)] + [(n, _st(c), t) for n, c, t in rest]
    ontime = _st("max(CASE WHEN kpi_name = 'On-Time Delivery Rate' THEN actual_value END) BETWEEN 80 AND 100")
    rows.append(("dq_kpi_ontime_range", f"CASE WHEN count(*) <> 5 THEN 'SKIP' ELSE {ontime} END", _KPI_SQL_ROWS))
    return " UNION ALL ".join(f"""SELECT '{n}' AS "check", {c} AS status FROM {t} t{i}""" for i, (n, c, t) in enumerate(rows))


def _hard_results(c: Ctx) -> DataFrame:
    return Q.run_checks(_published(c, with_risk=False), [k for k in Q.hard_checks(CFG) if k.table != "fact_late_risk"])


@register("quality_checks", _check_sql())
def _quality_checks(c: Ctx):
    """Every hard check but the risk table's, with its status."""
    return _hard_results(c).select("check", "status")


@register("quality_summary", f"""
SELECT CAST(count(*) AS BIGINT) AS total, CAST(count_if(status = 'PASS') AS BIGINT) AS passed,
  CAST(count_if(status = 'FAIL') AS BIGINT) AS failed, CAST(count_if(status = 'SKIP') AS BIGINT) AS skipped
FROM ({_check_sql()}) st""")
def _quality_summary(c: Ctx):
    return Q.summary(_hard_results(c))


# =================================================================== impact
_NB_OI_SELLERS = f"""(SELECT seller_id, count(DISTINCT order_id) AS total_orders, avg(is_late) AS late_rate,
  sum(CAST(price AS DECIMAL(18,2))) AS total_revenue FROM {_OI} oi GROUP BY seller_id)"""
_SAVED = """(SELECT count(*) AS total_orders, avg(is_late) AS late_rate_actual,
  CAST(floor(count(*) * avg(is_late)) AS BIGINT) AS late_orders_actual,
  CAST(floor(count(*) * 0.05) AS BIGINT) AS late_orders_target FROM nb)"""
_AOV = f"""(SELECT avg(CAST(v AS DOUBLE)) AS avg_order_value FROM
  (SELECT order_id, sum(CAST(price AS DECIMAL(18,2))) AS v FROM {_OI} oi GROUP BY order_id) x)"""


@register("impact_orders_saved", f"""
SELECT CAST(total_orders AS BIGINT) AS total_orders, round(late_rate_actual, 4) AS late_rate_actual,
  0.05 AS late_rate_target, late_orders_actual, late_orders_target,
  late_orders_actual - late_orders_target AS orders_saved FROM {_SAVED} s""")
def _impact_saved(c: Ctx):
    return IM.impact_orders_saved(c.nb, CFG)


@register("avg_order_value", f"SELECT round(avg_order_value, 4) AS avg_order_value FROM {_AOV} a")
def _aov(c: Ctx):
    return IM.avg_order_value(c.oi)


@register("impact_revenue_at_risk", f"""
SELECT round(avg_order_value, 4) AS avg_order_value, round(late_orders_actual * avg_order_value, 4) AS revenue_at_risk,
  round((late_orders_actual - late_orders_target) * avg_order_value, 4) AS revenue_saved
FROM {_SAVED} s CROSS JOIN {_AOV} a""")
def _impact_revenue(c: Ctx):
    saved = IM.impact_orders_saved(c.nb, CFG)
    return IM.impact_revenue_at_risk(saved, IM.avg_order_value(c.oi))


@register("impact_review_score", f"""
WITH sc AS (SELECT avg(CASE WHEN is_late = 0 THEN review_score END) AS score_on_time,
                   avg(CASE WHEN is_late = 1 THEN review_score END) AS score_late FROM {_ORR} r)
SELECT round(score_on_time, 4) AS score_on_time, round(score_late, 4) AS score_late,
  round(((total_orders - late_orders_actual) * score_on_time + late_orders_actual * score_late) / total_orders, 4) AS score_before,
  round(((total_orders - late_orders_target) * score_on_time + late_orders_target * score_late) / total_orders, 4) AS score_after,
  round(((total_orders - late_orders_target) * score_on_time + late_orders_target * score_late) / total_orders
      - ((total_orders - late_orders_actual) * score_on_time + late_orders_actual * score_late) / total_orders, 4) AS score_gain
FROM {_SAVED} s CROSS JOIN sc""")
def _impact_review(c: Ctx):
    saved = IM.impact_orders_saved(c.nb, CFG)
    return IM.impact_review_score(saved, IM.review_score_means(c.orr))


@register("impact_chronic_sellers", f"""
SELECT CAST(count(*) AS BIGINT) AS chronic_sellers,
  CAST(coalesce(floor(sum(total_orders) * avg(late_rate)), 0) AS BIGINT) AS chronic_late_orders,
  round(coalesce(CAST(sum(total_revenue) AS DOUBLE) * avg(late_rate), 0.0), 4) AS chronic_revenue_at_risk
FROM {_NB_OI_SELLERS} s WHERE total_orders >= 95 AND late_rate > 0.12""")
def _impact_chronic(c: Ctx):
    return IM.impact_chronic_sellers(B.seller_perf_items(c.oi), CFG)


@register("business_impact", f"""
WITH sc AS (SELECT avg(CASE WHEN is_late = 0 THEN review_score END) AS score_on_time,
                   avg(CASE WHEN is_late = 1 THEN review_score END) AS score_late FROM {_ORR} r),
sv AS (SELECT * FROM {_SAVED} s),
ch AS (SELECT count(*) AS chronic_sellers,
         CAST(coalesce(floor(sum(total_orders) * avg(late_rate)), 0) AS BIGINT) AS chronic_late_orders,
         coalesce(CAST(sum(total_revenue) AS DOUBLE) * avg(late_rate), 0.0) AS chronic_revenue_at_risk
       FROM {_NB_OI_SELLERS} s WHERE total_orders >= 95 AND late_rate > 0.12)
SELECT CAST(total_orders AS BIGINT) AS total_orders, round(late_rate_actual, 4) AS late_rate_actual,
  0.05 AS late_rate_target, late_orders_actual, late_orders_target,
  late_orders_actual - late_orders_target AS orders_saved,
  round(score_on_time, 4) AS score_on_time, round(score_late, 4) AS score_late,
  round(((total_orders - late_orders_actual) * score_on_time + late_orders_actual * score_late) / total_orders, 4) AS score_before,
  round(((total_orders - late_orders_target) * score_on_time + late_orders_target * score_late) / total_orders, 4) AS score_after,
  round(((total_orders - late_orders_target) * score_on_time + late_orders_target * score_late) / total_orders
      - ((total_orders - late_orders_actual) * score_on_time + late_orders_actual * score_late) / total_orders, 4) AS score_gain,
  round(avg_order_value, 4) AS avg_order_value, round(late_orders_actual * avg_order_value, 4) AS revenue_at_risk,
  round((late_orders_actual - late_orders_target) * avg_order_value, 4) AS revenue_saved,
  CAST(chronic_sellers AS BIGINT) AS chronic_sellers, chronic_late_orders,
  round(chronic_revenue_at_risk, 4) AS chronic_revenue_at_risk
FROM sv CROSS JOIN sc CROSS JOIN {_AOV} a CROSS JOIN ch""")
def _business_impact(c: Ctx):
    """Every impact figure in one row."""
    return IM.business_impact(c.nb, c.t.items, c.t.reviews, CFG)


@register("kpi_sla_in_range", f"""
SELECT {r4('avg(actual_vs_est_ratio)', 'mean_ratio')},
  {r4('avg(CAST(actual_vs_est_ratio BETWEEN 0.8 AND 1.0 AS INTEGER)) * 100', 'in_range_pct')},
  CASE WHEN avg(CAST(actual_vs_est_ratio BETWEEN 0.8 AND 1.0 AS INTEGER)) * 100 >= 50 THEN '✅' ELSE '❌' END AS status
FROM fact WHERE actual_vs_est_ratio IS NOT NULL""")
def _kpi_sla_range(c: Ctx):
    """SLA variant: share of ratios in [0.8, 1.0] (pipeline fact)."""
    return kpi.kpi_sla_in_range(c.facts("actual_vs_est_ratio"), CFG)


@register("kpi_seller_strict", f"""
SELECT {r4('avg(CASE WHEN total_orders >= 95 THEN late_rate END) * 100', 'avg_seller_late_pct')},
  CAST(count_if(total_orders >= 95 AND late_rate > 0.12) AS BIGINT) AS chronic_active,
  CAST(count_if(total_orders < 95 AND late_rate = 1.0) AS BIGINT) AS new_problem,
  CASE WHEN avg(CASE WHEN total_orders >= 95 THEN late_rate END) * 100 <= 5
        AND count_if(total_orders >= 95 AND late_rate > 0.12) = 0 THEN '✅' ELSE '❌' END AS status
FROM {_NB_OI_SELLERS} s""")
def _kpi_seller_strict(c: Ctx):
    """Seller variant: mean <= 5 % and no chronic active seller (item grain)."""
    return kpi.kpi_seller_strict(B.seller_perf_items(c.oi), CFG)


@register("kpi_notebook", f"""
SELECT {r4('avg(1 - is_late) * 100', 'on_time_pct')},
  {r4('avg(coalesce(CAST(days_late > 3 AS INTEGER), 0)) * 100', 'breach_pct')},
  {r4('avg(CASE WHEN t2_processing_h >= 0 THEN CAST(t2_processing_h <= 48 AS INTEGER) END) * 100', 'processing_pct')}
FROM nb""")
def _kpi_notebook(c: Ctx):
    """On-time, breach, processing on the unfiltered, unclipped population."""
    return kpi.kpi_notebook(c.nb, CFG)


@register("sla_whatif", f"""
WITH s AS (SELECT customer_state, CAST(floor(quantile_cont(delivery_days, 0.75)) + 1 AS INTEGER) AS rec
           FROM {_STATE_SQL} x WHERE customer_state IS NOT NULL GROUP BY customer_state)
SELECT {r4('avg(actual_vs_est_ratio)', 'current_ratio')}, {r4('avg(delivery_days / nullif(rec, 0))', 'whatif_ratio')}
FROM {_STATE_SQL} o JOIN s USING (customer_state)""")
def _sla_whatif(c: Ctx):
    """Mean ratio if each state's estimate were its P75-based recommendation."""
    return IM.sla_whatif(c.oc)


# =================================================================== dashboard
_SELLER_CLASS = f"""(SELECT seller_id, CASE WHEN is_chronic = 1 THEN 'chronic' WHEN total_orders >= 95 THEN 'normal'
  WHEN is_new_problem = 1 THEN 'new_problem' ELSE 'other' END AS seller_class FROM ({_SELLER_ALL_SQL}) a)"""


@register("dash_headline", f"""
WITH v AS (SELECT avg(1 - is_late) * 100 AS on_time, avg(CAST(coalesce(days_late, 0) > 3 AS INTEGER)) * 100 AS breach,
             avg(actual_vs_est_ratio) AS sla, avg(CAST(t2_processing_h <= 48 AS INTEGER)) * 100 AS processing,
             CAST(sum(is_late) AS BIGINT) AS late_orders,
             CAST(sum(CASE WHEN is_late = 1 THEN CAST(price AS DECIMAL(18,2)) END) AS DOUBLE) AS late_revenue FROM fact),
s AS (SELECT avg(late_rate) * 100 AS seller_late FROM (SELECT seller_id, count(DISTINCT order_id) AS n,
        avg(is_late) AS late_rate FROM fact WHERE seller_id IS NOT NULL GROUP BY seller_id) WHERE n >= 95),
ch AS (SELECT CAST(sum(is_chronic) AS BIGINT) AS chronic_sellers FROM ({_SELLER_ALL_SQL}) a)
SELECT round(on_time, 4) AS on_time, round(breach, 4) AS breach, round(sla, 4) AS sla,
  round(processing, 4) AS processing, round(seller_late, 4) AS seller_late, late_orders,
  round(late_revenue, 4) AS late_revenue, chronic_sellers FROM v CROSS JOIN s CROSS JOIN ch""")
def _dash_headline(c: Ctx):
    """KPI actuals, late orders, late revenue, chronic seller count."""
    return DS.dash_headline(c.facts(*kpi.KPI_COLS, "price", reuse=True), CFG)


@register("dash_chronic_list", "SELECT * FROM (" + _SELLER_ALL_SQL + ") a WHERE is_chronic = 1")
def _dash_chronic(c: Ctx):
    return DS.dash_chronic_list(c.facts(*marts.SELLER_COLS), CFG)


@register("dash_seller_categories", f"""
SELECT seller_class, CAST(count(*) AS BIGINT) AS n_sellers FROM {_SELLER_CLASS} s GROUP BY seller_class""")
def _dash_categories(c: Ctx):
    return DS.dash_seller_categories(c.facts(*marts.RATE_COLS), CFG)


@register("dash_seller_class_by_state", f"""
SELECT seller_class, customer_state, CAST(count(*) AS BIGINT) AS n_rows, {r4('avg(is_late)', 'late_rate')}
FROM fact JOIN {_SELLER_CLASS} s USING (seller_id) WHERE customer_state IS NOT NULL
GROUP BY seller_class, customer_state""")
def _dash_class_state(c: Ctx):
    return DS.dash_seller_class_by_state(c.facts(*marts.RATE_COLS, "customer_state", reuse=True), CFG)


@register("dash_freight", f"""
SELECT freight_bucket, CAST(count(*) AS BIGINT) AS n_rows, {r4('avg(is_late)', 'late_rate')}
FROM fact WHERE freight_bucket IS NOT NULL GROUP BY freight_bucket""")
def _dash_freight(c: Ctx):
    return DS.dash_freight(c.facts("is_late", "freight_bucket"))


@register("dash_category_revenue_at_risk", """
SELECT product_category_name_en,
  round(CAST(coalesce(sum(CASE WHEN is_late = 1 THEN CAST(price AS DECIMAL(18,2)) END), 0) AS DOUBLE), 4) AS late_revenue,
  CAST(count_if(is_late = 1) AS BIGINT) AS late_rows
FROM fact GROUP BY product_category_name_en""")
def _dash_cat_rev(c: Ctx):
    return DS.dash_category_revenue_at_risk(c.facts("is_late", "price", "product_category_name_en"))


@register("dash_reviews", f"""
SELECT is_late, {r4('avg(review_score)', 'mean_score')}, CAST(count(*) AS BIGINT) AS n_rows
FROM fact GROUP BY is_late""")
def _dash_reviews(c: Ctx):
    return DS.dash_reviews(c.facts("is_late", "review_score"))


# =================================================================== enriched rows, filters, joins
_ENR_COLS = ["order_id", "customer_id", "t1_approval_h", "t2_processing_h", "t3_shipping_h",
             "delivery_days", "estimated_days", "days_late", "is_late", "actual_vs_est_ratio",
             "purchase_month", "purchase_dayofweek", "purchase_hour"]


def _enr_sql(src: str) -> str:
    return f"""
SELECT order_id, customer_id, {TS_TXT.format(c='ps')} AS order_purchase_timestamp,
  {r4('t1_approval_h', 't1_approval_h')}, {r4('t2_processing_h', 't2_processing_h')},
  {r4('t3_shipping_h', 't3_shipping_h')}, CAST(delivery_days AS DOUBLE) AS delivery_days, estimated_days,
  CAST(days_late AS DOUBLE) AS days_late, is_late,
  {r4('actual_vs_est_ratio', 'actual_vs_est_ratio')}, purchase_month, purchase_dayofweek, purchase_hour
FROM {src}"""


def _nullable_ints_as_double(df, cols=("delivery_days", "days_late", "review_score")):
    # integer columns that hold nulls are presented as DOUBLE on both sides, so
    # pandas (float64 + NaN) and nullable-integer conversions compare alike
    return df.withColumns({c: F.col(c).cast("double") for c in cols if c in df.columns})


@register("enrich_orders", _enr_sql("nb"))
def _enrich(c: Ctx):
    """Every derived column of delivered orders, raw (notebook population)."""
    return _nullable_ints_as_double(c.nb.select(*_ENR_COLS[:2], "order_purchase_timestamp", *_ENR_COLS[2:]))


@register("kept_orders", _enr_sql("kept"))
def _kept_orders(c: Ctx):
    """Delivered, clipped, outlier-filtered orders (population of the marts)."""
    return _nullable_ints_as_double(c.kept.select(*_ENR_COLS[:2], "order_purchase_timestamp", *_ENR_COLS[2:]))


@register("split_late", f"""
SELECT CAST(count_if(is_late = 1) AS BIGINT) AS late_orders, CAST(count_if(is_late = 0) AS BIGINT) AS on_time_orders,
  {r4('avg(CASE WHEN is_late = 1 THEN delivery_days END)', 'late_mean_days')},
  {r4('avg(CASE WHEN is_late = 0 THEN delivery_days END)', 'on_time_mean_days')}
FROM nb""")
def _split_late(c: Ctx):
    return B.split_late(c.nb)


@register("seller_segments", f"""
SELECT seller_id, total_orders, late_rate,
  CAST(total_orders >= 95 AS INTEGER) AS is_active,
  CAST(total_orders >= 95 AND late_rate > 0.12 AS INTEGER) AS is_chronic,
  CAST(total_orders >= 95 AND late_rate <= 0.12 AS INTEGER) AS is_normal,
  CAST(total_orders < 95 AND late_rate = 1.0 AS INTEGER) AS is_new_problem,
  CAST(total_orders >= 95 AND late_rate = 0 AS INTEGER) AS is_perfect
FROM ({_SELLER_ITEMS_SQL}) s""")
def _segments(c: Ctx):
    """Active / chronic / normal / new-problem / perfect seller flags (item grain)."""
    return B.seller_segments(B.seller_perf_items(c.oi), CFG)


@register("ratio_capped", f"""
SELECT CAST(count(*) AS BIGINT) AS n, {r4('avg(actual_vs_est_ratio)', 'mean_ratio')},
  {r4('max(actual_vs_est_ratio)', 'max_ratio')}
FROM nb WHERE actual_vs_est_ratio < 3""")
def _ratio_capped(c: Ctx):
    """The ratio view capped below 3 (chart input)."""
    return B.capped(c.nb, "actual_vs_est_ratio", 3.0).agg(
        F.count(F.lit(1)).alias("n"), F.avg("actual_vs_est_ratio").alias("mean_ratio"),
        F.max("actual_vs_est_ratio").alias("max_ratio"))


@register("approval_capped_p95", f"""
WITH q AS (SELECT quantile_cont(t1_approval_h, 0.95) AS cap FROM nb)
SELECT CAST(count(*) AS BIGINT) AS n, {r4('max(t1_approval_h)', 'max_h')}
FROM nb CROSS JOIN q WHERE t1_approval_h <= cap""")
def _approval_p95(c: Ctx):
    """Approval delay capped at its own P95."""
    return B.capped_at_quantile(c.nb.where(F.col("t1_approval_h").isNotNull()), "t1_approval_h", 0.95).agg(
        F.count(F.lit(1)).alias("n"), F.max("t1_approval_h").alias("max_h"))


@register("orders_items", f"""
SELECT order_id, seller_id, product_id, order_item_id, {r4('price', 'price')},
  {r4('freight_value', 'freight_value')}, is_late, CAST(delivery_days AS DOUBLE) AS delivery_days
FROM nb JOIN src_items USING (order_id)""")
def _orders_items(c: Ctx):
    """Delivered x items, inner, item grain."""
    return _nullable_ints_as_double(c.oi.select("order_id", "seller_id", "product_id", "order_item_id",
                                                "price", "freight_value", "is_late", "delivery_days"))


@register("orders_reviews", """
SELECT order_id, is_late, CAST(review_score AS DOUBLE) AS review_score FROM nb LEFT JOIN src_reviews USING (order_id)""")
def _orders_reviews(c: Ctx):
    """Delivered x reviews, left (fan-out kept, missing score null)."""
    return _nullable_ints_as_double(c.orr.select("order_id", "is_late", "review_score"))


@register("items_products", """
SELECT order_id, oi.product_id, p.product_category_name,
  coalesce(ct.product_category_name_english, p.product_category_name) AS category_en
FROM nb JOIN src_items oi USING (order_id) JOIN src_products p ON p.product_id = oi.product_id
LEFT JOIN src_cat_trans ct ON ct.product_category_name = p.product_category_name""")
def _items_products(c: Ctx):
    """Items with product category (inner) and English name (left)."""
    return B.category_items(c.oi, c.t.products, c.t.cat_trans).select(
        "order_id", "product_id", "product_category_name", "category_en")


@register("cohort_back_join", f"""
SELECT order_id, seller_id, cohort FROM {_OI} oi JOIN {_FIRST} f USING (seller_id)""")
def _cohort_back(c: Ctx):
    """Item rows with their seller's first-order quarter (item grain)."""
    first = B.seller_first_order(c.oi).select("seller_id", "cohort")
    return c.oi.join(first, "seller_id").select("order_id", "seller_id", "cohort")


@register("outlier_sellers", " UNION ALL ".join(f"""
SELECT order_id, seller_id, '{s}' AS rule, {r4(s, 'hours')}, delivery_days
FROM nb JOIN src_items USING (order_id) WHERE {s} > {thr}""" for s, thr, _ in _RULES_SQL))
def _outlier_sellers_rows(c: Ctx):
    """Outliers of every rule joined to their items' sellers."""
    return ST.rule_rows(c.nb, cols=["delivery_days"]).join(
        c.t.items.select("order_id", "seller_id"), "order_id").select(
        "order_id", "seller_id", "rule", "hours", "delivery_days")


@register("normalised_counts", f"""
SELECT freight_bucket, CAST(count(*) AS BIGINT) AS n, round(count(*) * 1.0 / sum(count(*)) OVER (), 4) AS share
FROM fact GROUP BY freight_bucket""")
def _normalised(c: Ctx):
    """Share of fact rows per freight bucket (value_counts normalised)."""
    return B.normalised_counts(c.facts("freight_bucket"), "freight_bucket")


@register("limit_n", f"""
SELECT order_id, is_late, delivery_days FROM nb ORDER BY order_id LIMIT 5""")
def _limit(c: Ctx):
    """First five delivered orders by id (head with a declared order)."""
    return TK.limit_n(c.nb.select("order_id", "is_late", "delivery_days"), 5, ["order_id"])


# dashboard aliases of existing data sets
for _alias, _src in [("dash_bottleneck", "stage_late_vs_ontime"), ("dash_trend", "agg_monthly_trend"),
                     ("dash_cohorts", "agg_cohort_performance"), ("dash_regional", "agg_regional_stats"),
                     ("dash_estimates", "delivery_estimate_by_state"), ("dash_risk", "risk_distribution")]:
    QUERIES[_alias] = QUERIES[_src]
    if _src in SQL:
        SQL[_alias] = SQL[_src]


# =================================================================== scalar functions, one query
@register("calendar_labels", f"""
SELECT order_id, purchase_month, purchase_dayofweek, purchase_hour, purchase_day AS day_of_month,
  strftime(CAST(make_timestamp(ps * 1000000) AS DATE), '%Y-%m-%d') AS order_date,
  CAST(year(make_timestamp(ps * 1000000)) AS VARCHAR) || 'Q' || CAST(quarter(make_timestamp(ps * 1000000)) AS VARCHAR) AS quarter_label,
  strftime(make_timestamp(ps * 1000000), '%Y-%m') AS year_month,
  strftime(make_timestamp(ps * 1000000), '%Y-W%W') AS week_label,
  strftime(make_timestamp(ps * 1000000), '%Y%m%d_%H%M%S') AS snapshot_label,
  {_MONTHS}[purchase_month] AS month_name, {_DAYS}[purchase_dayofweek + 1] AS day_name,
  CAST(purchase_dayofweek >= 5 AS INTEGER) AS is_weekend,
  CASE WHEN purchase_dayofweek >= 5 THEN 'Weekend' ELSE 'Hari Kerja' END AS weekend_label,
  {_PERIOD} AS time_period, substr(order_id, 1, 8) || '...' AS short_id,
  {r4('round_even(t1_approval_h / 24.0, 1)', 't1_days')}, {r4('avg_pct', 'late_pct_of_month')}
FROM nb JOIN (SELECT purchase_month AS m, avg(is_late) * 100 AS avg_pct FROM nb GROUP BY 1) mm
  ON mm.m = nb.purchase_month""")
def _calendar(c: Ctx):
    """Every calendar/label scalar on each delivered order (+ a percent join-back)."""
    from lateline.functions import columns as Cf
    ts = F.col("order_purchase_timestamp")
    month_pct = (c.nb.groupBy(F.col("purchase_month").alias("_m"))
                 .agg(Cf.percent(F.avg("is_late")).alias("late_pct_of_month")))
    return c.nb.join(month_pct, F.col("_m") == F.col("purchase_month")).select(
        "order_id", "purchase_month", "purchase_dayofweek", "purchase_hour",
        F.dayofmonth(ts).alias("day_of_month"), F.to_date(ts).alias("order_date"),
        Cf.quarter_label(ts).alias("quarter_label"), Cf.year_month(ts).alias("year_month"),
        Cf.week_label(ts).alias("week_label"), Cf.snapshot_label(ts).alias("snapshot_label"),
        Cf.month_name("purchase_month").alias("month_name"), Cf.day_name("purchase_dayofweek").alias("day_name"),
        Cf.weekend_flag("purchase_dayofweek").alias("is_weekend"),
        Cf.weekend_label(Cf.weekend_flag("purchase_dayofweek")).alias("weekend_label"),
        Cf.time_period("purchase_hour").alias("time_period"), Cf.short_id("order_id").alias("short_id"),
        Cf.hours_to_days("t1_approval_h").alias("t1_days"), "late_pct_of_month")


@register("kpi_components", """
SELECT round(avg(1 - is_late) * 100, 4) AS on_time, round(avg(CAST(coalesce(days_late, 0) > 3 AS INTEGER)) * 100, 4) AS breach,
  round(avg(actual_vs_est_ratio), 4) AS sla, round(avg(CAST(t2_processing_h <= 48 AS INTEGER)) * 100, 4) AS processing,
  (SELECT round(avg(late_rate) * 100, 4) FROM (SELECT seller_id, count(DISTINCT order_id) AS n, avg(is_late) AS late_rate
     FROM fact WHERE seller_id IS NOT NULL GROUP BY seller_id) s WHERE n >= 95) AS seller_late
FROM fact""")
def _kpi_components(c: Ctx):
    """The five KPI actuals, unrounded (kpi_on_time ... kpi_processing)."""
    return kpi.kpi_values(c.facts(*kpi.KPI_COLS, reuse=True), CFG)


@register("kpi_sla_variants", f"""
SELECT {r4('avg(actual_vs_est_ratio)', 'mean_ratio')},
  {r4('avg(CAST(actual_vs_est_ratio BETWEEN 0.8 AND 1.0 AS INTEGER)) * 100', 'in_range_pct')},
  CASE WHEN avg(actual_vs_est_ratio) >= 0.8 THEN '✅' ELSE '❌' END AS status_pipeline,
  CASE WHEN avg(CAST(actual_vs_est_ratio BETWEEN 0.8 AND 1.0 AS INTEGER)) * 100 >= 50 THEN '✅' ELSE '❌' END AS status_notebook,
  CASE WHEN avg(actual_vs_est_ratio) BETWEEN 0.8 AND 1.0 THEN '✅' ELSE '❌' END AS status_readme
FROM fact WHERE actual_vs_est_ratio IS NOT NULL""")
def _kpi_sla_variants(c: Ctx):
    """Pipeline, notebook and README rules of the SLA KPI in one row."""
    return kpi.kpi_sla_variants(c.facts("actual_vs_est_ratio"), CFG)
