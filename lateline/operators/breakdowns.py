"""Notebook breakdowns (population: delivered, unclipped, no outlier filter).

Every function is a lazy ``DataFrame -> DataFrame``; one ``groupBy().agg()``
each, partial aggregation before the shuffle.  Item-grain analyses weight an
order by its item rows (S20): they inner-join the items first.
Rates are fractions; ``*_pct`` columns are percentages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lateline.config import DEFAULT_CONFIG, Config
from lateline.functions import columns as C
from lateline.functions import labels as L
from lateline.functions.buckets import bucket_ord, bucketize, severity_band
from lateline.operators.quantiles import builtin_quantiles, exact_quantiles, select_quantiles

STAGES = ["t1_approval_h", "t2_processing_h", "t3_shipping_h"]


# ---------------------------------------------------------------- joins
def orders_items(nb: DataFrame, items: DataFrame) -> DataFrame:
    """Delivered x items, inner, one row per item (S20)."""
    return nb.join(items.select("order_id", "order_item_id", "seller_id", "product_id",
                                "price", "freight_value"), "order_id")


def orders_customers(nb: DataFrame, customers: DataFrame) -> DataFrame:
    return nb.join(customers.select("customer_id", "customer_state"), "customer_id")


def orders_reviews(nb: DataFrame, reviews: DataFrame) -> DataFrame:
    """Left join (fan-out on several reviews); missing reviews stay null here (S25)."""
    return nb.join(reviews.select("order_id", "review_score"), "order_id", "left")


def _late_aggs(prefix: str = ""):
    return [F.count("order_id").alias(prefix + "total_orders"),
            F.sum("is_late").cast("long").alias(prefix + "late_orders"),
            F.avg("is_late").alias(prefix + "late_rate")]


# ---------------------------------------------------------------- profiles
def order_status_distribution(orders: DataFrame) -> DataFrame:
    """Count per status with its share of all orders (share via a one-row total)."""
    counts = orders.groupBy("order_status").agg(F.count(F.lit(1)).alias("n_orders"))
    total = counts.agg(F.sum("n_orders").alias("_t"))
    return (C.with_scalars(counts, total)
            .select("order_status", "n_orders",
                    (F.col("n_orders") * 100.0 / F.col("_t")).alias("share_pct")))


def delivered_summary(nb: DataFrame) -> DataFrame:
    return nb.agg(F.count(F.lit(1)).alias("delivered"),
                  F.sum("is_late").cast("long").alias("late_orders"),
                  (F.avg("is_late") * 100).alias("late_pct"),
                  F.sum(1 - F.col("is_late")).cast("long").alias("on_time_orders"),
                  (F.avg(1 - F.col("is_late")) * 100).alias("on_time_pct"))


def unpivot(df: DataFrame, cols, ids=(), name="column", value="value") -> DataFrame:
    """Wide -> long: (ids..., name, value) with doubles."""
    return df.select(*ids, *[F.col(c).cast("double").alias(c) for c in cols]).unpivot(
        list(ids), list(cols), name, value)


def describe_columns(df: DataFrame, cols) -> DataFrame:
    """count, mean, std, min, exact quartiles, max per column (pandas describe).
    All columns go through the same rounds of the quantile selection; its one
    row becomes a row per column."""
    one = select_quantiles(df, {c: (F.col(c), {f"{q}_{c}": p for q, p in (("q25", 0.25), ("q50", 0.5), ("q75", 0.75))})
                                for c in cols}, moments=True)
    rows = F.array(*[F.struct(
        F.lit(c).alias("column"), F.col(f"n_{c}").alias("count"), F.col(f"mean_{c}").alias("mean"), F.col(f"std_{c}").alias("std"),
        F.col(f"min_{c}").alias("min"), *[F.col(f"{q}_{c}").alias(q) for q in ("q25", "q50", "q75")], F.col(f"max_{c}").alias("max"))
        for c in cols])
    return one.select(F.inline(rows))


def stage_stats(nb: DataFrame) -> DataFrame:
    """Per stage over non-negative values: mean, median, P95, max hours and max
    days, rounded to one decimal (half-even) like the notebook's table."""
    one = select_quantiles(nb, {c: (F.when(F.col(c) >= 0, F.col(c)), {f"median_{c}": 0.5, f"p95_{c}": 0.95}) for c in STAGES},
                           moments=True)
    r1 = lambda c: F.bround(F.col(c), 1)
    rows = F.array(*[F.struct(
        F.lit(c).alias("stage"), F.col(f"n_{c}").alias("n"), r1(f"mean_{c}").alias("mean_h"), r1(f"median_{c}").alias("median_h"),
        r1(f"p95_{c}").alias("p95_h"), r1(f"max_{c}").alias("max_h"), C.hours_to_days(f"max_{c}").alias("max_days"))
        for c in STAGES])
    return one.select(F.inline(rows)).where("n > 0")


def stage_late_vs_ontime(nb: DataFrame) -> DataFrame:
    """Mean hours per stage for late and on-time orders and the gap (h, days);
    one decimal, the day gap taken from the unrounded hour gap."""
    long = unpivot(nb, STAGES, ids=["is_late"], name="stage")
    out = long.groupBy("stage").agg(
        F.avg(F.when(F.col("is_late") == 1, F.col("value"))).alias("_late"),
        F.avg(F.when(F.col("is_late") == 0, F.col("value"))).alias("_on"))
    diff = F.col("_late") - F.col("_on")
    return out.select("stage", F.bround("_late", 1).alias("late_mean_h"),
                      F.bround("_on", 1).alias("on_time_mean_h"), F.bround(diff, 1).alias("diff_h"),
                      C.hours_to_days(diff).alias("diff_days"))


# ---------------------------------------------------------------- calendar
def late_by_month(nb: DataFrame) -> DataFrame:
    out = nb.groupBy("purchase_month").agg(*_late_aggs(), F.avg("delivery_days").alias("avg_days"))
    pct = F.col("late_rate") * 100
    return out.select("*", pct.alias("late_pct"), C.month_name("purchase_month").alias("month_name"),
                      severity_band(pct, *L.SEVERITY_MONTH).alias("severity"))


def late_by_dow(nb: DataFrame) -> DataFrame:
    return nb.groupBy("purchase_dayofweek").agg(*_late_aggs()).withColumn(
        "late_pct", F.col("late_rate") * 100)


def late_by_hour(nb: DataFrame) -> DataFrame:
    return nb.groupBy("purchase_hour").agg(*_late_aggs()).withColumn(
        "late_pct", F.col("late_rate") * 100)


def dow_detail(nb: DataFrame) -> DataFrame:
    return (nb.groupBy("purchase_dayofweek", C.day_name("purchase_dayofweek").alias("day_name"))
            .agg(*_late_aggs()).withColumn("late_pct", F.col("late_rate") * 100)
            .orderBy("purchase_dayofweek"))


def weekend_vs_workday(nb: DataFrame) -> DataFrame:
    return (nb.groupBy(C.weekend_flag("purchase_dayofweek").alias("is_weekend"))
            .agg(*_late_aggs())
            .select("*", C.weekend_label("is_weekend").alias("category"),
                    (F.col("late_rate") * 100).alias("late_pct")))


def late_by_time_period(nb: DataFrame) -> DataFrame:
    return (nb.groupBy(C.time_period_ord("purchase_hour").alias("period_ord"),
                       C.time_period("purchase_hour").alias("time_period"))
            .agg(*_late_aggs()).withColumn("late_pct", F.col("late_rate") * 100)
            .orderBy("period_ord"))


def november_daily(nb: DataFrame, cfg: Config = DEFAULT_CONFIG) -> DataFrame:
    """Per day of the event month; ``is_event_day`` marks the event day."""
    return (nb.where(F.col("purchase_month") == cfg.event_month)
            .groupBy(F.dayofmonth("order_purchase_timestamp").alias("day"))
            .agg(*_late_aggs())
            .select("*", (F.col("late_rate") * 100).alias("late_pct"),
                    (F.col("day") == cfg.event_day).cast("int").alias("is_event_day")))


def group_rate_benchmark(groups: DataFrame, rate_col: str = "late_rate") -> DataFrame:
    """Unweighted mean of the group rates (the notebook's reference line)."""
    return groups.agg(F.avg(rate_col).alias("mean_group_rate"),
                      F.count(F.lit(1)).alias("n_groups"))


def normalised_counts(df: DataFrame, label: str) -> DataFrame:
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("_t"))
    return C.with_scalars(counts, total).select(
        label, "n", (F.col("n") / F.col("_t")).alias("share"))


# ---------------------------------------------------------------- ratio / approval
def ratio_buckets(nb: DataFrame) -> DataFrame:
    """Counts per ratio bucket and share of the bucketed rows (a ratio of 0 or
    above 20 has no bucket and is left out, like ``value_counts``)."""
    r = F.col("actual_vs_est_ratio")
    b = nb.select(bucketize(r, L.RATIO_EDGES, L.RATIO_LABELS).alias("ratio_bucket"),
                  bucket_ord(r, L.RATIO_EDGES).alias("bucket_ord"))
    out = (b.where(F.col("bucket_ord").isNotNull())
           .groupBy("bucket_ord", "ratio_bucket").agg(F.count(F.lit(1)).alias("n")))
    total = out.agg(F.sum("n").alias("_t"))
    return C.with_scalars(out, total).select(
        "bucket_ord", "ratio_bucket", "n", (F.col("n") * 100.0 / F.col("_t")).alias("share_pct"))


def ratio_shares(nb: DataFrame) -> DataFrame:
    r = F.col("actual_vs_est_ratio")
    return nb.where(r.isNotNull()).agg(
        F.count_if(r < 0.5).alias("n_under_half"),
        (F.avg((r < 0.5).cast("int")) * 100).alias("pct_under_half"),
        F.count_if(r > 1.0).alias("n_over_one"),
        (F.avg((r > 1.0).cast("int")) * 100).alias("pct_over_one"))


def approval_buckets(nb: DataFrame) -> DataFrame:
    """Buckets of t1 with the last edge at the observed maximum; t1 = 0 falls
    outside every bucket (open-left, S11) and is not counted."""
    t1 = F.col("t1_approval_h")
    d = nb.where(t1.isNotNull())
    mx = d.agg(F.max(t1).alias("_max"))
    edges = [F.lit(e) for e in L.APPROVAL_EDGES] + [F.col("_max")]
    b = C.with_scalars(d, mx).select(
        bucketize(t1, edges, L.APPROVAL_LABELS).alias("approval_bucket"),
        bucket_ord(t1, edges).alias("bucket_ord"), "is_late")
    return (b.where(F.col("bucket_ord").isNotNull())
            .groupBy("bucket_ord", "approval_bucket")
            .agg(F.count(F.lit(1)).alias("n"), (F.avg("is_late") * 100).alias("late_pct")))


def approval_tail(nb: DataFrame) -> DataFrame:
    """Counts and shares of long approvals (over non-null t1), and the maximum."""
    t1 = F.col("t1_approval_h")
    d = nb.where(t1.isNotNull())
    mx = d.agg(F.max(t1).alias("max_h"))
    aggs = [F.count(F.lit(1)).alias("n_known")]
    for hrs in [24.0] + L.APPROVAL_TAIL_HOURS:
        k = int(hrs)
        aggs += [F.count_if(t1 > hrs).alias(f"n_over_{k}"),
                 (F.avg((t1 > hrs).cast("int")) * 100).alias(f"pct_over_{k}")]
    return (C.with_scalars(d, mx).groupBy("max_h")
            .agg(*aggs, F.count_if(t1 == F.col("max_h")).alias("n_at_max"))
            .withColumn("max_days", C.hours_to_days("max_h")))


# ---------------------------------------------------------------- sellers / states / categories
def seller_perf_items(oi: DataFrame) -> DataFrame:
    """Item grain per seller: distinct orders, item-row late rate, means, revenue."""
    return oi.groupBy("seller_id").agg(
        F.countDistinct("order_id").alias("total_orders"),
        F.avg("is_late").alias("late_rate"),
        F.avg("t2_processing_h").alias("avg_t2"),
        F.avg("delivery_days").alias("avg_delivery"),
        F.sum(C.money("price")).cast("double").alias("total_revenue"),
    ).withColumn("late_pct", F.col("late_rate") * 100)


def seller_perf_summary(seller_items: DataFrame, cfg: Config = DEFAULT_CONFIG) -> DataFrame:
    active = F.col("total_orders") >= cfg.active_min_orders
    return seller_items.agg(
        F.count(F.lit(1)).alias("sellers"),
        F.count_if(active).alias("active_sellers"),
        F.count_if(active & (F.col("late_rate") == 0)).alias("perfect_sellers"),
        F.count_if(active & (F.col("late_rate") > cfg.chronic_rate)).alias("chronic_sellers"))


def late_by_state(oc: DataFrame) -> DataFrame:
    """Per customer state: orders, late rate, mean days and shipping hours;
    sorted by late rate descending (state as tie-breaker)."""
    out = oc.where(F.col("customer_state").isNotNull()).groupBy("customer_state").agg(
        F.count("order_id").alias("total_orders"),
        F.sum("is_late").cast("long").alias("late_orders"),
        F.avg("is_late").alias("late_rate"),
        F.avg("delivery_days").alias("avg_days"),
        F.avg("t3_shipping_h").alias("avg_t3"))
    pct = F.col("late_rate") * 100
    return (out.select("*", pct.alias("late_pct"),
                       severity_band(pct, *L.SEVERITY_STATE).alias("severity"))
            .orderBy(F.desc("late_pct"), "customer_state"))


def state_days_ranking(state_stats: DataFrame) -> DataFrame:
    return state_stats.orderBy(F.desc("avg_days"), "customer_state")


def category_items(oi: DataFrame, products: DataFrame, cat_trans: DataFrame) -> DataFrame:
    """Items with their product's category (inner) and English name (left)."""
    p = products.select("product_id", "product_category_name")
    return (oi.join(p, "product_id")
            .join(cat_trans, "product_category_name", "left")
            .withColumn("category_en", C.translate_category("product_category_name_english",
                                                            "product_category_name")))


def late_by_category(cat_items: DataFrame, cfg: Config = DEFAULT_CONFIG) -> DataFrame:
    return (cat_items.where(F.col("category_en").isNotNull()).groupBy("category_en").agg(
        F.countDistinct("order_id").alias("total_orders"),
        F.avg("is_late").alias("late_rate"),
        F.avg("delivery_days").alias("avg_days"))
        .where(F.col("total_orders") >= cfg.category_min_orders)
        .withColumn("late_pct", F.col("late_rate") * 100))


# ---------------------------------------------------------------- reviews
def _reviewed(orr: DataFrame) -> DataFrame:
    return orr.where(F.col("review_score").isNotNull())


def review_late_vs_ontime(orr: DataFrame) -> DataFrame:
    """Mean score, quartiles and count by lateness; late rows with score >= 4."""
    r = _reviewed(orr)
    s = F.col("review_score")
    basic = r.groupBy("is_late").agg(
        F.count(F.lit(1)).alias("n"), F.avg(s).alias("mean_score"),
        F.min(s).cast("double").alias("min_score"), F.max(s).cast("double").alias("max_score"),
        F.count_if(s >= 4).alias("n_score_4_5"),
        (F.avg((s >= 4).cast("int")) * 100).alias("pct_score_4_5"))
    qs = builtin_quantiles(r, "review_score", [0.25, 0.5, 0.75], by=["is_late"],
                           names=["q25", "median", "q75"])
    return basic.join(qs, "is_late")


def review_by_delivery_bucket(orr: DataFrame) -> DataFrame:
    r = _reviewed(orr)
    d = F.col("delivery_days")
    return (r.select(bucketize(d, L.DELIVERY_EDGES, L.DELIVERY_LABELS).alias("delivery_bucket"),
                     bucket_ord(d, L.DELIVERY_EDGES).alias("bucket_ord"), "review_score")
            .where(F.col("bucket_ord").isNotNull())
            .groupBy("bucket_ord", "delivery_bucket")
            .agg(F.avg("review_score").alias("mean_score"), F.count(F.lit(1)).alias("n")))


SCORES = [1, 2, 3, 4, 5]


def score_crosstab(orr: DataFrame) -> DataFrame:
    """is_late x score counts (zero-filled) and row percentages; the pivot
    values are declared, so Spark needs no extra pass to find them."""
    r = _reviewed(orr)
    counts = (r.groupBy("is_late").pivot("review_score", SCORES).agg(F.count(F.lit(1)))
              .fillna(0))
    total = sum(F.col(str(s)) for s in SCORES)
    return counts.select(
        "is_late",
        *[F.col(str(s)).cast("long").alias(f"n_{s}") for s in SCORES],
        *[(F.col(str(s)) * 100.0 / total).alias(f"pct_{s}") for s in SCORES])


def review_tolerance(orr: DataFrame) -> DataFrame:
    """Late, reviewed rows by days-late bucket; under one full day late the
    floored value is 0 and falls outside every bucket."""
    r = _reviewed(orr).where(F.col("is_late") == 1)
    d = F.col("days_late")
    return (r.select(bucketize(d, L.DAYS_LATE_EDGES, L.DAYS_LATE_LABELS).alias("late_bucket"),
                     bucket_ord(d, L.DAYS_LATE_EDGES).alias("bucket_ord"), "review_score")
            .where(F.col("bucket_ord").isNotNull())
            .groupBy("bucket_ord", "late_bucket")
            .agg(F.avg("review_score").alias("mean_score"), F.count(F.lit(1)).alias("n")))


# ---------------------------------------------------------------- cohorts / freight
def seller_first_order(oi: DataFrame) -> DataFrame:
    return (oi.groupBy("seller_id")
            .agg(F.min("order_purchase_timestamp").alias("first_order"))
            .withColumn("cohort", C.quarter_label("first_order")))


def cohort_sizes(oi: DataFrame) -> DataFrame:
    return (seller_first_order(oi).groupBy("cohort")
            .agg(F.count(F.lit(1)).alias("n_sellers")).orderBy("cohort"))


def cohort_perf_items(oi: DataFrame) -> DataFrame:
    first = seller_first_order(oi).select("seller_id", "cohort")
    ci = oi.join(first, "seller_id")
    out = ci.groupBy("cohort").agg(
        F.countDistinct("order_id").alias("total_orders"),
        F.sum("is_late").cast("long").alias("late_orders"),   # item rows, as in the notebook
        F.avg("is_late").alias("late_rate"))
    # every seller has one cohort: its count needs no second distinct over the items
    out = out.join(first.groupBy("cohort").agg(F.count(F.lit(1)).alias("seller_count")), "cohort", "left")
    pct = F.col("late_rate") * 100
    return (out.select("*", pct.alias("late_pct"),
                       severity_band(pct, *L.SEVERITY_COHORT).alias("severity"))
            .orderBy("cohort"))


def order_freight(oi: DataFrame) -> DataFrame:
    """Order grain: summed freight and price, lateness, freight/price ratio."""
    return oi.groupBy("order_id").agg(
        F.coalesce(F.sum(C.money("freight_value")), F.lit(0)).cast("double").alias("total_freight"),
        F.coalesce(F.sum(C.money("price")), F.lit(0)).cast("double").alias("total_price"),
        F.max("is_late").alias("is_late"),
    ).withColumn("freight_ratio", C.safe_div("total_freight", "total_price"))


def order_freight_summary(of: DataFrame) -> DataFrame:
    return of.agg(F.count(F.lit(1)).alias("n_orders"),
                  F.avg("total_freight").alias("mean_freight"),
                  F.avg("total_price").alias("mean_price"),
                  F.avg("freight_ratio").alias("mean_ratio"))


def freight_qcut(of: DataFrame) -> DataFrame:
    """Equal-frequency quintiles of order freight; first bucket includes the minimum."""
    qs = exact_quantiles(of, "total_freight", [0.0, 0.2, 0.4, 0.6, 0.8, 1.0],
                         names=["_e0", "_e1", "_e2", "_e3", "_e4", "_e5"])
    edges = [F.col(f"_e{i}") for i in range(6)]
    tf = F.col("total_freight")
    return (C.with_scalars(of, qs)
            .withColumn("freight_bucket", bucketize(tf, edges, L.FREIGHT_LABELS, include_lowest=True))
            .withColumn("bucket_ord", bucket_ord(tf, edges, include_lowest=True))
            .drop(*[f"_e{i}" for i in range(6)]))


def late_by_freight(of: DataFrame) -> DataFrame:
    out = (freight_qcut(of).where(F.col("bucket_ord").isNotNull())
           .groupBy("bucket_ord", "freight_bucket").agg(
               F.count(F.lit(1)).alias("total_orders"),
               F.avg("is_late").alias("late_rate"),
               F.avg("total_freight").alias("avg_freight")))
    pct = F.col("late_rate") * 100
    return out.select("*", pct.alias("late_pct"),
                      severity_band(pct, *L.SEVERITY_FREIGHT).alias("severity"))


# ---------------------------------------------------------------- estimates
def state_names(spark) -> DataFrame:
    """Code -> name (27 rows, fixed by nature: broadcast)."""
    return spark.createDataFrame(sorted(L.STATE_NAMES.items()), "customer_state string, state_name string")


def delivery_estimate_by_state(oc: DataFrame) -> DataFrame:
    """Per state: median estimate and actual, P75/P90 of actual, recommended
    estimate ``int(P75) + 1`` and the gap; sorted by P75 descending.  Day
    counts form a small domain, so Spark's exact ``percentile`` map is small."""
    d = oc.where(F.col("customer_state").isNotNull())
    est = builtin_quantiles(d, "estimated_days", [0.5], by=["customer_state"], names=["median_estimate"])
    act = builtin_quantiles(d, "delivery_days", [0.5, 0.75, 0.9], by=["customer_state"],
                            names=["median_actual", "p75_actual", "p90_actual"])
    n = d.groupBy("customer_state").agg(F.count("order_id").alias("total_orders"))
    names = F.broadcast(state_names(oc.sparkSession))
    out = (n.join(est, "customer_state", "left").join(act, "customer_state", "left")
           .join(names, "customer_state", "left"))
    return (out.select("customer_state", "state_name", "median_estimate", "median_actual",
                       "p75_actual", "p90_actual", "total_orders",
                       C.recommended_days("p75_actual").alias("recommended_days"),
                       (F.col("median_estimate") - F.col("median_actual")).alias("estimate_gap"))
            .orderBy(F.desc("p75_actual"), "customer_state"))


# ---------------------------------------------------------------- filters as reports
def split_late(nb: DataFrame) -> DataFrame:
    """Late and on-time subsets summarised in one pass (conditional aggregates)."""
    late = F.col("is_late") == 1
    return nb.agg(
        F.count_if(late).alias("late_orders"), F.count_if(~late).alias("on_time_orders"),
        F.avg(F.when(late, F.col("delivery_days"))).alias("late_mean_days"),
        F.avg(F.when(~late, F.col("delivery_days"))).alias("on_time_mean_days"))


def seller_segments(seller_items: DataFrame, cfg: Config = DEFAULT_CONFIG) -> DataFrame:
    """Per seller: active, chronic, normal, new-problem and perfect flags."""
    n, r = F.col("total_orders"), F.col("late_rate")
    active = n >= cfg.active_min_orders
    return seller_items.select(
        "seller_id", "total_orders", "late_rate",
        active.cast("int").alias("is_active"),
        (active & (r > cfg.chronic_rate)).cast("int").alias("is_chronic"),
        (active & (r <= cfg.chronic_rate)).cast("int").alias("is_normal"),
        (~active & (r == 1.0)).cast("int").alias("is_new_problem"),
        (active & (r == 0)).cast("int").alias("is_perfect"))


def capped(df: DataFrame, col: str, cap: float, strict: bool = True) -> DataFrame:
    """Rows under a cap for a view (``< cap`` or ``<= cap``)."""
    c = F.col(col)
    return df.where(c < cap if strict else c <= cap)


def capped_at_quantile(df: DataFrame, col: str, q: float = 0.95) -> DataFrame:
    """Rows at or below the column's exact q-quantile (one-row broadcast)."""
    cut = exact_quantiles(df, col, [q], names=["_cap"])
    return C.with_scalars(df, cut).where(F.col(col) <= F.col("_cap")).drop("_cap")
