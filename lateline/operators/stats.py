"""Statistics: IQR outliers, extreme rows, correlation, histograms, box-plot
summaries, 2x2 chi-square tests with Yates correction, repeatable sampling.

Statistics are aggregates: one pass, partial aggregation, and results of a
handful of rows.  Quantiles use the distributed exact operator
(``lateline.operators.quantiles``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lateline.config import DEFAULT_CONFIG, Config
from lateline.functions import columns as C
from lateline.operators.quantiles import exact_quantiles, select_quantiles

IQR_COLS = ["delivery_days", "t1_approval_h", "t2_processing_h", "t3_shipping_h"]
CORR_COLS = ["t1_approval_h", "t2_processing_h", "t3_shipping_h", "delivery_days",
             "estimated_days", "days_late", "actual_vs_est_ratio", "is_late",
             "purchase_month", "purchase_hour", "review_score"]
# (stage, threshold hours, timestamp whose date is inspected)
EXTREME_RULES = [("t1_approval_h", 700.0, "order_approved_at"),
                 ("t3_shipping_h", 3000.0, "order_delivered_customer_date"),
                 ("t2_processing_h", 2000.0, "order_delivered_carrier_date")]


def iqr_outliers(df: DataFrame, cols: Sequence[str] = IQR_COLS) -> DataFrame:
    """Per column over non-negative values: Q1, Q3, IQR, fences at 1.5 IQR,
    rows outside, their share, and the maximum.  One wide aggregate over the
    rows as they are, with the fences as scalars."""
    value = {c: F.when(F.col(c) >= 0, F.col(c).cast("double")) for c in cols}
    qs = select_quantiles(df, {c: (value[c], {f"q1_{c}": 0.25, f"q3_{c}": 0.75}) for c in cols})
    q1, q3 = ({c: F.col(f"{q}_{c}") for c in cols} for q in ("q1", "q3"))
    lower, upper = ({c: end + sign * 1.5 * (q3[c] - q1[c]) for c, end in q.items()} for q, sign in ((q1, -1), (q3, 1)))
    outside = {c: (value[c] < lower[c]) | (value[c] > upper[c]) for c in cols}
    one = C.with_scalars(df.select(*cols), qs).agg(*[x for c in cols for x in (
        F.count_if(outside[c]).alias(f"_out_{c}"), (F.avg(outside[c].cast("int")) * 100).alias(f"_pct_{c}"),
        F.max(value[c]).alias(f"_max_{c}"), F.count(value[c]).alias(f"_n_{c}"))])
    rows = F.array(*[F.struct(
        F.lit(c).alias("column"), q1[c].alias("q1"), q3[c].alias("q3"), (q3[c] - q1[c]).alias("iqr"), lower[c].alias("lower"),
        upper[c].alias("upper"), F.col(f"_out_{c}").alias("n_outliers"), F.col(f"_pct_{c}").alias("outlier_pct"),
        F.col(f"_max_{c}").alias("max"), F.col(f"_n_{c}").alias("n")) for c in cols])
    return C.with_scalars(one, qs).select(F.inline(rows)).where("n > 0")


def extreme_rows(df: DataFrame, stage: str, threshold: float, cols: Sequence[str] = ()) -> DataFrame:
    """Rows whose stage exceeds a threshold, with ids and the stage value."""
    base = ["order_id", "customer_id", "order_purchase_timestamp", stage, "is_late"]
    keep = list(dict.fromkeys(base + list(cols)))
    return df.where(F.col(stage) > threshold).select(*keep)


def rule_rows(df: DataFrame, rules=EXTREME_RULES, cols: Sequence[str] = ()) -> DataFrame:
    """One row per order and rule that it breaks (``rule, threshold_h, hours,
    event_date``, ids), from one pass over the orders."""
    hit = F.array_compact(F.array(*[
        F.when(F.col(stage) > thr, F.struct(F.lit(stage).alias("rule"), F.lit(thr).alias("threshold_h"),
                                            F.col(stage).cast("double").alias("hours"), F.to_date(ts).alias("event_date")))
        for stage, thr, ts in rules]))
    return df.select("order_id", *cols, F.inline(hit))


def outlier_decision_evidence(df: DataFrame, items: DataFrame,
                              rules=EXTREME_RULES) -> DataFrame:
    """Per rule: extreme rows, distinct sellers (via items), distinct dates of
    the inspected timestamp, and the share of rows on the most common date."""
    ext = rule_rows(df, rules)
    sellers = outlier_unique_sellers(df, items, rules).select("rule", "distinct_sellers")
    per_day = ext.groupBy("rule", "threshold_h", "event_date").agg(F.count(F.lit(1)).alias("n_day"))
    days = per_day.groupBy("rule", "threshold_h").agg(
        F.sum("n_day").alias("n_rows"), F.count("event_date").alias("distinct_dates"),
        F.max(F.when(F.col("event_date").isNotNull(), F.col("n_day"))).alias("modal_date_rows"))
    return (days.join(sellers, "rule", "left")
            .select("rule", "threshold_h", "n_rows",
                    F.coalesce("distinct_sellers", F.lit(0)).alias("distinct_sellers"),
                    "distinct_dates", "modal_date_rows",
                    (F.col("modal_date_rows") * 100.0 / F.col("n_rows")).alias("modal_date_pct")))


def outlier_dates(df: DataFrame, rules=EXTREME_RULES, n: int = 10) -> DataFrame:
    """Per rule the top-n dates of its timestamp among the extreme rows (count
    desc, date asc): a ranking of per-date counts."""
    per = rule_rows(df, rules).groupBy("rule", "event_date").agg(F.count(F.lit(1)).alias("n"))
    rank = F.row_number().over(Window.partitionBy("rule").orderBy(F.desc("n"), "event_date"))
    return per.withColumn("_r", rank).where(F.col("_r") <= n).drop("_r")


def outlier_unique_sellers(df: DataFrame, items: DataFrame, rules=EXTREME_RULES) -> DataFrame:
    """Per rule: distinct sellers and item rows of the extreme orders."""
    return (rule_rows(df, rules).join(items.select("order_id", "seller_id"), "order_id")
            .groupBy("rule").agg(F.countDistinct("seller_id").alias("distinct_sellers"),
                                 F.count(F.lit(1)).alias("n_item_rows")))


def correlation_matrix(df: DataFrame, cols: Sequence[str] = CORR_COLS) -> DataFrame:
    """Pearson r of every column pair (pairwise complete) from one aggregate,
    unpivoted to (col_a, col_b, r); a < b in the given column order."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    one = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"{a}__{b}")
                   for a, b in pairs])
    rows = F.array(*[F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"),
                              F.col(f"{a}__{b}").alias("r")) for a, b in pairs])
    return one.select(F.inline(rows))


def histograms(df: DataFrame, charts: Sequence[tuple[str, str, float | None, float | None]], bins: int) -> DataFrame:
    """Equal-width bins of several charts ``(name, column, cap, quantile cap)``
    between each chart's observed min and max (after its cap, a number or the
    column's quantile); the maximum falls into the last bin like numpy.  All
    caps, then all borders, then all counts are one pass each, whatever the
    number of charts."""
    cols = list(dict.fromkeys(c for _, c, _, _ in charts))
    base = df.select(*[F.col(c).cast("double").alias(c) for c in cols])
    cut = {i: (F.col(c), {f"_cap{i}": p}) for i, (_, c, _, p) in enumerate(charts) if p is not None}
    if cut:
        caps = select_quantiles(base, {f"k{i}": v for i, v in cut.items()})
        base = C.with_scalars(base, caps.select(*[f"_cap{i}" for i in cut]))
    v = {}
    for i, (_, c, cap, _) in enumerate(charts):
        ok = F.col(c).isNotNull() & ~F.isnan(c)
        for most in ([F.lit(cap)] if cap is not None else []) + ([F.col(f"_cap{i}")] if i in cut else []):
            ok = ok & (F.col(c) <= most)
        v[i] = F.when(ok, F.col(c)).alias(f"_v{i}")
    base = base.select(*v.values())
    ends = base.agg(*[x for i in v for x in (F.min(f"_v{i}").alias(f"_lo{i}"), F.max(f"_v{i}").alias(f"_hi{i}"))])
    rows = []
    for i, (name, *_) in enumerate(charts):
        x, lo, hi = (F.col(f"{c}{i}") for c in ("_v", "_lo", "_hi"))
        at = F.when(hi == lo, F.lit(0)).otherwise(F.least(F.floor((x - lo) / F.nullif((hi - lo) / bins, F.lit(0.0))), F.lit(bins - 1))).cast("int")
        rows.append(F.when(x.isNotNull(), F.struct(F.lit(name).alias("chart"), at.alias("bin"), lo.alias("_lo"), hi.alias("_hi"))))
    out = (C.with_scalars(base, ends).select(F.inline(F.array_compact(F.array(*rows))))
           .groupBy("chart", "bin", "_lo", "_hi").agg(F.count(F.lit(1)).alias("n")))
    w = (F.col("_hi") - F.col("_lo")) / bins
    return out.select("chart", "bin", (F.col("_lo") + F.col("bin") * w).alias("bin_lo"),
                      (F.col("_lo") + (F.col("bin") + 1) * w).alias("bin_hi"), "n")


def histogram(df: DataFrame, col: str, bins: int, cap: float | None = None) -> DataFrame:
    """One chart of ``histograms``."""
    return histograms(df, [(col, col, cap, None)], bins).drop("chart")


def five_number_summary(df: DataFrame, col: str, by: Sequence[str] = ()) -> DataFrame:
    """Box-plot numbers: quartiles, whiskers (most extreme values within 1.5
    IQR of the box) and the count of values outside them."""
    by = list(by)
    v = F.col(col).cast("double")
    d = df.where(v.isNotNull()).select(*by, v.alias("_v"))
    qs = exact_quantiles(d, "_v", [0.25, 0.5, 0.75], by=by, names=["q1", "median", "q3"])
    lo = F.col("q1") - 1.5 * (F.col("q3") - F.col("q1"))
    hi = F.col("q3") + 1.5 * (F.col("q3") - F.col("q1"))
    # one quantile row per group, broadcast: the rows stay where they are, and are
    # aggregated there before the exchange; globally the quartiles are scalar subqueries
    j = d.join(F.broadcast(qs), by, "inner") if by else C.with_scalars(d, qs)
    inside = (F.col("_v") >= lo) & (F.col("_v") <= hi)
    keys = by + ["q1", "median", "q3"]
    return (j.groupBy(*keys).agg(
        F.min(F.when(inside, F.col("_v"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("_v"))).alias("whisker_high"),
        F.count_if(~inside).alias("n_outside"), F.count(F.lit(1)).alias("n")))


# ------------------------------------------------------------------ chi-square
def chi2_from_counts(counts: DataFrame) -> DataFrame:
    """Columns a, b (row 1: negatives, positives), c, d (row 2) -> Yates chi2
    for a 2x2 table, dof 1, expected counts, p-value and verdict (p < .05)."""
    a, b, c, d = (F.col(x).cast("double") for x in "abcd")
    n = a + b + c + d
    r1, r2, c1, c2 = a + b, c + d, a + c, b + d
    diff = F.abs(a * d - b * c)
    corrected = F.greatest(diff - n / 2, F.lit(0.0))
    chi2 = F.when((r1 * r2 * c1 * c2) > 0, n * corrected * corrected / (r1 * r2 * c1 * c2))
    nz = F.nullif(n, F.lit(0.0))   # ANSI: an empty table gives nulls, not an error
    out = counts.select(
        "*", chi2.alias("chi2"), F.lit(1).alias("dof"),
        (r1 * c1 / nz).alias("exp_a"), (r1 * c2 / nz).alias("exp_b"),
        (r2 * c1 / nz).alias("exp_c"), (r2 * c2 / nz).alias("exp_d"))
    # one degree of freedom: the upper tail is erfc(sqrt(chi2 / 2))
    return (out.withColumn("_x", F.sqrt(F.col("chi2") / 2)).withColumn("p_value", F.expr(C.erfc_sql("_x"))).drop("_x")
            .withColumn("significant", (F.col("p_value") < 0.05).cast("int")))


def late_table(df: DataFrame, group_col, first, second, late: str = "is_late") -> DataFrame:
    """2x2 counts of (on time, late) for two groups, from one aggregate."""
    g = F.col(group_col) if isinstance(group_col, str) else group_col
    l = F.col(late)
    return df.agg(
        F.count_if((g == first) & (l == 0)).alias("a"), F.count_if((g == first) & (l == 1)).alias("b"),
        F.count_if((g == second) & (l == 0)).alias("c"), F.count_if((g == second) & (l == 1)).alias("d"))


def chi2_2x2(df: DataFrame, group_col, first, second, late: str = "is_late") -> DataFrame:
    return chi2_from_counts(late_table(df, group_col, first, second, late))


def chi2_state_pair(oc: DataFrame, first: str, second: str) -> DataFrame:
    return chi2_2x2(oc, "customer_state", first, second)


def chi2_month_pair(nb: DataFrame, first: int = 3, second: int = 6) -> DataFrame:
    return chi2_2x2(nb, "purchase_month", first, second)


def chi2_chronic_normal(seller_items: DataFrame, cfg: Config = DEFAULT_CONFIG) -> DataFrame:
    """Chronic vs normal active sellers; late counts rebuilt as
    ``int(sum(orders * rate))`` per class like the reference."""
    s = seller_items.where(F.col("total_orders") >= cfg.active_min_orders)
    chronic = F.col("late_rate") > cfg.chronic_rate
    lw = F.col("total_orders") * F.col("late_rate")
    t = s.agg(
        F.floor(F.sum(F.when(chronic, lw))).alias("b"),
        F.sum(F.when(chronic, F.col("total_orders"))).alias("_n1"),
        F.floor(F.sum(F.when(~chronic, lw))).alias("d"),
        F.sum(F.when(~chronic, F.col("total_orders"))).alias("_n2"))
    t = t.select((F.col("_n1") - F.col("b")).cast("long").alias("a"), F.col("b").cast("long").alias("b"),
                 (F.col("_n2") - F.col("d")).cast("long").alias("c"), F.col("d").cast("long").alias("d"))
    return chi2_from_counts(t)


def chi2_freight_pair(freight_buckets: DataFrame, first: str = "Sangat murah",
                      second: str = "Sangat mahal") -> DataFrame:
    return chi2_2x2(freight_buckets, "freight_bucket", first, second)


def chi2_risk_pair(scored: DataFrame, first: str = "High Risk", second: str = "Low Risk") -> DataFrame:
    return chi2_2x2(scored, "risk_level", first, second)


# ------------------------------------------------------------------ sampling
def sample_fixed(df: DataFrame, n: int, seed: int = 42, key: str = "order_id") -> DataFrame:
    """n rows chosen by a seeded hash of the key: the same rows for any
    partitioning (top-n by hash, no full sort)."""
    h = F.xxhash64(F.col(key), F.lit(seed))
    return df.withColumn("_h", h).orderBy("_h", key).limit(n).drop("_h")
