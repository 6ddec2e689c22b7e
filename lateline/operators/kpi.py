"""KPI summary: five KPIs from one single-pass aggregate, unpivoted to rows.

The displayed operator and the tested rule differ at the boundary exactly as
in the reference (S27): ``>`` is shown where ``>=`` is tested, ``<`` where
``<=`` is tested.  Variants of the SLA (S28) and seller (S29) KPIs are kept
as separate named functions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lateline.config import DEFAULT_CONFIG, Config
from lateline.functions import columns as C
from lateline.functions import labels as L


#: Columns of the fact that the KPIs read.
KPI_COLS = ("order_id", "seller_id", "is_late", "days_late", "actual_vs_est_ratio", "t2_processing_h")


def kpi_values(fact: DataFrame, cfg: Config = DEFAULT_CONFIG) -> DataFrame:
    """One row: the five KPI actuals (pipeline definitions)."""
    glob = fact.agg(
        (F.avg(1 - F.col("is_late")) * 100).alias("on_time"),
        (F.avg((F.coalesce(F.col("days_late"), F.lit(0)) > cfg.breach_days).cast("int")) * 100)
        .alias("breach"),
        F.avg("actual_vs_est_ratio").alias("sla"),
        (F.avg((F.col("t2_processing_h") <= cfg.processing_limit_h).cast("int")) * 100)
        .alias("processing"),
    )
    # only the two measures the KPI needs (distinct orders, row-level rate)
    sellers = (fact.where(F.col("seller_id").isNotNull()).groupBy("seller_id")
               .agg(F.countDistinct("order_id").alias("total_orders"),
                    F.avg("is_late").alias("late_rate"))
               .where(F.col("total_orders") >= cfg.active_min_orders)
               .agg((F.avg("late_rate") * 100).alias("seller_late")))
    return C.with_scalars(glob, sellers)


def kpi_summary(fact: DataFrame, cfg: Config = DEFAULT_CONFIG) -> DataFrame:
    v = kpi_values(fact, cfg)

    def row(name, actual, digits, target, shown, passed, unit):
        return F.struct(F.lit(name).alias("kpi_name"),
                        F.bround(actual, digits).alias("actual_value"),
                        F.lit(float(target)).alias("target_value"),
                        F.lit(shown).alias("target_operator"),
                        C.status_mark(F.coalesce(passed, F.lit(False))).alias("status"),
                        F.lit(unit).alias("unit"))

    on_time, breach, sla = F.col("on_time"), F.col("breach"), F.col("sla")
    seller, proc = F.col("seller_late"), F.col("processing")
    rows = F.array(
        row(L.KPI_ON_TIME, on_time, 2, cfg.target_on_time, ">", on_time >= cfg.target_on_time, "%"),
        row(L.KPI_BREACH, breach, 2, cfg.target_breach, "<", breach <= cfg.target_breach, "%"),
        row(L.KPI_SLA, sla, 3, cfg.target_sla, ">=", sla >= cfg.target_sla, "ratio"),
        row(L.KPI_SELLER, seller, 2, cfg.target_seller_late, "<",
            seller <= cfg.target_seller_late, "%"),
        row(L.KPI_PROCESSING, proc, 2, cfg.target_processing, ">",
            proc >= cfg.target_processing, "%"),
    )
    return v.select(F.inline(rows))


def kpi_sla_in_range(fact: DataFrame, cfg: Config = DEFAULT_CONFIG) -> DataFrame:
    """Notebook SLA variant: share of ratios in [0.8, 1.0] must reach 50 %."""
    r = F.col("actual_vs_est_ratio")
    return (fact.where(r.isNotNull())
            .agg(F.avg(r).alias("mean_ratio"),
                 (F.avg(r.between(cfg.target_sla, cfg.target_sla_upper).cast("int")) * 100)
                 .alias("in_range_pct"))
            .withColumn("status", C.status_mark(F.col("in_range_pct") >= cfg.sla_in_range_share)))


def kpi_seller_strict(item_seller_stats: DataFrame, cfg: Config = DEFAULT_CONFIG) -> DataFrame:
    """Notebook seller variant: mean of active sellers' rates <= 5 % and no
    chronic active seller; also counts new-problem sellers."""
    s = item_seller_stats
    active = F.col("total_orders") >= cfg.active_min_orders
    out = s.agg(
        (F.avg(F.when(active, F.col("late_rate"))) * 100).alias("avg_seller_late_pct"),
        F.count_if(active & (F.col("late_rate") > cfg.chronic_rate)).alias("chronic_active"),
        F.count_if(~active & (F.col("late_rate") == 1.0)).alias("new_problem"),
    )
    return out.withColumn("status", C.status_mark(
        (F.col("avg_seller_late_pct") <= cfg.target_seller_late) & (F.col("chronic_active") == 0)))


def kpi_notebook(orders_nb: DataFrame, cfg: Config = DEFAULT_CONFIG) -> DataFrame:
    """On-time, breach and processing on the unfiltered, unclipped population.
    Breach counts ``days_late > 3`` over all rows; processing keeps t2 >= 0."""
    t2 = F.col("t2_processing_h")
    return orders_nb.agg(
        (F.avg(1 - F.col("is_late")) * 100).alias("on_time_pct"),
        (F.avg(F.coalesce((F.col("days_late") > cfg.breach_days).cast("int"), F.lit(0))) * 100)
        .alias("breach_pct"),
        (F.avg(F.when(t2 >= 0, (t2 <= cfg.processing_limit_h).cast("int"))) * 100)
        .alias("processing_pct"),
    )


def kpi_sla_variants(fact: DataFrame, cfg: Config = DEFAULT_CONFIG) -> DataFrame:
    """The three SLA rules side by side (S28): pipeline ``mean >= 0.8``;
    notebook ``share of ratios in [0.8, 1.0] >= 50 %``; README ``mean in
    [0.8, 1.0]``.  One aggregate over the non-null ratios."""
    r = F.col("actual_vs_est_ratio")
    lo, hi = cfg.target_sla, cfg.target_sla_upper
    one = fact.where(r.isNotNull()).agg(
        F.avg(r).alias("mean_ratio"),
        (F.avg(r.between(lo, hi).cast("int")) * 100).alias("in_range_pct"))
    m = F.col("mean_ratio")
    return one.select(
        "mean_ratio", "in_range_pct",
        C.status_mark(m >= lo).alias("status_pipeline"),
        C.status_mark(F.col("in_range_pct") >= cfg.sla_in_range_share).alias("status_notebook"),
        C.status_mark((m >= lo) & (m <= hi)).alias("status_readme"))
