"""The weekly job: sources -> enrichment -> fact -> marts, KPIs, risk ->
quality gate -> publish a whole version -> quality report.

Checks run **before** publishing: a failed gate publishes nothing and the
previous tables stay in place.  The fact, the marts and the risk scores are
staged as Parquet below the cluster's checkpoint folder
(``spark.checkpoint.dir``): the gate and the publication read the same staged
tables, and lost executors do not force a recompute of the whole lineage.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from lateline.config import DEFAULT_CONFIG, Config
from lateline.operators import fact as FT, kpi, marts, quality as Q, risk as R
from lateline.session import staged
from lateline.sinks import writers as W
from lateline.sources.files import Tables


@dataclass
class RunResult:
    run_id: str
    week: str
    row_counts: dict = field(default_factory=dict)
    checks: list = field(default_factory=list)


def build_outputs(tables: Tables, cfg: Config = DEFAULT_CONFIG, with_model: bool = True,
                  checkpoint: bool = True) -> dict[str, DataFrame]:
    fact = FT.fact_deliveries(tables, cfg, materialize=checkpoint)
    if checkpoint:
        fact = staged(fact, "fact")
    out = {
        "fact_deliveries": fact,
        "dim_sellers": FT.dim_sellers(tables.sellers),
        "dim_customers": FT.dim_customers(tables.customers),
        "dim_products": FT.dim_products(tables.products, tables.cat_trans),
        "agg_seller_performance": marts.agg_seller_performance(fact, cfg),
        "agg_regional_stats": marts.agg_regional_stats(fact),
        "agg_monthly_trend": marts.agg_monthly_trend(fact),
        "agg_cohort_performance": marts.agg_cohort_performance(fact),
        "kpi_summary": kpi.kpi_summary(fact, cfg),
    }
    if with_model:
        out["fact_late_risk"] = R.fact_late_risk(fact, cfg)
    return out


def run_weekly(spark: SparkSession, tables: Tables, out_dir: str, cfg: Config = DEFAULT_CONFIG,
                 run_ts: dt.datetime | None = None, with_model: bool = True,
                 report_dir: str | None = None, enforce_gate: bool = True) -> RunResult:
    run_ts = run_ts or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    run_id = run_ts.strftime("%Y%m%d_%H%M%S")
    week = _week_label(run_ts)
    outputs = build_outputs(tables, cfg, with_model)
    # the small outputs once: the gate and the publication read the same tables
    outputs = {k: v if k.startswith("dim_") or k == "fact_deliveries" else staged(v, k) for k, v in outputs.items()}
    checks = [c for c in Q.hard_checks(cfg) if c.table in outputs]
    results = Q.run_checks(outputs, checks).unionByName(
        Q.run_checks(outputs, Q.expectations(cfg)))
    try:
        local = Q.gate(results)
        failed = None
    except Q.QualityGateError as e:
        local, failed = None, e
    if report_dir:
        W.append_report(results if local is None else local, report_dir, week, run_id)
        W.report_retention(spark, report_dir, cfg.dq_report_keep_weeks)
    if failed is not None and enforce_gate:
        raise failed
    counts = W.publish_run(outputs, out_dir, run_id)
    return RunResult(run_id, week, counts, [r.asDict() for r in (local.collect() if local else [])])


def _week_label(ts: dt.datetime) -> str:
    # %Y-W%W: Monday-based weeks, days before the first Monday are week 00
    return ts.strftime("%Y-W%W")
