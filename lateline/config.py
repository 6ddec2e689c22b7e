"""All thresholds of the analyses in one frozen object.

Defaults are the reference pipeline's values; tests on the synthetic tables
override the seller thresholds (every synthetic supplier is busy).
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace


@dataclass(frozen=True)
class Config:
    # outlier rules: stage hours above these are system errors (pipeline only)
    max_approval_h: float = 700.0
    max_shipping_h: float = 3000.0
    # seller classification
    active_min_orders: int = 20
    best_min_orders: int = 50
    chronic_rate: float = 0.2
    # customer tolerance: days late strictly above this is a breach
    breach_days: int = 3
    # processing-time compliance limit in hours
    processing_limit_h: float = 48.0
    # KPI targets
    target_on_time: float = 95.0
    target_breach: float = 2.0
    target_sla: float = 0.8
    target_sla_upper: float = 1.0
    target_seller_late: float = 5.0
    target_processing: float = 80.0
    # minimum orders for a category to be ranked
    category_min_orders: int = 100
    # share of the notebook SLA variant that must lie in [0.8, 1.0]
    sla_in_range_share: float = 50.0
    # business impact: target late rate after fixes
    impact_target_late_rate: float = 0.05
    # notebook event month/day (November shopping event)
    event_month: int = 11
    event_day: int = 24
    # fixed sample size and seed
    sample_n: int = 5000
    seed: int = 42
    # quality-check bounds (scale with the data set; defaults are the reference's)
    dq_fact_rows_min: int = 90_000
    dq_fact_rows_max: int = 97_500
    dq_sellers_min: int = 3_000
    dq_customers_min: int = 90_000
    dq_products_min: int = 30_000
    dq_risk_rows_min: int = 90_000
    dq_late_rate_lo: float = 0.06
    dq_late_rate_hi: float = 0.12
    dq_monthly_min: int = 12
    dq_ontime_lo: float = 80.0
    dq_ontime_hi: float = 100.0
    ge_rows_min: int = 90_000
    ge_rows_max: int = 100_000
    ge_mostly: float = 0.999
    dq_report_keep_weeks: int = 4
    # risk model
    gbt_trees: int = 100
    gbt_depth: int = 6
    gbt_step: float = 0.1
    forest_trees: int = 100
    forest_depth: int = 10
    test_fraction: float = 0.2
    extra: dict = field(default_factory=dict)

    def with_(self, **kw) -> "Config":
        return replace(self, **kw)


DEFAULT_CONFIG = Config()

# Thresholds that fit the driver's synthetic tables (every supplier has 68-122
# kept orders, so the reference's 20-order rule would mark every seller active).
SYNTHETIC_CONFIG = DEFAULT_CONFIG.with_(active_min_orders=95, chronic_rate=0.12)
