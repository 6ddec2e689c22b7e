"""Data-quality checks that gate publication.

A check is a row ``(check, table, column, kind, observed, expected, status)``.
All checks of one table compile into **one** aggregate over that table (one
scan), and the per-table one-row results are unpivoted and unioned into a
small check table.  ``gate`` runs every check, then raises if any failed.

Two families exist, with different null policies (S35, S36):

* hard checks (``hard_checks``): a null fails a set/range test;
* expectations (``expectations``): set/range tests skip nulls and a
  ``mostly`` share may be tolerated.

Row-count bounds belong to one dataset; they come from ``Config``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lateline.config import DEFAULT_CONFIG, Config
from lateline.functions import labels as L

PASS, FAIL, SKIP = "PASS", "FAIL", "SKIP"


@dataclass(frozen=True)
class Check:
    name: str
    table: str
    column: str
    kind: str
    observed: Column                        # aggregate expression -> one value
    passed: Callable[[Column], Column]      # observed -> boolean Column
    expected: str
    applies: Column | None = None           # aggregate boolean; false -> SKIP


def _rows() -> Column:
    return F.count(F.lit(1)).cast("double")


def _violations(cond: Column) -> Column:
    return F.count_if(cond).cast("double")


def _outside(col: str, lo, hi) -> Column:
    """Hard-check rule: null or outside [lo, hi] is a violation."""
    return ~F.coalesce(F.col(col).between(lo, hi), F.lit(False))


def not_in_set(col: str, values, nulls_fail: bool) -> Column:
    inside = F.col(col).isin(list(values))
    return ~F.coalesce(inside, F.lit(not nulls_fail))


def compile_checks(tables: dict[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """One aggregate per table, unpivoted to check rows, unioned."""
    out = None
    for tname in dict.fromkeys(c.table for c in checks):
        cs = [c for c in checks if c.table == tname]
        aggs = []
        for i, c in enumerate(cs):
            aggs.append(c.observed.cast("double").alias(f"_o{i}"))
            aggs.append((c.applies if c.applies is not None else F.lit(True)).alias(f"_a{i}"))
        one = tables[tname].agg(*aggs)
        rows = []
        for i, c in enumerate(cs):
            obs = F.col(f"_o{i}")
            status = (F.when(~F.col(f"_a{i}"), F.lit(SKIP))
                      .when(F.coalesce(c.passed(obs), F.lit(False)), F.lit(PASS))
                      .otherwise(F.lit(FAIL)))
            rows.append(F.struct(F.lit(c.name).alias("check"), F.lit(tname).alias("table"),
                                 F.lit(c.column).alias("column"), F.lit(c.kind).alias("kind"),
                                 obs.alias("observed"), F.lit(c.expected).alias("expected"),
                                 status.alias("status")))
        part = one.select(F.inline(F.array(*rows)))
        out = part if out is None else out.unionByName(part)
    return out


def hard_checks(cfg: Config = DEFAULT_CONFIG, agg_seller_cols: Sequence[str] = (
        "is_chronic", "total_orders")) -> list[Check]:
    ge = lambda b: (lambda o: o >= b)
    gt = lambda b: (lambda o: o > b)
    lt = lambda b: (lambda o: o < b)
    le = lambda b: (lambda o: o <= b)
    zero = lambda o: o == 0
    between = lambda lo, hi: (lambda o: (o >= lo) & (o <= hi))
    f = "fact_deliveries"
    checks = [
        Check("dq_rows_fact_min", f, "*", "row_count", _rows(), gt(cfg.dq_fact_rows_min), f"> {cfg.dq_fact_rows_min}"),
        Check("dq_rows_fact_max", f, "*", "row_count", _rows(), lt(cfg.dq_fact_rows_max), f"< {cfg.dq_fact_rows_max}"),
        Check("dq_rows_sellers", "dim_sellers", "*", "row_count", _rows(), gt(cfg.dq_sellers_min), f"> {cfg.dq_sellers_min}"),
        Check("dq_rows_customers", "dim_customers", "*", "row_count", _rows(), gt(cfg.dq_customers_min), f"> {cfg.dq_customers_min}"),
        Check("dq_rows_products", "dim_products", "*", "row_count", _rows(), gt(cfg.dq_products_min), f"> {cfg.dq_products_min}"),
        # max over non-null values; no value at all passes (like all() on empty)
        Check("dq_t1_max", f, "t1_approval_h", "max", F.coalesce(F.max("t1_approval_h"), F.lit(0.0)),
              le(cfg.max_approval_h), f"<= {cfg.max_approval_h}"),
        Check("dq_t3_max", f, "t3_shipping_h", "max", F.coalesce(F.max("t3_shipping_h"), F.lit(0.0)),
              le(cfg.max_shipping_h), f"<= {cfg.max_shipping_h}"),
    ]
    for col in ["order_id", "is_late", "customer_state", "purchase_month", "seller_cohort", "freight_bucket"]:
        checks.append(Check(f"dq_not_null_{col}", f, col, "not_null", _violations(F.col(col).isNull()), zero, "0 nulls"))
    for col in ["t1_approval_h", "t2_processing_h", "t3_shipping_h"]:
        checks.append(Check(f"dq_non_negative_{col}", f, col, "non_negative", _violations(F.col(col) < 0), zero, "0 negative"))
    checks += [
        Check("dq_is_late_domain", f, "is_late", "in_set", _violations(not_in_set("is_late", [0, 1], True)), zero, "in {0,1}"),
        Check("dq_late_rate_range", f, "is_late", "mean_between", F.avg("is_late"),
              between(cfg.dq_late_rate_lo, cfg.dq_late_rate_hi), f"[{cfg.dq_late_rate_lo}, {cfg.dq_late_rate_hi}]"),
        Check("dq_month_range", f, "purchase_month", "between", _violations(_outside("purchase_month", 1, 12)), zero, "[1, 12]"),
    ]
    s = "agg_seller_performance"
    if all(c in agg_seller_cols for c in ("is_chronic", "total_orders")):
        checks.append(Check("dq_chronic_rule", s, "is_chronic", "rule",
                            _violations((F.col("is_chronic") == 1) & (F.col("total_orders") < cfg.active_min_orders)),
                            zero, f"no chronic seller with < {cfg.active_min_orders} orders"))
    checks += [
        Check("dq_agg_seller_nonempty", s, "*", "row_count", _rows(), gt(0), "> 0"),
        Check("dq_agg_regional_nonempty", "agg_regional_stats", "*", "row_count", _rows(), gt(0), "> 0"),
        Check("dq_monthly_min", "agg_monthly_trend", "*", "row_count", _rows(), ge(cfg.dq_monthly_min), f">= {cfg.dq_monthly_min}"),
        Check("dq_agg_cohort_nonempty", "agg_cohort_performance", "*", "row_count", _rows(), gt(0), "> 0"),
        Check("dq_kpi_rows", "kpi_summary", "*", "row_count", _rows(), lambda o: o == 5, "= 5"),
        Check("dq_kpi_ontime_range", "kpi_summary", "actual_value", "between",
              F.max(F.when(F.col("kpi_name") == L.KPI_ON_TIME, F.col("actual_value"))),
              between(cfg.dq_ontime_lo, cfg.dq_ontime_hi), f"[{cfg.dq_ontime_lo}, {cfg.dq_ontime_hi}]",
              applies=F.count(F.lit(1)) == 5),
        Check("dq_rows_risk", "fact_late_risk", "*", "row_count", _rows(), gt(cfg.dq_risk_rows_min), f"> {cfg.dq_risk_rows_min}"),
        Check("dq_risk_domain", "fact_late_risk", "risk_level", "in_set",
              _violations(not_in_set("risk_level", L.RISK_LABELS, True)), zero, "in risk labels"),
        Check("dq_probability_range", "fact_late_risk", "late_probability", "between",
              _violations(_outside("late_probability", 0, 1)), zero, "[0, 1]"),
    ]
    return checks


#: Columns of the fact that the expectations read.
EXPECTED_COLS = ("order_id", "is_late", "purchase_month", "t1_approval_h", "t3_shipping_h", "seller_cohort", "freight_bucket")


def expectations(cfg: Config = DEFAULT_CONFIG) -> list[Check]:
    """Expectation suite on the fact: set/range tests skip nulls (S35)."""
    f = "fact_deliveries"
    zero = lambda o: o == 0

    def mostly_between(col, lo, hi, mostly):
        v = F.col(col)
        share = F.avg(F.when(v.isNotNull(), v.between(lo, hi).cast("int")))
        return Check(f"expect_between_mostly_{col}", f, col, "between_mostly",
                     F.coalesce(share, F.lit(1.0)), lambda o: o >= mostly, f"[{lo}, {hi}] mostly {mostly}")

    return [
        Check("expect_not_null_order_id", f, "order_id", "not_null", _violations(F.col("order_id").isNull()), zero, "0 nulls"),
        Check("expect_in_set_is_late", f, "is_late", "in_set",
              _violations(not_in_set("is_late", [0, 1], nulls_fail=False)), zero, "in {0,1}"),
        Check("expect_mean_between_is_late", f, "is_late", "mean_between", F.avg("is_late"),
              lambda o: (o >= cfg.dq_late_rate_lo) & (o <= cfg.dq_late_rate_hi),
              f"[{cfg.dq_late_rate_lo}, {cfg.dq_late_rate_hi}]"),
        Check("expect_between_purchase_month", f, "purchase_month", "between",
              _violations(F.col("purchase_month").isNotNull() & ~F.col("purchase_month").between(1, 12)),
              zero, "[1, 12]"),
        mostly_between("t1_approval_h", 0, cfg.max_approval_h, cfg.ge_mostly),
        mostly_between("t3_shipping_h", 0, cfg.max_shipping_h, cfg.ge_mostly),
        Check("expect_row_count_between", f, "*", "row_count", _rows(),
              lambda o: (o >= cfg.ge_rows_min) & (o <= cfg.ge_rows_max), f"[{cfg.ge_rows_min}, {cfg.ge_rows_max}]"),
        Check("expect_not_null_seller_cohort", f, "seller_cohort", "not_null",
              _violations(F.col("seller_cohort").isNull()), zero, "0 nulls"),
        Check("expect_in_set_freight_bucket", f, "freight_bucket", "in_set",
              _violations(not_in_set("freight_bucket", L.FREIGHT_LABELS, nulls_fail=False)), zero, "5 labels"),
    ]


def run_checks(tables: dict[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    return compile_checks(tables, checks)


def summary(results: DataFrame) -> DataFrame:
    """Totals per status: checks run, passed, failed, skipped."""
    s = F.col("status")
    return results.agg(F.count(F.lit(1)).alias("total"), F.count_if(s == PASS).alias("passed"),
                       F.count_if(s == FAIL).alias("failed"), F.count_if(s == SKIP).alias("skipped"))


class QualityGateError(RuntimeError):
    pass


def gate(results: DataFrame) -> DataFrame:
    """Materialise the (small) check table, then raise if any check failed.
    Every check runs before the decision, like the reference."""
    rows = results.collect()  # a few dozen rows, one per check
    failed = [r["check"] for r in rows if r["status"] == FAIL]
    spark = results.sparkSession
    local = spark.createDataFrame(rows, results.schema) if rows else results
    if failed:
        raise QualityGateError(f"{len(failed)} checks failed: {failed}")
    return local
