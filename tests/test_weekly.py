"""End-to-end weekly job: a failed gate publishes nothing; a passing run
publishes every table with its declared schema; a second run is idempotent
and the quality report holds both runs."""

import dataclasses
import datetime as dt
import os
import tempfile

import pytest

from lateline import schemas
from lateline.config import SYNTHETIC_CONFIG
from lateline.operators.quality import QualityGateError
from lateline.plans.weekly import run_weekly
from lateline.sources import synthetic_tables

from fulfilment_fixtures import SF0001

from lateline.sinks import writers as W

# bounds that fit the smallest synthetic tables
CFG = SYNTHETIC_CONFIG.with_(
    dq_fact_rows_min=500, dq_fact_rows_max=5000, dq_sellers_min=5, dq_customers_min=100,
    dq_products_min=100, dq_risk_rows_min=500, ge_rows_min=500, ge_rows_max=5000,
    dq_late_rate_lo=0.02, dq_late_rate_hi=0.3, dq_monthly_min=1, active_min_orders=5)


def test_failed_gate_publishes_nothing(spark):
    d = tempfile.mkdtemp(prefix="pipe-", dir="/tmp")
    t = synthetic_tables(spark, SF0001)
    with pytest.raises(QualityGateError):
        run_weekly(spark, t, f"{d}/out", SYNTHETIC_CONFIG, with_model=False,
                     report_dir=f"{d}/report", run_ts=dt.datetime(2026, 6, 9))
    assert W.published(spark, f"{d}/out") is None and not os.path.exists(f"{d}/out/runs")
    # the failing run is still recorded in the report
    assert spark.read.parquet(f"{d}/report").where("status = 'FAIL'").count() > 0


def test_publish_and_idempotent_rerun(spark):
    d = tempfile.mkdtemp(prefix="pipe-", dir="/tmp")
    t = synthetic_tables(spark, SF0001)
    # orders without items leave seller cohort / freight bucket null (honest
    # failures of two not-null checks on this data), so publish without the gate
    r1 = run_weekly(spark, t, f"{d}/out", CFG, with_model=False, report_dir=f"{d}/report",
                      run_ts=dt.datetime(2026, 6, 9, 1), enforce_gate=False)
    r2 = run_weekly(spark, t, f"{d}/out", CFG, with_model=False, report_dir=f"{d}/report",
                      run_ts=dt.datetime(2026, 6, 9, 2), enforce_gate=False)
    assert r1.row_counts == r2.row_counts and r1.week == "2026-W23"
    for name, n in r2.row_counts.items():
        df = W.read_published(spark, f"{d}/out", name)
        assert df.count() == n, name
        declared = {f.name: f.dataType for f in schemas.OUTPUTS[name].fields}
        parts = set(schemas.PARTITION_KEYS.get(name, []))
        for f in df.schema.fields:
            if f.name in parts:   # partition values are inferred from folder names
                continue
            assert declared[f.name] == f.dataType, (name, f.name)
    assert W.published(spark, f"{d}/out")["run_id"] == r2.run_id and W.published(spark, f"{d}/out", back=1)["run_id"] == r1.run_id
    runs = spark.read.parquet(f"{d}/report").select("run_ts").distinct().count()
    assert runs == 2


def test_gate_passes_with_the_model(spark):
    """Every order has items here, so the whole job runs: model, all checks, gate, publication."""
    d = tempfile.mkdtemp(prefix="pipe-", dir="/tmp")
    t = synthetic_tables(spark, SF0001)
    t = dataclasses.replace(t, orders=t.orders.join(t.items.select("order_id").distinct(), "order_id"))
    cfg = CFG.with_(gbt_trees=3, gbt_depth=3)
    r = run_weekly(spark, t, f"{d}/out", cfg, with_model=True, report_dir=f"{d}/report", run_ts=dt.datetime(2026, 6, 9, 3))
    failed = spark.read.parquet(f"{d}/report").where("status = 'FAIL'").collect()
    assert not failed and r.row_counts["fact_late_risk"] > 0
    risk = W.read_published(spark, f"{d}/out", "fact_late_risk")
    assert risk.count() == r.row_counts["fact_late_risk"] and set(risk.columns) == {f.name for f in schemas.OUTPUTS["fact_late_risk"].fields}
