"""Registered queries vs their DuckDB twins on the smallest tables."""

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E

from fulfilment_fixtures import SF0001

TABLES = "region nation customer supplier part orders lineitem".split()
FAST = ["late_by_state", "fact_deliveries", "agg_seller_performance", "agg_regional_stats",
        "agg_monthly_trend", "agg_cohort_performance", "kpi_summary", "items_agg", "dim_products",
        "late_by_month", "describe_columns", "stage_stats", "ratio_buckets", "score_crosstab",
        "late_by_freight", "delivery_estimate_by_state", "iqr_outliers", "correlation_matrix",
        "chi2_month_pair", "worst_sellers", "top_bottom_states", "quality_expectations",
        "dash_headline", "impact_chronic_sellers", "table_profile", "business_impact",
        "quality_summary", "kpi_sla_variants", "calendar_labels", "enrich_orders", "seller_segments"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF0001}/{t}.parquet'")
    return c


def _norm(df):
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if pd.api.types.is_float_dtype(df[c]):
            df[c] = df[c].round(4)
    return df.astype(str).sort_values(list(df.columns)).reset_index(drop=True)


def test_every_query_has_a_callable_and_sql_keys_subset():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.queries()) >= 100


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "late_rate" in df.columns


@pytest.mark.parametrize("name", FAST)
def test_matches_duckdb(spark, con, name):
    s = _norm(E.queries()[name](spark, SF0001).toPandas())
    d = _norm(con.execute(E.oracle_sql()[name]).df())
    assert list(s.columns) == list(d.columns)
    assert len(s) == len(d)
    pd.testing.assert_frame_equal(s, d, check_dtype=False)
