from lateline.config import DEFAULT_CONFIG
from lateline.functions import labels as L
from lateline.operators import kpi


def _fact(spark, n_late, n, days_late=0):
    rows = [(f"o{i}", f"s{i % 3}", 1 if i < n_late else 0, days_late, 1.0, 10.0) for i in range(n)]
    return spark.createDataFrame(rows, "order_id string, seller_id string, is_late int, days_late int, "
                                       "actual_vs_est_ratio double, t2_processing_h double")


def test_boundary_status_s27(spark):
    # 1 late of 20 -> on time exactly 95.0 -> pass although the shown operator is '>'
    k = {r.kpi_name: r for r in kpi.kpi_summary(_fact(spark, 1, 20), DEFAULT_CONFIG).collect()}
    assert k[L.KPI_ON_TIME].actual_value == 95.0 and k[L.KPI_ON_TIME].status == L.KPI_PASS
    assert k[L.KPI_ON_TIME].target_operator == ">"
    assert len(k) == 5


def test_breach_exactly_two_percent_passes(spark):
    rows = [(f"o{i}", "s", 0, 4 if i < 1 else 0, 1.0, 10.0) for i in range(50)]
    df = spark.createDataFrame(rows, "order_id string, seller_id string, is_late int, days_late int, "
                                     "actual_vs_est_ratio double, t2_processing_h double")
    k = {r.kpi_name: r for r in kpi.kpi_summary(df, DEFAULT_CONFIG).collect()}
    assert k[L.KPI_BREACH].actual_value == 2.0 and k[L.KPI_BREACH].status == L.KPI_PASS
