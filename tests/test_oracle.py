"""A representative subset of the registered queries against their DuckDB oracles (sf0.01);
the full run is ``python tests/oracle_check.py``."""

import pytest

from conftest import SF_ORACLE
from oracle_check import compare, duck

SUBSET = ["mart_arpdau", "mart_retention", "mart_user_rankings", "mart_churn_monthly_compat", "agg_pricing_summary",
          "join_range_binned", "win_surrogate_id", "mart_daily_kpi", "mart_customer_value", "fc_forecast",
          "staff_recommend_schedule", "mart_order_status", "txt_bm25_search", "txt_summarize_documents",
          "sem_multi_fact", "ml_roc_auc_documents", "mon_psi_score", "str_dau", "str_click_to_purchase"]


@pytest.fixture(scope="module")
def con():
    return duck(SF_ORACLE)


@pytest.mark.parametrize("name", SUBSET)
def test_query_matches_oracle(spark, con, name):
    import __spark_entry__ as E
    ok, msg, _ = compare(spark, con, name, E.queries()[name], E.oracle_sql()[name], SF_ORACLE)
    assert ok, msg
