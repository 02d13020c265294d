"""Registered queries against their SQL; ``ALL_QUERIES=1`` runs every one."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.oracle import connect, differences

BUILDERS, ORACLES = queries(), oracle_sql()
SAMPLE = """
    bronze_audit cleanse_customer quarantine run_report fact_left_fanout fact_key_lookup role_playing_dates
    monthly_revenue top_titles store_scorecard dim_date_ext dim_customer store_performance value_rank rfm_segments
    behaviour_profile assign_lsn scd2_merge bitemporal_history as_of_join merge_reference cdc_validate
    kpi_rollup alert_eval alert_suppressed executive_summary stream_scd2
""".split()
NAMES = list(BUILDERS) if os.environ.get("ALL_QUERIES") else SAMPLE


@pytest.fixture(scope="module")
def duck(small):
    return connect(small)


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, small, duck, name):
    df = BUILDERS[name](spark, small)
    if name in ORACLES:
        assert differences(df, duck, ORACLES[name]) == []
    else:
        assert df.count() > 0


def test_entry_and_registry(spark):
    assert entry(spark).count() > 0
    assert set(ORACLES) <= set(BUILDERS)
