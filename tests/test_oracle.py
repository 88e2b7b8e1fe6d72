"""Registered queries against their SQL on the smallest tables.

Every mart and one query per operator family run by default; COSTMART_ALL_QUERIES=1 runs all of them,
and `python tests/oracle_check.py <folder>` does so for any scale.
"""

import os

import pytest
from conftest import DATA
from oracle_check import compare, duck

from costmart.plans.catalog import ORACLES, QUERIES

DEFAULT = [name for name in QUERIES if name.startswith("m")] + [
    "s06_conform_storage", "s07_conform_queries", "s08_conform_metering", "s09_load_inputs", "s12_write_insights_csv",
    "s13_write_clustered", "s16_load_budget", "p06_size_credits", "p16_normalize", "j11_backfill_warehouse_id",
    "a15_profile_exact", "a16_idle_summary", "a21_department_run_rate", "a23_department_fallback", "w16_dense_index",
    "t02_ranked_list", "t04_top_users", "t06_department_series", "f01_bucket", "f05_to_ntz", "f08_surrogate_key",
    "f11_rounding", "f11_large_quotient", "i02_upsert_null_date", "i02_upsert_null_key", "i04_legacy_tables", "i02_upsert", "i02_upsert_table", "i03_fallback_watermark", "i05_sync_schema", "i06_storage_watermark",
    "i07_hourly_incremental", "q00_run_checks", "q09_source_freshness", "q11_table_diagnostics", "d02_month_projection",
    "d03_budget_variance", "d07_rightsizing_wide", "d09_autosuspend_targets", "d10_insights", "d11_derive_budget",
]


@pytest.fixture(scope="module")
def con():
    return duck(DATA)


@pytest.mark.parametrize("name", list(ORACLES) if os.environ.get("COSTMART_ALL_QUERIES") else DEFAULT)
def test_matches_sql(spark, con, name):
    assert compare(QUERIES[name](spark, DATA), con, ORACLES[name]) == []


def test_every_query_but_the_approximate_ones_has_sql():
    assert set(QUERIES) - set(ORACLES) == {"a15_profile_by_key"}


def test_inventory_is_covered():
    """One query per inventory line at least."""
    ranges = {"s": 16, "p": 16, "j": 14, "a": 23, "w": 17, "t": 7, "u": 3, "f": 16, "i": 7, "m": 11, "q": 12, "d": 14}
    ids = {name.split("_")[0] for name in QUERIES}
    assert [f"{k}{i:02}" for k, n in ranges.items() for i in range(1, n + 1) if f"{k}{i:02}" not in ids] == []


def test_approximate_distinct_is_close(spark):
    rows = {r["event_type"]: r for r in QUERIES["a15_profile_by_key"](spark, DATA).collect()}
    exact = dict(duck(DATA).sql("select event_type, count(distinct props) from events group by 1").fetchall())
    assert rows.keys() == exact.keys()
    for key, n in exact.items():
        assert abs(rows[key]["approx_items"] - n) <= 0.15 * n
