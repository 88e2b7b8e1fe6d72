"""Small hand-computed frames: NULLs, ties, gaps, caps, unmatched keys."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from costmart import Config
from costmart.functions import exprs as X
from costmart.operators import analytics, daily, departments, forecast, hourly, spenders, staging, storage, summary, warehouses
from costmart.sources import readers, schemas

D = Decimal
AS_OF = date(2024, 1, 31)


def daily_frame(spark, rows):
    """rows: (day of January, warehouse, total cost)."""
    data = [(date(2024, 1, d), w, D(c), D(c), D("0")) for d, w, c in rows]
    return spark.createDataFrame(
        data, "usage_date date, warehouse_name string, total_cost decimal(38,6), compute_cost decimal(38,6), idle_cost decimal(38,6)"
    )


def rollup(spark, rows):
    """rows: (day of January, compute, idle, queries)."""
    data = [(date(2024, 1, d), "W", D("1"), D(c), D("0"), D(c), D(i), q, D("1.00")) for d, c, i, q in rows]
    return spark.createDataFrame(
        data,
        "usage_date date, warehouse_name string, compute_credits decimal(28,3), compute_cost decimal(28,6), "
        "cloud_services_cost decimal(28,6), total_cost decimal(28,6), idle_cost decimal(28,6), total_queries bigint, "
        "avg_concurrent_users decimal(38,2)",
    )


def test_exact_division_rounds_half_up_and_keeps_signs(spark):
    row = spark.range(1).select(
        X.exact_div(F.lit(D("1")), F.lit(D("8")), 2).alias("up"),
        X.exact_div(F.lit(D("-1")), F.lit(D("8")), 2).alias("down"),
        X.exact_div(F.lit(D("2")), F.lit(D("3")), 6).alias("third"),
        X.exact_div(F.lit(D("1")), F.lit(D("0")), 2).alias("by_zero"),
        X.exact_div(F.lit(None).cast("decimal(28,6)"), F.lit(D("3")), 2).alias("unknown"),
    ).first()
    assert (row.up, row.down, row.third) == (D("0.13"), D("-0.13"), D("0.666667"))
    assert row.by_zero is None and row.unknown is None


def test_hour_bucket_does_not_depend_on_the_session_zone(spark):
    frame = spark.createDataFrame([(datetime(2024, 3, 10, 2, 30),)], "ts timestamp_ntz")
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")  # 02:30 does not exist there
        assert frame.select(X.bucket(F.col("ts")).alias("h")).first().h == datetime(2024, 3, 10, 2)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_meter_hour_is_end_by_default_and_start_on_request(spark):
    row = [(datetime(2024, 1, 5, 23), datetime(2024, 1, 6, 0), 1, "W", D("2"), D("1.9"), D("0.1"))]
    frame = spark.createDataFrame(row, schemas.METERING)
    end = staging.stage_metering(frame, Config(AS_OF)).first()
    start = staging.stage_metering(frame, Config(AS_OF, meter_bucket="start")).first()
    assert (end.usage_date, end.usage_hour_ntz) == (date(2024, 1, 6), datetime(2024, 1, 6))
    assert (start.usage_date, start.usage_hour_ntz) == (date(2024, 1, 5), datetime(2024, 1, 5, 23))
    assert end.total_cost_usd == D("6") and end.idle_cost_usd == 0 and end.metering_id == "1|2024-01-06 00:00:00"


def test_runtime_class_limits_are_exclusive(spark):
    frame = spark.createDataFrame([(60_000,), (60_001,), (600_000,), (600_001,), (None,)], "ms bigint")
    found = [r.c for r in frame.select(X.runtime_category(F.col("ms")).alias("c")).collect()]
    assert found == ["fast", "medium_running", "medium_running", "long_running", "fast"]


def test_efficiency_caps_idle_and_handles_days_without_compute(spark):
    rows = {r.usage_date.day: r for r in daily.daily_efficiency(rollup(spark, [(1, "10", "15", 4), (2, "0", "0", 0), (3, "10", "4", 3)])).collect()}
    assert (rows[1].idle_cost, rows[1].productive_cost, rows[1].efficiency_score) == (D("10"), D("0"), D("0"))
    assert (rows[2].efficiency_score, rows[2].cost_per_query) == (D("100"), None)
    assert (rows[3].efficiency_score, rows[3].cost_per_query) == (D("60"), D("3.333333"))


def test_moving_figures_count_rows_not_calendar_days(spark):
    days = [1, 2, 3, 4, 5, 6, 7, 20]
    frame = daily_frame(spark, [(d, "W", d) for d in days])
    rows = {
        r.usage_date.day: r
        for r in frame.select(
            "usage_date",
            daily.moving_average_7(F.col("total_cost")).alias("avg7"),
            daily.change_from(F.col("total_cost"), 7).alias("wow"),
            daily.month_to_date(F.col("total_cost")).alias("mtd"),
        ).collect()
    }
    assert rows[20].avg7 == D("6.714286")  # (2+3+4+5+6+7+20) / 7
    assert rows[20].wow == D("19") and rows[7].wow is None
    assert rows[20].mtd == sum(days)


def test_idle_needs_credits_and_no_queries(spark):
    frame = spark.createDataFrame(
        [(0, D("1"), D("3")), (0, D("0"), D("3")), (2, D("1"), D("3"))],
        "queries_executed bigint, total_credits_used decimal(18,3), compute_cost_usd decimal(28,6)",
    )
    found = [(r.is_potentially_idle, r.idle_cost_usd) for r in hourly.idle_signal(frame).collect()]
    assert found == [(True, D("3")), (False, D("0")), (False, D("0"))]


def test_forecast_needs_seven_days_and_survives_a_missing_week(spark):
    cfg = Config(AS_OF)
    rows = [(d, "SHORT", 10) for d in range(1, 7)] + [(d, "EARLY", 10) for d in range(1, 11)]
    frame = daily_frame(spark, rows)
    base = {r.warehouse_name: r for r in forecast.forecast_baseline(frame, cfg).collect()}
    assert set(base) == {"EARLY"}
    assert base["EARLY"].trend_slope_per_day is None and base["EARLY"].stddev_daily_cost == 0
    out = forecast.cost_forecast(frame, cfg).collect()
    assert len(out) == 30 and {r.forecasted_cost_usd for r in out} == {D("10")}
    assert {r.confidence_band_low for r in out} == {D("10")}


def test_forecast_weekday_without_history_counts_as_average_and_never_falls_below_zero(spark):
    cfg = Config(AS_OF)
    # Seven Mondays to Sundays minus Sundays; costs fall to nothing in the last week.
    rows = [(d, "W", 100 if d <= 23 else 0) for d in range(17, 32) if date(2024, 1, d).isoweekday() != 7]
    out = forecast.cost_forecast(daily_frame(spark, rows), cfg).collect()
    assert all(r.forecasted_cost_usd >= 0 and r.confidence_band_low >= 0 for r in out)
    factors = {r.day_of_week for r in forecast.dow_factors(daily_frame(spark, rows), cfg).collect()}
    assert 1 not in factors and len(factors) == 6


def test_category_shares_ignore_unknown_and_nonpositive_costs(spark):
    frame = spark.createDataFrame(
        [(date(2024, 1, 1), "A", None, D("3")), (date(2024, 1, 1), "B", None, D("1")), (date(2024, 1, 1), "C", None, D("0")), (date(2024, 1, 1), "D", None, None)],
        "usage_date date, cost_category string, credits_used decimal(38,4), cost_usd decimal(38,9)",
    )
    rows = {r.cost_category: r.pct_of_daily_total for r in summary.with_shares(summary.positive_costs(frame)).collect()}
    assert rows == {"A": D("75"), "B": D("25")}


def test_department_mapping_ignores_case_but_not_padding(spark):
    costs = daily_frame(spark, [(1, "etl_wh", 1), (1, "PAD_WH", 2), (1, "BLANK", 4), (1, "cloud_services_only", 8), (1, "NEW", 16)])
    mapping = spark.createDataFrame([("ETL_WH", " Data "), (" PAD_WH", "Data"), ("blank", " ")], schemas.DEPARTMENT_MAP)
    show = {r.department: r.total_cost_usd for r in departments.cost_by_department(costs, mapping).collect()}
    assert show == {"Data": D("1"), "Unassigned": D("22"), "Overhead": D("8")}
    plan = {r.department: r.actual_cost_usd for r in departments.department_actuals(costs, mapping).collect()}
    assert plan == {"Data": D("1"), "Unassigned": D("30")}


def test_budget_keeps_dates_only_one_side_has(spark):
    costs = daily_frame(spark, [(1, "A", 5), (2, "A", 7)])
    mapping = spark.createDataFrame([("A", "Data")], schemas.DEPARTMENT_MAP)
    budget = spark.createDataFrame([(" Data ", date(2024, 1, 2), D("6")), ("Data", date(2024, 1, 3), D("9"))], schemas.BUDGET)
    rows = {r.usage_date.day: (r.department, r.actual_cost_usd, r.budget_usd) for r in departments.budget_vs_actual(costs, mapping, budget).collect()}
    assert rows == {1: ("Data", D("5"), D("0")), 2: ("Data", D("7"), D("6")), 3: ("Data", D("0"), D("9"))}


def test_fallback_adds_idle_to_compute(spark):
    costs = daily_frame(spark, [(1, "A", 5)]).withColumn("idle_cost", F.lit(D("2")).cast("decimal(38,6)"))
    assert departments.department_fallback(costs, None).first().total_cost_usd == D("7")


def spender_base(spark, rows):
    """rows: (day, user, warehouse, queries, runtime, cost)."""
    data = [(date(2024, 1, d), u, "R", "DB", w, q, None if t is None else D(t), 0, 1.0, None if c is None else D(c), c is not None) for d, u, w, q, t, c in rows]
    return spark.createDataFrame(
        data,
        "usage_date date, user_name string, role_name string, database_name string, warehouse_name string, query_count bigint, "
        "total_runtime_seconds decimal(20,3), long_running_query_count bigint, gb_scanned double, estimated_cost_usd decimal(38,6), "
        "has_cost_estimate boolean",
    )


def test_ranks_share_ties_and_place_unknowns(spark):
    base = spender_base(spark, [(1, "a", "W2", 5, "10", "1"), (1, "b", "W1", 5, None, None), (1, "c", "W1", 3, "10", "4"), (2, "a", "W1", 1, "1", "2")])
    rows = {(r.usage_date.day, r.user_name): r for r in spenders.top_spenders(base).collect()}
    assert [rows[1, u].rank_by_query_count for u in "abc"] == [1, 1, 3]
    assert [rows[1, u].rank_by_runtime for u in "abc"] == [2, 1, 2]  # unknown runtime first
    assert [rows[1, u].rank_by_cost for u in "abc"] == [2, 3, 1]  # unknown cost last
    assert [rows[1, u].pct_of_daily_cost for u in "abc"] == [D("20"), None, D("80")]
    assert rows[2, "a"].rolling_7d_cost_usd == D("3")


def test_primary_warehouse_ties_go_to_the_first_name(spark):
    base = spender_base(spark, [(1, "a", "W2", 5, "1", None), (1, "a", "W1", 5, "1", None), (1, "a", None, 5, "1", None), (1, "b", None, 1, "1", None)])
    found = {r.user_name: r.primary_warehouse_name for r in spenders.primary_warehouse(base).collect()}
    assert found == {"a": "W1", "b": None}


def test_unmatched_attribution_keeps_the_statement(spark, cfg):
    queries = spark.createDataFrame(
        [(q, datetime(2024, 1, 2, 1), datetime(2024, 1, 2, 1, 5), "u", "r", "W", "Small", "SELECT", "D", "S", s, 2**30, 1, 700_000, 1) for q, s in (("1", "SUCCESS"), ("2", "SUCCESS"), ("3", "FAIL"))],
        schemas.QUERIES,
    )
    staged = staging.stage_queries(queries, cfg)
    costs = spark.createDataFrame([("1", D("2.5"))], schemas.ATTRIBUTION)
    row = spenders.top_spenders_base(staged, costs).first()
    assert (row.query_count, row.estimated_cost_usd, row.long_running_query_count, row.has_cost_estimate) == (2, D("2.5"), 2, True)
    bare = spenders.top_spenders_base(staged).first()
    assert bare.estimated_cost_usd is None and bare.has_cost_estimate is False
    assert bare.total_runtime_seconds == D("1400.000") and bare.avg_runtime_seconds == D("700")


def test_latest_size_and_unknown_label(spark):
    staged = spark.createDataFrame(
        [("W", "X Small", datetime(2024, 1, 1, 1)), ("W", "Huge", datetime(2024, 1, 1, 2)), ("W", None, datetime(2024, 1, 1, 3)), ("V", "2x-large", datetime(2024, 1, 1, 1))],
        "warehouse_name string, warehouse_size string, end_time timestamp_ntz",
    )
    metering = spark.createDataFrame([(1, "W", datetime(2024, 1, 1)), (2, "V", datetime(2024, 1, 1)), (3, "U", datetime(2024, 1, 1))], "warehouse_id bigint, warehouse_name string, usage_hour_ntz timestamp_ntz")
    rows = {r.warehouse_name: (r.warehouse_size, r.warehouse_size_credits_per_hour) for r in warehouses.dim_warehouse(metering, staged).collect()}
    assert rows == {"W": ("HUGE", None), "V": ("2X-LARGE", 32), "U": (None, None)}


def test_storage_cost_is_exact_at_nine_decimals(spark, cfg):
    rows = [(date(2024, 1, d), 1, "DB", D(2**40 * d), D(2**40)) for d in (1, 2)]
    staged = staging.stage_storage(spark.createDataFrame(rows, schemas.STORAGE), cfg)
    out = {r.usage_date.day: r for r in storage.daily_storage_costs(staged, cfg).collect()}
    rate = D("23.0") / D("30.44")
    assert out[1].estimated_storage_cost_usd == round(2 * rate, 9)
    assert out[2].month_to_date_storage_cost == round(5 * rate, 9)
    assert out[2].storage_cost_30day_avg == round(D("2.5") * rate, 9)


def test_rightsizing_reads_every_spelling(spark):
    rows = [("A", D("0.1"), "XXLARGE"), ("B", D("0.1"), "2X-Large"), ("C", D("0.1"), "x-small"), ("D", D("0.2"), "LARGE"), ("E", None, "LARGE"), ("F", D("0.1"), None)]
    frame = spark.createDataFrame(rows, "warehouse_name string, avg_credits_per_active_hour decimal(38,6), warehouse_size string")
    found = {r.warehouse_name: r.rightsize_suggestion for r in analytics.rightsizing(frame).collect()}
    assert found == {"A": "Right-size to X-Large", "B": "Right-size to X-Large", "C": None, "D": None, "E": None, "F": None}


def test_actions_by_idle_share(spark):
    frame = spark.createDataFrame([(None, 70), (None, 69), (None, 39), (None, 19), ("Right-size to Small", 90), (None, None)], "hint string, share int")
    found = [r.a for r in frame.select(analytics.suggested_action(F.col("hint"), F.col("share")).alias("a")).collect()]
    assert found == ["Schedule weekends", "Auto-suspend 5 min", "Auto-suspend 10 min", "", "Right-size to Small", ""]


def test_variance_reads_over_under_and_missing(spark, cfg):
    def status(actual, budget):
        spend = spark.createDataFrame([(date(2024, 1, 2), D(actual))], "usage_date date, total_cost_usd decimal(38,6)")
        plan = spark.createDataFrame([("A", date(2024, 1, 2), D(b)) for b in budget], schemas.BUDGET)
        row = analytics.budget_variance(spend, plan, cfg).first()
        return row.variance_status, row.variance_pct

    assert status("12", ["10"]) == ("over", D("20"))
    assert status("8", ["10"]) == ("under", D("-20"))
    assert status("10", ["10"]) == ("on", D("0"))
    assert status("0", ["10"]) == ("no spend", D("-100"))
    assert status("10", []) == ("no budget", None)


def test_strict_parity_shortens_the_spend_window(spark):
    costs = daily_frame(spark, [(30, "A", 1), (24, "A", 2)])
    dept = spark.createDataFrame([], "department string, usage_date date, total_cost_usd decimal(38,6)")
    budget = spark.createDataFrame([], schemas.BUDGET)

    def spend(**options):
        return analytics.insights(costs, dept, budget, None, Config(AS_OF, **options), 7).first().window_spend_usd

    assert spend() == D("3") and spend(strict_parity=True) == D("1")


def test_budget_prefers_the_table_and_cleans_it(spark):
    table = spark.createDataFrame([(" Data ", "2024-01-01", "abc")], "DEPARTMENT string, DATE string, BUDGET_USD string")
    row = readers.load_budget(table, lambda: pytest.fail("fallback not needed")).first()
    assert (row.date, row.department, row.budget_usd) == (date(2024, 1, 1), "Data", D("0"))


def test_unreadable_text_becomes_null(spark):
    frame = spark.createDataFrame([("1.5", "x"), ("abc", "y")], "COST string, Name string")
    rows = readers.normalize(frame, ["cost"]).collect()
    assert [r.cost for r in rows] == [1.5, None] and rows[0].name == "x"


def test_derived_budget_adds_up_to_the_target(spark):
    rates = spark.createDataFrame([("A", D("100")), ("B", D("50")), ("Z", D("999"))], "department string, daily_cost_usd decimal(38,6)")
    out = analytics.derive_budget(rates, {"A": D("1.20"), "B": D("0.80")}, Config(AS_OF), days_back=1, days_forward=1).collect()
    assert len(out) == 6 and {r.department for r in out} == {"A", "B"}
    one_day = [r.budget_usd for r in out if r.date == AS_OF]
    assert abs(sum(one_day) - D("165")) <= D("0.01")


def test_config_reads_environment_style_settings():
    cfg = Config.from_env(AS_OF, {"COST_PER_CREDIT": "2.50", "WINDOW_DAYS": "7"}, strict_parity=True)
    assert (cfg.cost_per_credit, cfg.query_history_days, cfg.metering_history_days, cfg.strict_parity) == (D("2.50"), 7, 7, True)
    with pytest.raises(ValueError):
        Config(AS_OF, meter_bucket="middle")
