"""Dashboard metrics as operators: run rates, variances, idle projections, recommendations, reports.

Each works on marts of warehouse × day or smaller grain and stays a DataFrame to the end; only top-N
reports are limited, and their limit is the feature.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, timedelta
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from costmart.config import Config
from costmart.functions import exprs as X
from costmart.session import stage_table
from costmart.sources.writers import INSIGHT_COLUMNS

COST = "decimal(38,6)"

WINDOW_PRESETS = (7, 14, 30, 60, 90)
IDLE_CREDIT_THRESHOLD = Decimal("0.05")
RIGHTSIZE_BELOW = Decimal("0.15")

# Suggestion per size, one step down; smaller sizes get none.
RIGHTSIZE_TEXT = {
    "MEDIUM": "Right-size to Small",
    "LARGE": "Right-size to Medium",
    "X-LARGE": "Right-size to Large",
    "2X-LARGE": "Right-size to X-Large",
    "3X-LARGE": "Right-size to 2X-Large",
    "4X-LARGE": "Right-size to 3X-Large",
}
# Idle share in percent from which an action is suggested, highest first.
IDLE_ACTIONS = ((70, "Schedule weekends"), (40, "Auto-suspend 5 min"), (20, "Auto-suspend 10 min"))


def _usd(value: Column) -> Column:
    return value.cast(COST)


def _zero() -> Column:
    return F.lit(0).cast(COST)


def _pct(part: Column, whole: Column, k: int = 2) -> Column:
    return X.exact_div(X.money(part) * F.lit(Decimal(100)), X.money(whole), k)


def _month_end(day: date) -> date:
    return (day.replace(day=28) + timedelta(days=4)).replace(day=1) - timedelta(days=1)


def _in_month(cfg: Config, column: str = "usage_date") -> Column:
    return F.col(column).between(F.lit(cfg.as_of.replace(day=1)), F.lit(cfg.as_of))


# ---- windows ------------------------------------------------------------------------------------

def window_slice(df: DataFrame, cfg: Config, days: int, column: str = "usage_date") -> DataFrame:
    """The last `days` full days, ending yesterday."""
    return df.where(F.col(column).between(F.lit(cfg.days_ago(days)), F.lit(cfg.days_ago(1))))


def summary_this_month(summary: DataFrame, cfg: Config) -> DataFrame:
    return summary.where(F.col("usage_date") >= F.lit(cfg.as_of.replace(day=1))).select(
        "usage_date", "cost_category", "cost_usd", "pct_of_daily_total", "mtd_cost_usd"
    )


def forecast_run(forecast: DataFrame, run_date: date) -> DataFrame:
    return forecast.where(F.col("forecast_run_date") == F.lit(run_date)).select(
        "forecast_date",
        "warehouse_name",
        "forecasted_cost_usd",
        "confidence_band_low",
        "confidence_band_high",
        "days_ahead",
    )


def latest(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.max(column).alias("latest"))


# ---- month figures ------------------------------------------------------------------------------

def _with_run_rate(df: DataFrame, cfg: Config) -> DataFrame:
    days = _month_end(cfg.as_of).day
    pace = X.exact_div(X.money(F.col("mtd_total")) * F.lit(Decimal(days)), F.lit(Decimal(cfg.as_of.day)), 6)
    return df.withColumn("run_rate_month", _usd(X.strict_greatest(pace, F.col("mtd_total"))))


def month_run_rate(daily: DataFrame, cfg: Config) -> DataFrame:
    """Month-to-date cost and its projection at the month's pace, never below what is spent."""
    mtd = daily.where(_in_month(cfg)).agg(_usd(F.coalesce(F.sum("total_cost"), _zero())).alias("mtd_total"))
    return _with_run_rate(mtd, cfg).select(
        F.lit(cfg.as_of).alias("as_of"),
        "mtd_total",
        F.lit(cfg.as_of.day).alias("elapsed_days"),
        F.lit(_month_end(cfg.as_of).day).alias("days_in_month"),
        "run_rate_month",
    )


def month_projection(daily: DataFrame, forecast: DataFrame, cfg: Config) -> DataFrame:
    """Month-to-date cost plus the forecast to month end; the run rate where there is no forecast.

    Both inputs become tagged rows of one frame and one aggregation, not a join of single rows.
    """
    spent = daily.where(_in_month(cfg)).select(F.col("total_cost").alias("spent"), F.lit(None).cast(COST).alias("ahead"))
    planned = forecast.where(F.col("forecast_run_date") == F.lit(cfg.as_of)).select(
        F.lit(None).cast(COST).alias("spent"),
        F.when(F.col("forecast_date") <= F.lit(_month_end(cfg.as_of)), F.col("forecasted_cost_usd"))
        .otherwise(_zero())
        .alias("ahead"),
    )
    sums = spent.unionByName(planned).agg(
        _usd(F.coalesce(F.sum("spent"), _zero())).alias("mtd_total"), _usd(F.sum("ahead")).alias("remaining_forecast")
    )
    return _with_run_rate(sums, cfg).select(
        F.lit(cfg.as_of).alias("as_of"),
        "mtd_total",
        "remaining_forecast",
        _usd(F.coalesce(F.col("mtd_total") + F.col("remaining_forecast"), F.col("run_rate_month"))).alias("month_projection"),
    )


def budget_variance(department_costs: DataFrame, budget: DataFrame, cfg: Config, daily: DataFrame | None = None) -> DataFrame:
    """Month-to-date budget and actual cost, their difference and how it reads.

    Without department rows this month the daily mart's total is the actual cost. A budget that has rows,
    but none for this month, is zero; without any row there is none.
    """
    nothing = F.lit(None).cast(COST)

    def part(df: DataFrame, **values) -> DataFrame:
        return df.select(*[values.get(c, nothing).alias(c) for c in ("actual", "total", "planned")])

    rows = part(department_costs.where(_in_month(cfg)), actual=F.coalesce(F.col("total_cost_usd").cast(COST), _zero()))
    month = F.when(_in_month(cfg, "date"), F.col("budget_usd").cast(COST)).otherwise(_zero())
    rows = rows.unionByName(part(budget, planned=F.coalesce(month, _zero())))
    if daily is not None:
        rows = rows.unionByName(part(daily.where(_in_month(cfg)), total=F.col("total_cost").cast(COST)))
    sums = rows.agg(
        _usd(F.sum("planned")).alias("budget_mtd"),
        _usd(F.coalesce(F.sum("actual"), F.sum("total"), _zero())).alias("actual_mtd"),
    )
    variance = F.col("variance_usd")
    return (
        sums.withColumn("variance_usd", _usd(F.col("actual_mtd") - F.col("budget_mtd")))
        .withColumn(
            "variance_pct", F.when(F.col("budget_mtd") > 0, _pct(variance, F.col("budget_mtd")))
        )
        .withColumn(
            "variance_status",
            F.when(variance.isNull(), "no budget")
            .when((F.col("budget_mtd") > 0) & (F.col("actual_mtd") <= 0), "no spend")
            .when(F.col("variance_pct").isNull(), "vs actual spend")
            .when(variance > 0, "over")
            .when(variance < 0, "under")
            .otherwise("on"),
        )
    )


def idle_share_30d(daily: DataFrame, cfg: Config) -> DataFrame:
    sums = window_slice(daily, cfg, 30).agg(
        _usd(F.coalesce(F.sum("idle_cost"), _zero())).alias("idle_total"),
        _usd(F.coalesce(F.sum("total_cost"), _zero())).alias("cost_total"),
    )
    return sums.withColumn(
        "idle_share_pct", F.when(F.col("cost_total") > 0, _pct(F.col("idle_total"), F.col("cost_total")))
    )


def compute_vs_storage(daily: DataFrame, storage_daily: DataFrame, cfg: Config) -> DataFrame:
    """Month-to-date compute and storage cost, one row each."""
    compute = daily.where(_in_month(cfg)).select(F.lit("COMPUTE").alias("cost_category"), F.col("total_cost").cast("decimal(38,9)").alias("usd"))
    storage = storage_daily.where(_in_month(cfg)).select(
        F.lit("STORAGE").alias("cost_category"), F.col("estimated_storage_cost_usd").cast("decimal(38,9)").alias("usd")
    )
    return compute.unionByName(storage).groupBy("cost_category").agg(F.sum("usd").cast("decimal(38,9)").alias("mtd_usd"))


# ---- series -------------------------------------------------------------------------------------

def forecast_by_date(forecast: DataFrame) -> DataFrame:
    return forecast.groupBy("forecast_date").agg(
        _usd(F.sum("forecasted_cost_usd")).alias("forecasted"),
        _usd(F.sum("confidence_band_low")).alias("low"),
        _usd(F.sum("confidence_band_high")).alias("high"),
    )


def actuals_by_date(daily: DataFrame, cfg: Config) -> DataFrame:
    return (
        daily.where(F.col("usage_date") >= F.lit(cfg.days_ago(30)))
        .groupBy("usage_date")
        .agg(_usd(F.sum("total_cost")).alias("total_cost"))
    )


def storage_by_date(storage_daily: DataFrame) -> DataFrame:
    return storage_daily.groupBy("usage_date").agg(
        *[
            F.sum(f"estimated_{part}_cost_usd").cast("decimal(38,9)").alias(part)
            for part in ("active", "failsafe", "stage")
        ]
    )


def department_series(department_costs: DataFrame, cfg: Config, days: int) -> DataFrame:
    """Daily cost per department over the window; the department with most spend is flagged."""
    window = department_costs.where(
        F.col("usage_date").between(F.lit(cfg.days_ago(days - 1)), F.lit(cfg.days_ago(1)))
    )
    totals = window.groupBy("department").agg(F.sum("total_cost_usd").alias("_total"))
    primary = totals.orderBy(F.desc("_total"), F.asc("department")).limit(1).select("department", F.lit(True).alias("_primary"))
    return window.join(primary, "department", "left").select(
        "department",
        F.col("usage_date").alias("date"),
        F.col("total_cost_usd").alias("usd"),
        F.coalesce("_primary", F.lit(False)).alias("is_primary"),
    )


# ---- top-N reports ------------------------------------------------------------------------------

def budget_window(budget: DataFrame, cfg: Config, days: int) -> DataFrame:
    return (
        window_slice(budget, cfg, days, "date")
        .groupBy("department")
        .agg(_usd(F.sum("budget_usd")).alias("budget_window_usd"))
    )


def ranked_list(df: DataFrame, key: str, value: str, n: int = 8, budget: DataFrame | None = None) -> DataFrame:
    """Top n keys by total, their share of the top-n total, and the difference to a window budget."""
    top = (
        df.groupBy(F.col(key).alias("name"))
        .agg(_usd(F.sum(value)).alias("value"))
        .orderBy(F.desc("value"), F.asc("name"))
        .limit(n)
    )
    # The unpartitioned window sees the n rows of the report only.
    listed = F.sum("value").over(W.partitionBy())
    ranked = top.withColumn("share", F.when(listed > 0, _pct(F.col("value"), listed)).otherwise(F.lit(0).cast("decimal(38,2)")))
    if budget is None:
        return ranked.withColumn("delta_pct", F.lit(None).cast("decimal(38,2)"))
    planned = budget.select(F.col("department").alias("name"), "budget_window_usd")
    return (
        ranked.join(planned, "name", "left")
        .withColumn("delta_pct", _vs_budget(F.col("value"), F.col("budget_window_usd")))
        .drop("budget_window_usd")
    )


def _vs_budget(spend: Column, planned: Column) -> Column:
    return F.when(planned > 0, _pct(spend - planned, planned))


def top_databases(storage_daily: DataFrame, n: int = 8) -> DataFrame:
    return (
        storage_daily.groupBy("database_name")
        .agg(F.sum("estimated_storage_cost_usd").cast("decimal(38,9)").alias("cost"))
        .orderBy(F.desc("cost"), F.asc("database_name"))
        .limit(n)
    )


def top_users(spenders: DataFrame, n: int = 8) -> DataFrame:
    """Top n users by estimated cost if there is any estimate, else by runtime hours."""
    totals = spenders.groupBy("user_name").agg(
        F.sum("query_count").alias("queries"),
        X.exact_div(X.money(F.sum("total_runtime_seconds")), F.lit(Decimal(3600)), 1).alias("runtime_hrs"),
        F.round(F.sum("gb_scanned"), 1).alias("gb_scanned"),
        _usd(F.coalesce(F.sum("estimated_cost_usd"), _zero())).alias("est_cost"),
        F.bool_or("has_cost_estimate").alias("_estimated"),
    )
    # Without estimates every cost is zero, so ordering by cost, then runtime serves both cases: the
    # flag says the same for all users of a mart.
    by_cost = F.when(F.col("_estimated"), F.col("est_cost"))
    return (
        totals.orderBy(F.desc_nulls_last(by_cost), F.desc("runtime_hrs"), F.asc("user_name")).limit(n).drop("_estimated")
    )


# ---- idle time and sizing -----------------------------------------------------------------------

def idle_summary(
    hourly: DataFrame, cfg: Config, days: int, credit_threshold: Decimal = IDLE_CREDIT_THRESHOLD, sizes: DataFrame | None = None
) -> DataFrame:
    """Per warehouse over the window: idle cost above a credit threshold, hours, active hours, days.

    Aggregated by warehouse and day first, so distinct days are a count of rows.
    """
    window = hourly.where(F.col("usage_date").between(F.lit(cfg.days_ago(days - 1)), F.lit(cfg.as_of)))
    active = F.col("queries_executed") > 0
    costly = F.col("is_potentially_idle") & (F.col("total_credits_used") >= F.lit(credit_threshold))
    per_day = window.groupBy("warehouse_name", "usage_date").agg(
        F.sum(F.when(costly, F.col("compute_cost_usd")).otherwise(F.lit(0).cast(X.MONEY))).alias("idle"),
        F.sum("total_cost_usd").alias("total"),
        F.sum("compute_cost_usd").alias("compute"),
        F.count(F.lit(1)).alias("hours"),
        F.count(F.when(active, 1)).alias("active_hours"),
        F.sum(F.when(active, F.col("total_credits_used")).otherwise(F.lit(0).cast("decimal(18,3)"))).alias("credits"),
    )
    summary = per_day.groupBy("warehouse_name").agg(
        _usd(F.sum("idle")).alias("idle_cost_adj"),
        _usd(F.sum("total")).alias("total_cost"),
        _usd(F.sum("compute")).alias("compute_cost"),
        F.sum("hours").alias("total_hours"),
        F.sum("active_hours").alias("active_hours"),
        F.sum("credits").cast("decimal(38,3)").alias("credits_on_active_hours"),
        F.count("usage_date").alias("total_days"),
        F.count(F.when(F.col("active_hours") > 0, F.col("usage_date"))).alias("active_days"),
    )
    if sizes is None:
        return summary.withColumn("warehouse_size", F.lit(None).cast("string"))
    known = sizes.groupBy("warehouse_name").agg(F.max("warehouse_size").alias("warehouse_size"))
    return summary.join(known, "warehouse_name", "left")


def idle_projection(idle: DataFrame, days: int) -> DataFrame:
    """Idle share of cost (0–100), idle cost per 30 days, credits per active hour."""
    share = F.coalesce(
        X.clip(_pct(F.col("idle_cost_adj"), F.col("total_cost"), 6), Decimal(0), Decimal(100)), F.lit(0)
    ).cast("decimal(38,6)")
    return idle.select(
        "*",
        share.alias("idle_share"),
        X.exact_div(X.money(F.col("idle_cost_adj")) * F.lit(Decimal(30)), F.lit(Decimal(max(days, 1))), 6).alias("idle_month_est"),
        F.when(
            F.col("active_hours") > 0,
            X.exact_div(X.money(F.col("credits_on_active_hours")), X.whole(F.col("active_hours")), 6),
        ).alias("avg_credits_per_active_hour"),
    )


def rightsizing(projected: DataFrame, below: Decimal = RIGHTSIZE_BELOW) -> DataFrame:
    """One size down for warehouses of medium size or more that use few credits per active hour."""
    size = X.canonical_size(F.col("warehouse_size"))
    lightly_used = F.col("avg_credits_per_active_hour") < F.lit(below)
    return projected.select(
        "warehouse_name",
        "avg_credits_per_active_hour",
        size.alias("warehouse_size"),
        F.when(lightly_used, X.lookup(size, RIGHTSIZE_TEXT, "string")).alias("rightsize_suggestion"),
    )


def savings_summary(projected: DataFrame, sizing: DataFrame) -> DataFrame:
    """Number of flagged warehouses and total projected idle cost per month."""
    none = F.lit(None)
    rows = projected.select(F.col("idle_month_est").alias("idle"), none.cast("string").alias("hint")).unionByName(
        sizing.select(none.cast(COST).alias("idle"), F.col("rightsize_suggestion").alias("hint"))
    )
    return rows.agg(
        F.count(F.when(F.trim("hint") != "", 1)).alias("warehouses_flagged"),
        _usd(X.strict_greatest(F.coalesce(F.sum("idle"), _zero()), _zero())).alias("estimated_savings"),
    )


def idle_estimates(projected: DataFrame, sizing: DataFrame) -> DataFrame:
    """Idle per month and rounded idle share with the sizing suggestion, for reports and exports."""
    return projected.join(sizing.select("warehouse_name", "rightsize_suggestion"), "warehouse_name", "left").select(
        "warehouse_name",
        F.col("idle_month_est").alias("idle_usd_month_est"),
        F.bround("idle_share", 0).cast("decimal(38,0)").alias("idle_share_pct"),
        "rightsize_suggestion",
    )


def idle_table(projected: DataFrame, sizing: DataFrame, n: int = 8) -> DataFrame:
    """Top n warehouses by projected monthly idle cost."""
    return (
        idle_estimates(projected, sizing).orderBy(F.desc("idle_usd_month_est"), F.asc("warehouse_name")).limit(n)
    )


def autosuspend_targets(projected: DataFrame, sizing: DataFrame, settings: DataFrame) -> DataFrame:
    """Warehouses whose auto-suspend should change: five minutes from 40 % idle, else ten. Those to be
    right-sized first, and those at the target already, are left out."""
    current = settings.select(F.upper("name").alias("name"), F.col("auto_suspend").alias("current_seconds"))
    target = F.when(F.col("idle_share_pct") >= 40, 300).otherwise(600)
    return (
        idle_estimates(projected, sizing)
        .where(F.col("rightsize_suggestion").isNull())
        .withColumn("name", F.upper("warehouse_name"))
        .join(current, "name", "left")
        .withColumn("target_seconds", target)
        .where(~F.col("current_seconds").eqNullSafe(F.col("target_seconds")))
        .select("warehouse_name", "idle_share_pct", "current_seconds", "target_seconds")
    )


# ---- insights export ----------------------------------------------------------------------------

def suggested_action(suggestion: Column, share: Column) -> Column:
    by_share = reduce(lambda chain, step: chain.when(share >= step[0], step[1]), IDLE_ACTIONS[1:], F.when(share >= IDLE_ACTIONS[0][0], IDLE_ACTIONS[0][1]))
    return F.coalesce(suggestion, by_share, F.lit(""))


def insights(
    daily: DataFrame, department_costs: DataFrame, budget: DataFrame, estimates: DataFrame | None, cfg: Config, days: int
) -> DataFrame:
    """Department rows and warehouse rows on one column list.

    Spend and budget cover the same `days` full days; `strict_parity` keeps spend one day shorter.
    """
    spend_days = days - 1 if cfg.strict_parity else days
    departments = (
        window_slice(department_costs, cfg, spend_days)
        .groupBy(F.col("department").alias("name"))
        .agg(_usd(F.sum("total_cost_usd")).alias("window_spend_usd"))
        .join(budget_window(budget, cfg, days).withColumnRenamed("department", "name"), "name", "left")
        .select(
            F.lit("department").alias("scope"),
            "name",
            "window_spend_usd",
            _vs_budget(F.col("window_spend_usd"), F.col("budget_window_usd")).alias("vs_budget_pct"),
        )
    )
    warehouses = (
        window_slice(daily, cfg, spend_days)
        .groupBy(F.col("warehouse_name").alias("name"))
        .agg(_usd(F.sum("total_cost")).alias("window_spend_usd"))
    )
    if estimates is None:
        missing = F.lit(None)
        warehouses = warehouses.select(
            "*",
            missing.cast(COST).alias("idle_usd_month_est"),
            missing.cast("decimal(38,0)").alias("idle_share_pct"),
            missing.cast("string").alias("rightsize_suggestion"),
        )
    else:
        warehouses = warehouses.join(estimates.withColumnRenamed("warehouse_name", "name"), "name", "left")
    warehouses = warehouses.select(
        F.lit("warehouse").alias("scope"),
        "name",
        "window_spend_usd",
        "idle_usd_month_est",
        "idle_share_pct",
        suggested_action(F.col("rightsize_suggestion"), F.col("idle_share_pct")).alias("suggested_action"),
    )
    return departments.unionByName(warehouses, allowMissingColumns=True).select(*INSIGHT_COLUMNS)


# ---- profiles and budgets -----------------------------------------------------------------------

def profile_by_key(df: DataFrame, key: str, measure: str, item: str) -> DataFrame:
    """Rows, sum, mean, deviation and approximate distinct items per key."""
    total = F.sum(measure)
    return df.groupBy(key).agg(
        F.count(F.lit(1)).alias("row_count"),
        _usd(total).alias("total_amount"),
        X.exact_div(X.money(total), X.whole(F.count(measure)), 6).alias("avg_amount"),
        F.stddev_samp(F.col(measure).cast("double")).alias("stddev_amount"),
        F.approx_count_distinct(item).alias("approx_items"),
    )


def count_by_hour(df: DataFrame, ts: str) -> DataFrame:
    return df.groupBy(X.bucket(F.col(ts)).alias("created_hour")).agg(F.count(F.lit(1)).alias("row_count"))


def rollup_by_day(df: DataFrame, key: str, ts: str, measure: str) -> DataFrame:
    return df.groupBy(key, X.bucket(F.col(ts), "day").alias("created_date")).agg(
        F.count(F.lit(1)).alias("row_count"), _usd(F.sum(measure)).alias("total_amount")
    )


def department_run_rate(raw_metering: DataFrame, department_map: DataFrame, days: int = 30) -> DataFrame:
    """Mean daily cost per mapped department over the `days` days up to the newest meter day."""
    by_day = raw_metering.select(
        X.clean_name(F.col("warehouse_name")).alias("warehouse_name"),
        X.day_of(F.col("start_time").cast("timestamp_ntz")).alias("usage_date"),
        "total_cost_usd",
    )
    # Reduced to warehouse × day and stored before anything else: the log is scanned once, and the newest day
    # is then a cheap driver literal.
    by_day = stage_table(by_day.groupBy("warehouse_name", "usage_date").agg(F.sum("total_cost_usd").alias("cost")), "run-rate")
    newest = by_day.agg(F.max("usage_date")).first()[0]
    names = department_map.select(
        X.clean_name(F.col("warehouse_name")).alias("_name"), F.trim("department").alias("department")
    ).where((F.col("_name") != "") & (F.col("department") != ""))
    window = by_day.where(F.col("usage_date") > F.date_sub(F.lit(newest), days))
    return (
        window.join(names, F.col("warehouse_name") == F.col("_name"))
        .groupBy("department")
        .agg(X.exact_div(X.money(F.sum("cost")), F.lit(Decimal(days)), 6).alias("daily_cost_usd"))
    )


def derive_budget(
    run_rate: DataFrame,
    multipliers: Mapping[str, Decimal],
    cfg: Config,
    total_multiplier: Decimal = Decimal("1.10"),
    days_back: int = 75,
    days_forward: int = 30,
) -> DataFrame:
    """Daily budget per listed department: run rate × its multiplier, rescaled so that all budgets add
    up to `total_multiplier` × all run rates, repeated for every date of the spine."""
    factor = X.lookup(F.col("department"), {k: str(v) for k, v in multipliers.items()}, "decimal(6,4)")
    # The unpartitioned window sees the listed departments only, as many rows as the parameter has.
    everywhere = W.partitionBy()
    weighted = (
        run_rate.withColumn("_factor", factor)
        .where(F.col("_factor").isNotNull())
        .withColumn("_weighted", (F.col("daily_cost_usd").cast("decimal(18,6)") * F.col("_factor")).cast("decimal(20,6)"))
        .withColumn("_all_weighted", F.sum("_weighted").over(everywhere).cast("decimal(20,6)"))
        .withColumn("_all_actual", F.sum("daily_cost_usd").over(everywhere).cast("decimal(18,6)"))
    )
    scale = F.coalesce(
        X.exact_div(F.col("_all_actual") * F.lit(total_multiplier), F.col("_all_weighted"), 6), F.lit(Decimal(1))
    ).cast("decimal(14,6)")
    amount = F.round((F.col("_weighted") * scale).cast("decimal(34,12)"), 2).cast("decimal(18,2)")
    return weighted.withColumn("budget_usd", amount).select(
        "department",
        F.explode(X.spine(F.lit(cfg.as_of), -days_back, days_forward)).alias("date"),
        "budget_usd",
    )
